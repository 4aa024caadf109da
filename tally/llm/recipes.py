"""Exact dedup by content-defined chunk recipes, in DataFrame expressions only.

A text is normalised (ASCII white space deleted) and cut into chunks where its
own content says so: at the first pair of characters of two fixed classes after
``MIN_CHUNK`` characters, at ``MAX_CHUNK`` at the latest. Equal texts so have equal
chunks, wherever they lie. Two passes follow:

1. every document becomes its recipe, the ordered list of its chunks' identifiers
   (a 64-bit hash each), beside its size and digest; the text stays where it is;
2. the distinct chunks alone move, once each and combined before the shuffle, and
   verify the identifiers: a hash under which two different chunks lie gets a rank per
   chunk, in byte order, and the recipes of documents with such a chunk carry the ranks too.

Documents are then compared by their whole recipes, which equal one another
exactly if the normalised texts do. Of equal documents the longest original text
stays, then the smallest id.

Scale: a group of copies is aggregated before the shuffle and its one result row
joined back; the join's hot keys are left to skew-join handling. No task holds a
group, nothing reaches the driver but one flag.

Edge cases. Null text counts as empty; empty texts (or white space only) are one
group with the empty recipe. Null id: the row takes part, and stays only if no
copy of its size has an id. Repeated rows (same id, same size): one of them stays,
so ``kept`` holds for one row of a group. Empty table: empty result. The input's
other columns are not read by ``exact_duplicates`` and are kept by ``deduplicate``,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tally.llm.stage import carried, carried_column, computed, staged

#: Parameters: least and greatest length of a chunk, in code points.
MIN_CHUNK, MAX_CHUNK = 256, 4096


def _residue(divisor: int, rest: int) -> str:
    """Regex class of the code points below 592 (Latin) with ``code % divisor == rest``."""
    return "[" + "".join(f"\\x{{{c:x}}}" for c in range(33, 592) if c % divisor == rest) + "]"


def chunks(text: Column, least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> Column:
    """The text's content-defined chunks in order; their concatenation is the text."""
    cut = f"(?s).{{{least},{most}}}?{_residue(7, 3)}{_residue(11, 1)}|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for c in " \t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def recipes(rows: DataFrame, identifier=F.xxhash64) -> DataFrame:
    """(_row, _id, _size, _sha, _recipe) from (_row, _id, _text), with verified identifiers."""
    cut = computed(computed(rows, _norm=normalised(F.col("_text"))), _chunks=chunks(F.col("_norm")))
    hashed = staged(cut.select("_row", "_id", F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("_size"),
                               F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"), F.transform("_chunks", lambda c: identifier(c)).alias("_recipe")), "recipes")
    each = rows.select(F.explode(chunks(normalised(F.col("_text")))).alias("_chunk")).select(identifier(F.col("_chunk")).alias("_h"), "_chunk")
    distinct = each.distinct()
    shared = staged(distinct.groupBy("_h").count().filter("count > 1").select("_h"), "shared-identifiers")
    if shared.isEmpty():
        return hashed
    ranked = (distinct.join(shared, "_h", "left_semi")
              .groupBy("_h").agg(F.sort_array(F.collect_list("_chunk")).alias("_of"))
              .select(F.col("_h").alias("_hh"), F.posexplode("_of").alias("_rank", "_different")))
    base = staged(cut.select("_row", "_id", "_text", "_norm", "_chunks"), "recipe-rows")  # row numbers must not change between the two uses
    at = base.select("_row", F.posexplode("_chunks").alias("_at", "_chunk"))
    ranks = (at.join(ranked, (identifier(F.col("_chunk")) == F.col("_hh")) & (F.col("_chunk") == F.col("_different")))
             .groupBy("_row").agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_rank"))), lambda x: x["_rank"].cast("long")).alias("_ranks")))
    return staged(base.join(ranks, "_row", "left").select(
        "_row", "_id", F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("_size"), F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
        F.concat(F.transform("_chunks", lambda c: identifier(c)), F.coalesce("_ranks", F.array().cast("array<bigint>"))).alias("_recipe")), "recipes")


def _verdicts(rows: DataFrame, identifier) -> DataFrame:
    """(_row, _id, _sha, _best, _count): each row with the row of its group that stays."""
    done = recipes(rows, identifier).select("*", F.xxhash64("_recipe").alias("_key"))
    # greatest size first; the bits of an id turned over order it the other way, null last
    best = F.max(F.struct(F.col("_size").alias("size"), F.bitwise_not("_id").alias("id"), F.bitwise_not("_row").alias("row")))
    groups = done.groupBy("_key", "_recipe").agg(best.alias("_best"), F.count(F.lit(1)).alias("_count"))
    return done.join(groups, ["_key", "_recipe"])


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", identifier=F.xxhash64) -> DataFrame:
    """One row per document: the id column, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return _verdicts(rows, identifier).select(
        F.col("_id").alias(id), F.bitwise_not("_best.id").alias("keep_id"), F.col("_count").alias("group_size"),
        (F.bitwise_not("_best.row") == F.col("_row")).alias("kept"), F.col("_sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", identifier=F.xxhash64) -> DataFrame:
    """The input's rows and columns, one row of each group of equal texts."""
    numbered = staged(carried(docs).select("*", F.monotonically_increasing_id().alias("_row")), "numbered")
    rows = numbered.select("_row", carried_column(docs, id).cast("long").alias("_id"), carried_column(docs, text).alias("_text"))
    keep = _verdicts(rows, identifier).filter(F.bitwise_not("_best.row") == F.col("_row")).select("_row")
    return numbered.join(keep, "_row", "left_semi").select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(docs.columns)])
