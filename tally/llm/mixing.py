"""Mixing sources to target weights along a time-varying curriculum.

Each source has a token target and a weight schedule over training time. The
integral of the schedule is the source's cumulative token demand; inverting
it turns a document's place in its source's token stream into a training
position, and a range sort by position interleaves the sources so that the
mix follows all schedules at every moment. ``plan`` finds targets and places,
``copies`` the takes of each document and their positions; ``mix`` sorts the
takes, adds up their words over the whole run and returns what each document
contributes to it, ``training_documents`` the sorted texts.

A source's stream runs through its documents in a hashed order, as many full
passes as its target holds and then a part of one; the last document of the
part is taken up to the word that meets the target.

Scale. Sizes are summed per source with map-side combine. The place in the
stream is a prefix sum: each source is cut into hash ranges of about
``ROWS_PER_RANGE`` documents, their sums (a small table) give offsets, and a
window adds up within a range. No source is ever sorted in one task. ``mix``
sorts takes without their texts: ranges cut at sampled positions, their sums as
offsets. The
number of sources must fit one task (their targets are solved together).

Edge cases. Null text: size 0. Null source: a source of its own, ordered
last. Null or repeated ids and repeated rows: each row is a document. A source
without words has target 0. Empty table: empty result. Input columns named
like a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tally.llm.stage import carried, carried_column, staged, with_results
from tally.operators.ordered import running_total

#: Parameters: weights by source rank (repeating), total demand, most passes over a source.
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_PASSES = 2.0
#: Slope of a source's schedule by rank (repeating): early, steady, late.
SLOPES = (0.5, 0.0, -0.5)
ROWS_PER_RANGE = 20_000

WORD = r"[^\x20\x09-\x0D]+"

#: Sources whose targets (a row of numbers each) go to every task.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _by_rank(values: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((F.col("rank") - 1) % len(values) + 1).cast("int"))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source of (_key, _source, _size): source_size, target, slope, n_ranges.

    Targets share TOTAL_SHARE of all words by weight, but stop at MAX_PASSES
    times the source; what is cut off is shared again. With caps c and weights
    w that is min(c, level * w) for one common level. If the k sources with
    the smallest c / w are at their cap, the level is (total - their caps) /
    (weights of the rest); the true level is the largest of these values.
    """
    per = sized.groupBy("_key").agg(F.first("_source").alias("_source"), F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    ranked = (per.withColumn("rank", F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())))
              .withColumn("weight", _by_rank(WEIGHTS)).withColumn("slope", _by_rank(SLOPES))
              .withColumn("_cap", F.col("source_size") * MAX_PASSES))
    everything = W.partitionBy()
    order = W.orderBy(F.col("_cap") / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * TOTAL_SHARE - F.coalesce(F.sum("_cap").over(order), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))))
    return (ranked.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
            .select("_key", "source_size", F.least("_cap", F.col("_level") * F.col("weight")).alias("target"), "slope",
                    F.ceil(F.col("_n") / ROWS_PER_RANGE).alias("n_ranges")))


def position(share: Column, slope: Column) -> Column:
    """Training time in [0, 1] at which a source has met ``share`` of its demand.

    The schedule 1 + slope * (1 - 2 t) integrates to (1 + slope) t - slope t^2.
    """
    b = 1 + slope
    return F.when(slope == 0, share).otherwise((b - F.sqrt(F.greatest(F.lit(0.0), b * b - 4 * slope * share))) / (2 * slope))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The input's rows and columns with size, source_size, target, taken (words due,
    repeats counted), _stream (words before it in its source), _slope, and _row, which tells rows apart."""
    src, body, ident = (carried_column(docs, c) for c in (source, text, doc_id))
    rows = carried(docs).select(
        "*", F.coalesce(F.concat(F.lit("="), src.cast("string")), F.lit("")).alias("_key"), src.alias("_source"),
        word_count(body).alias("_size"), F.xxhash64(ident, body).alias("_hash"), ident.alias("_id"))
    targets = staged(source_targets(rows.select("_key", "_source", "_size")), "targets")
    if targets.count() <= BROADCAST_SOURCES:  # beyond, a shuffle join
        targets = F.broadcast(targets)
    # ranges of the hashed order: the sign-shifted hash times n / 2**64
    at_range = F.floor((F.col("_hash") / 2.0**64 + 0.5) * F.col("n_ranges")).cast("long")
    ranged = rows.join(targets, "_key").withColumn("_range", at_range)
    sums = ranged.groupBy("_key", "_range").agg(F.sum("_size").alias("_sum"))
    before = W.partitionBy("_key").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(F.col("_key").alias("_k"), F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    hashed = W.partitionBy("_key", "_range").orderBy("_hash", "_id", "_size")
    within = hashed.rowsBetween(W.unboundedPreceding, -1)
    # a merge join: one by broadcast would deal the texts out a second time for the window
    out = (ranged.join(offsets.hint("merge"), (F.col("_key") == F.col("_k")) & (F.col("_range") == F.col("_r")))
           .withColumn("_stream", F.col("_before") + F.coalesce(F.sum("_size").over(within), F.lit(0)))
           .withColumn("_nth", F.row_number().over(hashed)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - passes * F.col("source_size")).cast("long")
    taken = passes * F.col("_size") + F.greatest(F.lit(0), F.least(F.col("_size"), rest - F.col("_stream")))
    return with_results(out, docs, {
        "size": F.col("_size"), "source_size": F.col("source_size"), "target": F.col("target"),
        "taken": taken.cast("long"), "_stream": F.col("_stream"), "_slope": F.col("slope"),
        "_row": F.struct("_key", "_range", "_nth")})


def copies(planned: DataFrame, untaken: bool = False) -> DataFrame:
    """One row per take of a document: _words (how many of its words) and _position.

    At most three rows a document; documents without a word are taken once,
    so that none gets lost for having no size. With ``untaken``, a document that
    is not taken has one row too, of no words, where its first take would be.
    """
    size, taken = F.col("size"), F.col("taken")
    nth = F.when(size > 0, F.ceil(taken / size)).otherwise(1).cast("int")
    nth = F.greatest(nth, F.lit(1)) if untaken else nth
    rows = planned.withColumn("_copy", F.explode(F.when(nth > 0, F.sequence(F.lit(0), nth - 1)).otherwise(F.expr("cast(array() as array<int>)"))))
    share = F.when(F.col("target") > 0, (F.col("_copy") * F.col("source_size") + F.col("_stream") + size / 2) / F.col("target")).otherwise(0.0)
    return rows.select("*", F.least(size, taken - F.col("_copy") * size).alias("_words"),
                       position(F.least(F.lit(1.0), share), F.col("_slope")).alias("_position"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``, in the order of first takes: the columns ``carry`` (default: all), size, source_size,
    target, taken (the words of its takes in the run), first_position (training time of its first take), first_word
    (words of the run before that take) and last_word (words up to the end of its last take)."""
    results = ["size", "source_size", "target"]
    names = [c for c in (docs.columns if carry is None else carry) if c not in (*results, "taken")]
    planned = plan(docs, doc_id, text, source).select(
        *results, "taken", "_stream", "_slope", F.col("_row._key").alias("_key"), F.col("_row._range").alias("_range"), F.col("_row._nth").alias("_nth"),
        F.col(f"`{doc_id}`").alias("_id"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_in"))
    takes = copies(planned, untaken=True).drop("taken", "_stream", "_slope")
    run = running_total(takes, "_words", ["_position", "_id", "_copy", "_key", "_range", "_nth"], name="_through")
    rows = run.groupBy("_key", "_range", "_nth").agg(
        F.first("_in").alias("_in"), F.first("_id").alias("_id"), *[F.first(c).alias(c) for c in results], F.sum("_words").cast("long").alias("taken"),
        F.min("_position").alias("first_position"), F.min(F.col("_through") - F.col("_words")).cast("long").alias("first_word"), F.max("_through").cast("long").alias("last_word"))
    return rows.orderBy("first_position", "_id", "_key", "_range", "_nth").select(
        *[F.col(f"_in.`{c}`").alias(c) for c in names], *results, "taken", "first_position", "first_word", "last_word")


def in_training_order(taken: DataFrame) -> DataFrame:
    """Range-sort by training position."""
    return taken.orderBy("_position", "doc_id", "_copy")


def training_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus in training order, with the input's columns: a document twice if
    taken twice; the one that meets its source's target is cut after its last taken word."""
    rows = copies(plan(docs))
    # the words of the one cut document per source; its runs of white space become single spaces
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    part = F.concat_ws(" ", F.slice(words, F.lit(1), F.greatest(F.lit(0), F.col("_words")).cast("int")))
    whole = F.col("_words") >= F.col("size")
    text = F.when(whole, F.col("text")).otherwise(part)
    out = in_training_order(rows)
    cols = {"text": text, "n_chars": F.when(whole, F.col("n_chars")).otherwise(F.length(part).cast("long"))}
    return out.select(*[(cols[c] if c in cols else F.col(f"`{c}`")).alias(c) for c in docs.columns])
