"""Dictionary-based text categorisation.

Per text row: its terms (letter runs of 2+ characters, lower-cased, in order
with repeats), the categories whose keyword list contains any term (in
dictionary order, comma-joined) or ``uncategorized``. Rows without terms
(NULL, empty, digits only) are dropped. Whole texts are processed.

One physical form for dictionaries of any size: a projection with a keyword
lookup per term, no shuffle and no UDF, so equal or NULL ids never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.text import extract_terms, match_categories
from tally.sinks.versions import VersionedTable

TEXT_COLUMNS = ["id", "title", "nouns", "category", "category_type"]

# Category types of the four text sources.
CATEGORY_TYPES = {"reviews": "product_review", "tickets": "support_ticket",
                  "faq": "faq_article", "feedback": "user_feedback"}
# Whether a run clears the source's table first.
DELETE_FLAGS = {"reviews": True, "tickets": True, "faq": False, "feedback": True}


def categorize_text(df: DataFrame, dictionary: Sequence[tuple[str, Sequence[str]]],
                    category_type: str, id_col: str = "id", text_col: str = "title",
                    tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    terms = extract_terms(F.col(text_col), 2, tokenizer)
    # explode of a one-element array pins the terms: the row filter below is
    # not rewritten into a second tokenisation of the whole text
    base = (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("title"),
                      F.explode(F.array(terms)).alias("_tly_terms"))
              .filter(F.size("_tly_terms") > 0))
    out = base.select("id", "title", F.array_join("_tly_terms", ",").alias("nouns"),
                      match_categories(F.col("_tly_terms"), dictionary).alias("category"))
    return out.withColumn("category_type", F.lit(category_type)).select(*TEXT_COLUMNS)


def categorize_into(table: VersionedTable, df: DataFrame, dictionary: Sequence[tuple[str, Sequence[str]]],
                    category_type: str, delete_flag: bool = True, id_col: str = "id",
                    text_col: str = "title") -> DataFrame:
    """Bring a stored table of categorised texts up to ``df``; returns its rows.

    ``delete_flag`` True: the table is computed anew. False: only rows not yet
    done, by id and whole text, are processed and appended (a changed text
    counts as new); what is stored stays as it is. The table is its own
    ledger: rows without terms are stored too, with no category, and are not
    tried again. Equal rows within one call are all processed. One commit each way.
    """
    key = F.sha2(F.concat_ws("\0", F.coalesce(F.col(id_col).cast("string"), F.lit("\1")), F.coalesce(F.col(text_col), F.lit("\1"))), 256)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("title"), key.alias("row_key"))
    stored = None if delete_flag or not table.exists() else table.read()
    if stored is not None:
        rows = rows.join(stored.select("row_key"), "row_key", "left_anti")
    terms = rows.select("*", F.explode(F.array(extract_terms(F.col("title")))).alias("_tly_terms"))
    found = F.coalesce(F.size("_tly_terms") > 0, F.lit(False))
    done = terms.select("id", "title", F.when(found, F.array_join("_tly_terms", ",")).alias("nouns"),
                        F.when(found, match_categories(F.col("_tly_terms"), dictionary)).alias("category"),
                        F.lit(category_type).alias("category_type"), "row_key")
    if stored is None:
        table.replace(done)
    else:
        table.append(done)
    return table.read().filter("category is not null").select(*TEXT_COLUMNS)


def term_table(df: DataFrame, id_col: str = "id", text_col: str = "title") -> DataFrame:
    """T1 as a table: ``(id, n_terms, terms)`` of the rows that have terms."""
    t = extract_terms(F.col(text_col))
    return (df.select(F.col(id_col).alias("id"), F.explode(F.array(t)).alias("_tly_t"))
              .filter(F.size("_tly_t") > 0)
              .select("id", F.size("_tly_t").cast("long").alias("n_terms"),
                      F.array_join("_tly_t", ",").alias("terms")))


def category_table(df: DataFrame, dictionary: Sequence[tuple[str, Sequence[str]]],
                   id_col: str = "id", text_col: str = "title") -> DataFrame:
    """T3 as a table: ``(id, category)`` of the rows that have terms."""
    t = extract_terms(F.col(text_col))
    return (df.select(F.col(id_col).alias("id"), F.explode(F.array(t)).alias("_tly_t"))
              .filter(F.size("_tly_t") > 0)
              .select("id", match_categories(F.col("_tly_t"), dictionary).alias("category")))
