"""Category dictionaries from JSON files ``{category: [keyword, ...]}``.

Several files are merged like successive dict updates: a category named again
in a later file takes that file's keyword list but keeps its first position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.ordered import Prefix, prefix_aggregate

DICTIONARY_SCHEMA = "map<string,array<string>>"


def read_dictionaries(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``merge_dictionaries`` of JSON files, each read whole (``wholetext``), in the order given."""
    files = None
    for i, p in enumerate(paths):
        f = spark.read.text(p, wholetext=True).select(F.lit(i).alias("file_no"), "value")
        files = f if files is None else files.unionByName(f)
    return merge_dictionaries(files)


def merge_dictionaries(files: DataFrame) -> DataFrame:
    """``(ord, category, keywords)`` from rows ``(file_no, value)``, one JSON object each.

    Each object is parsed to a map, and its entries exploded with their
    position; the last file wins per category, the first (file, position)
    gives the order. Both are one aggregation; the numbering works on ranges
    (see ``operators.ordered``), so any number of files and categories will do.
    """
    entries = files.select("file_no", F.posexplode(
        F.map_entries(F.coalesce(
            F.from_json("value", DICTIONARY_SCHEMA, {"mode": "FAILFAST"}),
            F.raise_error(F.lit("a dictionary file holds no JSON object"))))).alias("pos", "entry"))
    merged = entries.groupBy(F.col("entry.key").alias("category")).agg(
        F.max_by(F.col("entry.value"), F.col("file_no")).alias("keywords"),
        F.min(F.struct("file_no", "pos")).alias("first"))
    merged = merged.select("category", "keywords", F.col("first.file_no").alias("_tly_file"), F.col("first.pos").alias("_tly_pos"))
    return prefix_aggregate(merged, [], ["_tly_file", "_tly_pos"], [Prefix("ord", "count")]).select(
        "ord", "category", "keywords")


def load_dictionaries(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, list[str]]]:
    """The merged dictionary as an ordered list (a configuration: small)."""
    rows = read_dictionaries(spark, paths).orderBy("ord").collect()
    return [(r["category"], list(r["keywords"] or [])) for r in rows]
