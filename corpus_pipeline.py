"""Training corpus from raw documents: quality rules, near-dedup, privacy, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's rows as
Parquet in the shared checkpoint folder and reads them back as the next
stage's input, so a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tally.llm import mixing, near_dedup, packing, privacy, quality
from tally.llm.stage import documents, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicate(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    scanned = staged(privacy.scan(docs), "pii")
    return privacy.masked(docs, privacy.train(scanned))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, repeated or cut so that sources meet their targets."""
    return mixing.training_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup_stage), ("pii", pii), ("mix", mix), ("pack", pack)]

#: The tokenizer, the trained span classifier and the component search are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, last = STAGES[-1]
    return last(spark, docs, sf_dir)
