"""Shared Spark helpers of the operators: staged tables and held-out splits."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tally.session import checkpoint_dir, materialize


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts the lineage)."""
    return materialize(df, f"llm-{name}")


def staged_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """Like ``staged``, bucketed by ``column``: writing shuffles nothing, and grouping by it reads without a shuffle.

    The catalog entry that bucketing needs is dropped once the table is read; the files stay."""
    spark = df.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
    df.write.format("parquet").bucketBy(buckets, column).option("path", f"{checkpoint_dir(spark)}/tally-tables/{table}").saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, modulus: int, value: int = 2) -> Column:
    """True for the held-out fold: crc32 of the id as text, modulo ``modulus``, is ``value``.

    A null id counts as training data.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == value, F.lit(False))


def carried(df: DataFrame) -> DataFrame:
    """The input's columns under plain names of the operators' own, safe from clashes."""
    return df.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(df.columns)])


def carried_column(df: DataFrame, name: str) -> Column:
    return F.col(f"_in{df.columns.index(name)}")


def with_results(work: DataFrame, df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """The carried columns of ``df`` under their own names, then the results; a result
    replaces an input column of the same name."""
    return work.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(df.columns) if c not in results],
                       *[c.alias(name) for name, c in results.items()])


def computed(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a one-row generator, so that the optimiser computes each once
    instead of copying its expression into every use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


#: Bits of the bitmap of ``maybe_in`` for each member, and at most (32 MB); beyond, it rules out fewer rows.
BITMAP_BITS, BITMAP_MOST = 16, 1 << 28
_BLOCK_BITS = 8 * 4096  # of bitmap_construct_agg


def maybe_in(df: DataFrame, key: str, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``df`` that may be among ``members`` by ``key``, rows that surely are not), without a shuffle of ``df``.

    ``key`` has one type in both. ``members`` is read twice; only a bitmap of its hashed keys, two bytes a member and 32 MB at most, is broadcast.
    Few other rows are in the first part, so an exact join that follows shuffles little more than the members' rows.
    A null key is among the second."""
    bits = _BLOCK_BITS
    while bits < min(BITMAP_MOST, BITMAP_BITS * members.count()):
        bits *= 2
    at = F.pmod(F.xxhash64(F.col(key)), F.lit(bits))
    blocks = members.filter(F.col(key).isNotNull()).select(at.alias("_at")).groupBy(F.floor(F.col("_at") / _BLOCK_BITS).alias("_block")).agg(
        F.bitmap_construct_agg(F.col("_at") % _BLOCK_BITS).alias("_bitmap"))
    rows = df.withColumn("_at", F.when(F.col(key).isNotNull(), at)).withColumn("_near", F.floor(F.col("_at") / _BLOCK_BITS))
    byte = F.expr(f"cast(conv(hex(substring(_bitmap, cast(_at % {_BLOCK_BITS} / 8 as int) + 1, 1)), 16, 10) as int)")
    rows = rows.join(F.broadcast(blocks), F.col("_near") == F.col("_block"), "left")
    hit = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.col("_at") % 8).cast("int")) > 0, F.lit(False))
    return rows.filter(hit).select(*df.columns), rows.filter(~hit).select(*df.columns)
