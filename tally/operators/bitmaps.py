"""Exact distinct counts that add up: bitmaps of integer ids, kept per day and rolled up.

A distinct count per day says nothing of the count per week, so longer spans
would have to be counted from the rows again. Here a day keeps, per block of
64 ids, one word with a bit for each id seen. Words of any days and classes
merge by OR, and the set bits of the merged ones are the exact count. Building
and merging are combined before the shuffle by hash, and one key's blocks are
rows of their own, so a hot day or class spreads over its blocks.

A word is one row of fixed size, so bitmaps never take more rows than there are
ids seen, however far apart these are, and up to 64 times fewer: number ids
densely. NULL ids are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "bits"


def build(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``(keys..., id_block, bits)``: the ids seen with each key."""
    ident = F.col(id_col).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), ident.bitwiseAND(F.lit(63)).cast("int"))
    return df.filter(F.col(id_col).isNotNull()).groupBy(*keys, F.shiftright(ident, 6).alias(BLOCK)).agg(F.bit_or(bit).alias(BITS))


def roll_up(bitmaps: DataFrame, keys: Sequence) -> DataFrame:
    """The bitmaps of coarser ``keys`` (columns or expressions): ids seen with any of the merged ones."""
    return bitmaps.groupBy(*keys, BLOCK).agg(F.bit_or(BITS).alias(BITS))


def count_ids(bitmaps: DataFrame, keys: Sequence[str], name: str = "ids") -> DataFrame:
    """``(keys..., name)``: distinct ids, from bitmaps that are merged by ``keys`` (see ``roll_up``)."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bit_count(BITS)).alias(name))


def count_ids_by(bitmaps: DataFrame, keys: Sequence[str], col: str, values: Mapping[str, str],
                 total: str | None = None) -> DataFrame:
    """Per ``keys``: distinct ids of each value of ``col`` as the column ``values`` names, and of all rows as ``total``.

    Every id counts once per column, also where it was seen on many days or with many values.
    """
    words = bitmaps.groupBy(*keys, BLOCK).agg(
        *[F.bit_or(F.when(F.col(col) == v, F.col(BITS))).alias(name) for v, name in values.items()],
        F.bit_or(BITS).alias(total or "_tly_total"))
    return words.groupBy(*keys).agg(*[F.coalesce(F.sum(F.bit_count(c)), F.lit(0)).alias(c)
                                      for c in [*([total] if total else []), *values.values()]])
