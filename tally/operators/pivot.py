"""Pivots of a (key, attribute) table into one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_columns(col: str, flags: Mapping[str, str]) -> list[Column]:
    """Aggregates of R4, to combine with others in one ``groupBy``."""
    return [F.max(F.when(F.col(col) == F.lit(v), F.lit(1)).otherwise(F.lit(0))).alias(name)
            for v, name in flags.items()]


def max_columns(col: str, measure: str, values: Mapping[str, str]) -> list[Column]:
    """Aggregates of R5, to combine with others in one ``groupBy``."""
    return [F.max(F.when(F.col(col) == F.lit(v), F.col(measure))).alias(name)
            for v, name in values.items()]


def pivot_flags(df: DataFrame, key: str | Sequence[str], col: str,
                flags: Mapping[str, str]) -> DataFrame:
    """One 0/1 int column per value: ``MAX(CASE WHEN col = v THEN 1 ELSE 0 END)``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*flag_columns(col, flags))


def pivot_max(df: DataFrame, key: str | Sequence[str], col: str, measure: str,
              values: Mapping[str, str]) -> DataFrame:
    """One column per value with ``MAX(measure)`` of that value, NULL if none.

    Same result as ``groupBy(key).pivot(col, values).max(measure)`` with the
    values listed (no extra job to discover them), renamed by ``values``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*max_columns(col, measure, values))
