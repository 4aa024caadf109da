"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(col: Column, scale: int = 2) -> Column:
    """ROUND(x, scale) on a double, computed on decimal(20, 6).

    Rounding a binary double directly disagrees between engines on values that
    print as exact halves (4.725); going through a fixed 6-digit decimal makes
    the result stable. Returns a double.
    """
    return F.round(col.cast("decimal(20,6)"), scale).cast("double")


def guarded_pct(new: Column, base: Column, *, zero_base: Column | None = None,
                scale: int = 2) -> Column:
    """``(new - base) / base * 100`` rounded; ``zero_base`` when base is 0 or NULL.

    With ``zero_base=None`` the result for a NULL or zero base is NULL.
    ANSI mode raises on division by zero, so the zero case is guarded.
    """
    pct = round_half((new - base).cast("double") / base.cast("double") * 100.0, scale)
    bad = base.isNull() | (base == 0)
    if zero_base is None:
        return F.when(~bad, pct)
    return F.when(bad, zero_base).otherwise(pct)


def null_add(a: Column, b: Column) -> Column:
    """SQL-SUM style addition of two partial sums: NULL only when both are."""
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
