"""Join of points in time to the intervals that contain them, of any lengths, as an equi-join.

A range condition alone plans a nested loop. Here every interval lies in bins of
its own order of length: the smallest power of four, in microseconds, not below
the length is the bins' width, so it touches two of them at most, however long
it is, and long ones never share bins with short ones. A point is looked up in
one bin for each width that occurs (a few dozen at most, a number that goes to the
driver). The join is on (keys, width, bin); the exact condition decides inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widths are 4 ** level microseconds, from about a second to about a million years.
LEVELS = range(10, 32)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _bin(micros: Column, level: str) -> Column:
    """Number of the bin of 4 ** level microseconds: a shift by two bits a level, rounding down."""
    return F.call_function("shiftright", micros, F.col(level) * 2)


def interval_join(points: DataFrame, at: str, intervals: DataFrame, start: str, end: str,
                  keys: Sequence[str] = (), *, closed: bool = False) -> DataFrame:
    """The pairs of a point and an interval with ``start <= at < end`` (``closed``: ``<= end``), equal in ``keys``.

    The columns of ``points``, then those of ``intervals`` without the keys. NULL
    times or keys match nothing; an interval that ends before it starts contains nothing,
    one of no length contains its instant only if ``closed``.
    """
    lo, hi = F.col("_tly_lo"), F.col("_tly_hi")
    own = [c for c in intervals.columns if c not in keys]
    spans = intervals.select(*[F.col(f"`{k}`").alias(f"_tly_k{i}") for i, k in enumerate(keys)], F.struct(*[F.col(f"`{c}`") for c in own]).alias("_tly_r"),
                             _micros(F.col(start)).alias("_tly_lo"), _micros(F.col(end)).alias("_tly_hi")).filter(lo <= hi if closed else lo < hi)
    level = F.lit(LEVELS[-1])
    for n in reversed(LEVELS[:-1]):
        level = F.when(hi - lo <= 4 ** n, n).otherwise(level)
    spans = spans.select("*", level.cast("int").alias("_tly_level"))
    used = sorted(r[0] for r in spans.select("_tly_level").distinct().collect())
    spans = spans.select("*", F.explode(F.sequence(_bin(lo, "_tly_level"), _bin(hi, "_tly_level"))).alias("_tly_bin"))
    asked = points.select("*", _micros(F.col(at)).alias("_tly_at"),
                          F.explode(F.array(*[F.lit(n).cast("int") for n in used]) if used else F.array().cast("array<int>")).alias("_tly_level_of"))
    asked = asked.select("*", _bin(F.col("_tly_at"), "_tly_level_of").alias("_tly_bin_of"))
    inside = (F.col("_tly_at") >= lo) & ((F.col("_tly_at") <= hi) if closed else (F.col("_tly_at") < hi))
    same = (F.col("_tly_level_of") == F.col("_tly_level")) & (F.col("_tly_bin_of") == F.col("_tly_bin")) & inside
    for i, k in enumerate(keys):
        same &= F.col(f"`{k}`") == F.col(f"_tly_k{i}")
    return asked.join(spans, same).select(*[F.col(f"`{c}`") for c in points.columns], *[F.col("_tly_r")[c].alias(c) for c in own])
