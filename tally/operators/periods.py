"""Day spines, periods covering days, sums and distinct ids per covered day, metric merges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.time import as_date, date_lit


def date_spine(spark: SparkSession, start: str | dt.date, end: str | dt.date,
               col: str = "metric_date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (no table needed)."""
    return spark.range(1).select(
        F.explode(F.sequence(date_lit(as_date(start)), date_lit(as_date(end)))).alias(col))


def explode_days(df: DataFrame, start: str | Column, end: str | Column,
                 lo: str | dt.date | None = None, hi: str | dt.date | None = None,
                 col: str = "metric_date") -> DataFrame:
    """One row per (period, day) for the days of [start, end] inside [lo, hi] (None: no bound).

    Replaces the range join ``day BETWEEN date(start) AND date(end)`` with a
    spine: each period is clipped to the window first, so the output has at
    most (hi - lo + 1) rows per period and no nested-loop join is planned.
    """
    covered, first, last = _covered(start, end, lo, hi)
    return df.filter(covered).withColumn(col, F.explode(F.sequence(first, last)))


def _covered(start: str | Column, end: str | Column, lo: str | dt.date | None, hi: str | dt.date | None) -> tuple[Column, Column, Column]:
    """Whether a period covers a day of [lo, hi], the first such day and the last."""
    s = F.to_date(F.col(start) if isinstance(start, str) else start)
    e = F.to_date(F.col(end) if isinstance(end, str) else end)
    covered = s <= e  # a period that ends before it starts covers no day
    first, last = s, e
    if lo is not None:
        covered, first = covered & (e >= date_lit(as_date(lo))), F.greatest(s, date_lit(as_date(lo)))
    if hi is not None:
        covered, last = covered & (s <= date_lit(as_date(hi))), F.least(e, date_lit(as_date(hi)))
    return covered, first, last


def sum_by_day(df: DataFrame, start: str | Column, end: str | Column, sums: Mapping[str, Column],
               lo: str | dt.date | None = None, hi: str | dt.date | None = None, col: str = "metric_date") -> DataFrame:
    """Per covered day, the ``sums`` over the periods that cover it.

    Periods of the same days are added up before these are laid out day by
    day, and both sums are combined map-side: no row per (period, day) is
    shuffled.
    """
    covered, first, last = _covered(start, end, lo, hi)
    spans = df.filter(covered).groupBy(first.alias("_tly_first"), last.alias("_tly_last")).agg(
        *[F.sum(v).alias(name) for name, v in sums.items()])
    return explode_days(spans, "_tly_first", "_tly_last", col=col).groupBy(col).agg(*[F.sum(name).alias(name) for name in sums])


def count_ids_by_day(df: DataFrame, start: str | Column, end: str | Column, id_col: str, flags: Mapping[str, Column],
                     lo: str | dt.date | None = None, hi: str | dt.date | None = None, col: str = "metric_date") -> DataFrame:
    """Per covered day and flag, the number of distinct ids (NULL is one) with a period that covers the day and has the flag.

    The days of an id are bits of one word per 64 days, merged by OR: a period
    of a month is one or two rows instead of thirty, and a hot id is combined
    map-side. Words are laid out as days only where they are counted at once.
    """
    covered, first, last = _covered(start, end, lo, hi)
    words = df.filter(covered).select(F.col(id_col).alias("_tly_id"), F.unix_date(first).alias("_tly_first"), F.unix_date(last).alias("_tly_last"),
                                      *[f.alias(f"_tly_f{i}") for i, f in enumerate(flags.values())]).withColumn(
        "_tly_block", F.explode(F.sequence(F.shiftright("_tly_first", 6), F.shiftright("_tly_last", 6))))
    at = F.col("_tly_block") * 64
    ones = F.lit(-1).cast("long")
    days = F.call_function("shiftleft", ones, F.greatest(F.col("_tly_first") - at, F.lit(0))).bitwiseAND(
        F.call_function("shiftrightunsigned", ones, 63 - F.least(F.col("_tly_last") - at, F.lit(63))))
    per_id = words.groupBy("_tly_block", "_tly_id").agg(
        F.bit_or(days).alias("_tly_days"), *[F.bit_or(F.when(F.col(f"_tly_f{i}"), days)).alias(f"_tly_d{i}") for i in range(len(flags))])
    per_day = per_id.withColumn("_tly_bit", F.explode(F.sequence(F.lit(0), F.lit(63))))
    on = lambda c: F.call_function("shiftright", F.col(c), F.col("_tly_bit")).bitwiseAND(F.lit(1)) == 1
    return per_day.filter(on("_tly_days")).groupBy("_tly_block", "_tly_bit").agg(
        *[F.count_if(on(f"_tly_d{i}")).alias(name) for i, name in enumerate(flags)]).select(
        F.date_from_unix_date((at + F.col("_tly_bit")).cast("int")).alias(col), *flags)


def join_containing(left: DataFrame, day: str, right: DataFrame, start: str, end: str,
                    key: str | Sequence[str], how: str = "left") -> DataFrame:
    """``left`` rows joined to the ``right`` rows of the same key whose
    [date(start), date(end)] contains ``day``.

    An equi-join on the key with a range residual (hash / sort-merge join).
    """
    keys = [key] if isinstance(key, str) else list(key)
    l, r = left.alias("_tly_l"), right.alias("_tly_r")
    cond = [F.col(f"_tly_l.{k}") == F.col(f"_tly_r.{k}") for k in keys]
    d = F.col(f"_tly_l.{day}")
    cond.append(d.between(F.to_date(F.col(f"_tly_r.{start}")), F.to_date(F.col(f"_tly_r.{end}"))))
    right_cols = [F.col(f"_tly_r.{c}") for c in right.columns if c not in keys]
    return l.join(r, cond, how).select(F.col("_tly_l.*"), *right_cols)


def merge_metrics(a: DataFrame, b: DataFrame, on: str | Sequence[str],
                  fill: object = 0) -> DataFrame:
    """Full outer join on ``on`` (coalesced key), other columns NULL -> ``fill``."""
    keys = [on] if isinstance(on, str) else list(on)
    j = a.join(b, keys, "full_outer")
    return j.select(*keys, *[F.coalesce(F.col(c), F.lit(fill)).alias(c)
                             for c in j.columns if c not in keys])
