"""Per-group time buckets and first / last value by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_count(ts: Column | str, minutes: int = 30) -> Column:
    """Number of distinct ``minutes``-long clock buckets of the day.

    30 minutes gives the half-hour session count. An aggregate expression.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.count_distinct(F.floor((F.hour(t) * 60 + F.minute(t)) / F.lit(minutes)))


def first_last_by(value: str, order: Sequence[str]) -> tuple[Column, Column]:
    """(first, last) of ``value`` by the total order ``order``.

    Aggregate expressions (``min_by`` / ``max_by`` on a struct of the order
    columns), so they go in the same ``groupBy`` as the counts: no window,
    and the partial aggregation keeps one row per group and task.
    """
    key = F.struct(*[F.col(c) for c in order])
    return F.min_by(F.col(value), key), F.max_by(F.col(value), key)
