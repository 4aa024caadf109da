"""Dominant category of a group by priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dominant_category(col: Column | str, priority: Sequence[str], default: str) -> Column:
    """Aggregate: the first category of ``priority`` present in the group,
    else ``default``. ``MIN`` of the priority rank, then a lookup."""
    c = F.col(col) if isinstance(col, str) else col
    rank = None
    for i, cat in enumerate(priority, start=1):
        rank = (F.when(c == F.lit(cat), F.lit(i)) if rank is None
                else rank.when(c == F.lit(cat), F.lit(i)))
    rank = rank.otherwise(F.lit(len(priority) + 1))
    names = F.array(*[F.lit(p) for p in priority], F.lit(default))
    return F.element_at(names, F.min(rank))
