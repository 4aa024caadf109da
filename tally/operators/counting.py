"""Exact conditional distinct counts by class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_distinct_by(df: DataFrame, keys: Sequence[str], id_col: str, col: str,
                      values: Mapping[object, str], *, any_name: str | None = None) -> DataFrame:
    """Per ``keys``: for each class value, the number of distinct ``id_col``
    having a row with ``col = value`` (``COUNT(DISTINCT CASE ...)``).

    Two aggregations instead of one with several distinct aggregates: first one
    row per (keys, id) with a flag per class, then ``count_if`` per flag. This
    avoids the Expand that multiplies the input by the number of distinct
    aggregates, and both steps combine map-side. ``any_name`` adds the
    distinct count of all ids.
    """
    per_id = df.groupBy(*keys, id_col).agg(*[
        F.max(F.col(col) == F.lit(v)).alias(f"_tly_f{i}") for i, v in enumerate(values)])
    aggs = [F.count_if(F.col(f"_tly_f{i}")).alias(name) for i, name in enumerate(values.values())]
    if any_name:
        aggs.append(F.count(F.lit(1)).alias(any_name))
    return per_id.groupBy(*keys).agg(*aggs)
