"""Tagged multi-source union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(sources: Mapping[str, DataFrame], tag_col: str = "source", *,
                  null_key: tuple[str, object] | None = None,
                  except_tags: Sequence[str] = (),
                  where: Column | None = None) -> DataFrame:
    """UNION ALL of ``sources`` by column name with a literal tag column.

    ``null_key=(col, value)`` replaces NULL ``col`` by ``value`` in every source
    whose tag is not in ``except_tags``. ``where`` is applied to each branch
    before the union (it is pushed into each branch's scan).
    """
    parts = []
    for tag, df in sources.items():
        part = df.filter(where) if where is not None else df
        if null_key is not None and tag not in except_tags:
            col, value = null_key
            part = part.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(
                part.schema[col].dataType)))
        parts.append(part.withColumn(tag_col, F.lit(tag)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
