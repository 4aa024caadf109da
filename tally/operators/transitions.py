"""State transitions -- previous value, next time, class by rule list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.ordered import Prefix, sequence_index


def classify_transitions(df: DataFrame, col: str, rules: Sequence[tuple[object, str]], *,
                         first: Column | None = None, first_label: str = "new",
                         default: str = "other", out: str = "transition_type") -> DataFrame:
    """Label rows: ``first_label`` where ``first`` holds, else the label of the
    first rule whose value equals ``col`` (a rule value may also be a Column
    predicate), else ``default``."""
    expr = None
    if first is not None:
        expr = F.when(first, F.lit(first_label))
    for value, label in rules:
        cond = value if isinstance(value, Column) else (F.col(col) == F.lit(value))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out, expr)


def transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], *,
                value: str, time: str, rules: Sequence[tuple[object, str]],
                first_label: str = "new", default: str = "other",
                seq: str = "seq", **options) -> DataFrame:
    """Per key in ``order``: ``seq``, ``prev_<value>``, ``next_<time>`` and a
    ``transition_type`` (first row of a key -> ``first_label``).

    The order is worked on in ranges (see ``tally.operators.ordered``, which takes
    ``options``), so a huge key is spread over many tasks.
    """
    s = sequence_index(df, keys, order, idx=seq, idx_inverse=None, count=None,
                       extra=[Prefix(f"prev_{value}", "lag", value),
                              Prefix(f"next_{time}", "lead", time)], **options)
    return classify_transitions(s, value, rules, first=F.col(seq) == 1,
                                first_label=first_label, default=default)
