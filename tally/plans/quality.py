"""V1-V7: rule-based data-quality checks.

A rule is a dict ``{"type": ..., ...}``:

* ``not_empty``                              row count > 0
* ``row_count_range`` ``min`` (0) ``max`` (inf)  min <= count <= max
* ``no_nulls`` ``column``                    no NULL in the column
* ``unique`` ``column``                      COUNT(*) - COUNT(DISTINCT c) = 0,
                                             so every NULL row counts as a duplicate
* ``freshness`` ``column`` ``max_hours`` (48)  MAX(c) >= now - max_hours; empty fails
* ``expression`` ``condition``               no row satisfies the SQL condition
* ``unique_key`` ``columns``                 no key (NULLs group together) occurs twice

``check`` returns ``(table, rule, passed, detail)`` in rule order as a lazy
DataFrame: all metrics of a table, the distinct counts and key counts
included, come from ONE pass over it, an aggregation by grouping sets (the
rows never reach the driver). ``validate`` collects those few
result rows and raises ``DataQualityError`` on the first failing rule, or
``ValueError`` on the first unknown rule type reached.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.time import as_timestamp, ts_lit

RULE_TYPES = ("not_empty", "row_count_range", "no_nulls", "unique", "freshness", "expression",
              "unique_key")
RESULT_COLUMNS = ["table", "rule", "passed", "detail"]


class DataQualityError(Exception):
    """A data-quality rule failed."""


def _fmt_bound(v: Any) -> str:
    if isinstance(v, float) and math.isinf(v):
        return "inf"
    return str(v)


def _ts_text(c: Column) -> Column:
    return F.coalesce(F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"),
                      F.lit("NULL"))


def check(df: DataFrame, table: str, rules: Sequence[Mapping[str, Any]],
          now: str | dt.datetime) -> DataFrame:
    """Results of all ``rules`` (known types only) as a DataFrame, in rule order."""
    for r in rules:
        if r["type"] not in RULE_TYPES:
            raise ValueError(f"Unknown rule type: {r['type']}")
    now_ts = now if isinstance(now, dt.datetime) else as_timestamp(now)
    metrics: list[tuple[str, Column]] = []  # counts are c<rule>, others m<rule>
    results: list[tuple[Column, Column]] = []
    sets = _key_sets(rules)
    cnt = F.col("m_count")
    for i, r in enumerate(rules):
        t = r["type"]
        if t == "not_empty":
            results.append((cnt > 0, F.format_string("row_count=%d", cnt)))
        elif t == "row_count_range":
            lo, hi = r.get("min", 0), r.get("max", math.inf)
            ok = cnt >= F.lit(lo)
            if not (isinstance(hi, float) and math.isinf(hi)):
                ok = ok & (cnt <= F.lit(hi))
            results.append((ok, F.concat(F.format_string("row_count=%d", cnt),
                                         F.lit(f" expected=[{_fmt_bound(lo)}, "
                                               f"{_fmt_bound(hi)}]"))))
        elif t == "no_nulls":
            c = r["column"]
            metrics.append((f"c{i}", F.count_if(F.col(c).isNull())))
            results.append((F.col(f"c{i}") == 0,
                            F.format_string(f"null_count({c})=%d", F.col(f"c{i}"))))
        elif t == "unique":
            d = cnt - F.col(f"k{sets.index((r['column'],))}_values")
            results.append((d == 0, F.format_string(f"duplicates({r['column']})=%d", d)))
        elif t == "freshness":
            c = r["column"]
            cutoff = now_ts - dt.timedelta(hours=r.get("max_hours", 48))
            metrics.append((f"m{i}", F.max(F.col(c))))
            latest = F.col(f"m{i}").cast("timestamp_ntz")
            results.append((F.coalesce(latest >= ts_lit(cutoff), F.lit(False)),
                            F.concat(F.lit("latest="), _ts_text(latest), F.lit(", cutoff="),
                                     F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S")))))
        elif t == "expression":
            cond = r["condition"]
            metrics.append((f"c{i}", F.count_if(F.coalesce(F.expr(cond), F.lit(False)))))
            results.append((F.col(f"c{i}") == 0,
                            F.format_string(f"violations({cond})=%d", F.col(f"c{i}"))))
        elif t == "unique_key":
            cols = tuple(r["columns"])
            d = F.col(f"k{sets.index(_key(cols))}_repeated")
            results.append((d == 0, F.format_string(f"duplicate_keys({','.join(cols)})=%d", d)))
    rows = F.array(*[F.struct(F.lit(rules[i]["type"]).alias("rule"), ok.alias("passed"), detail.alias("detail"))
                     for i, (ok, detail) in enumerate(results)])
    return _measured(df, metrics, sets).select(F.lit(table).alias("table"), F.inline(rows))


def _key(columns: Sequence[str]) -> tuple[str, ...]:
    return tuple(sorted(set(columns)))


def _key_sets(rules: Sequence[Mapping[str, Any]]) -> list[tuple[str, ...]]:
    """The distinct sets of columns that the unique and unique_key rules group by."""
    sets = [_key([r["column"]] if r["type"] == "unique" else r["columns"])
            for r in rules if r["type"] in ("unique", "unique_key")]
    return list(dict.fromkeys(sets))


def _measured(df: DataFrame, metrics: list[tuple[str, Column]], sets: list[tuple[str, ...]]) -> DataFrame:
    """One row with the row count, the metrics, and per key set the keys that occur
    more than once and the keys without NULL, from one pass over ``df``.

    The key sets and the empty set (the whole table's metrics) are grouping
    sets of one aggregation, combined before its shuffle; a second one over
    the groups counts the keys.
    """
    if not sets:
        return df.agg(F.count(F.lit(1)).alias("m_count"), *[m.alias(n) for n, m in metrics])
    cols = sorted({c for s in sets for c in s})
    ident = {s: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for s in [*sets, ()]}
    groups = df.groupingSets([*[[F.col(c) for c in s] for s in sets], []], *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("_tly_set"), F.count(F.lit(1)).alias("_tly_n"), *[m.alias(n) for n, m in metrics])
    whole = F.col("_tly_set") == ident[()]
    out = [F.coalesce(F.max(F.when(whole, F.col("_tly_n"))), F.lit(0)).alias("m_count")]
    for name, _ in metrics:
        value = F.max(F.when(whole, F.col(name)))
        out.append((F.coalesce(value, F.lit(0)) if name[0] == "c" else value).alias(name))
    for k, s in enumerate(sets):
        mine = F.col("_tly_set") == ident[s]
        out.append(F.count_if(mine & (F.col("_tly_n") > 1)).alias(f"k{k}_repeated"))
        full = mine
        for c in s:
            full = full & F.col(c).isNotNull()
        out.append(F.count_if(full).alias(f"k{k}_values"))
    return groups.agg(*out)


def validate(df: DataFrame, table: str, rules: Sequence[Mapping[str, Any]],
             now: str | dt.datetime) -> list[dict[str, Any]]:
    """Run the rules in order; raise on the first failure or unknown type."""
    known = []
    unknown = None
    for r in rules:
        if r["type"] not in RULE_TYPES:
            unknown = r["type"]
            break
        known.append(r)
    results = []
    if known:
        for row in check(df, table, known, now).collect():
            res = row.asDict()
            results.append(res)
            if not res["passed"]:
                raise DataQualityError(
                    f"Validation failed on {table} - {res['rule']}: {res['detail']}")
    if unknown is not None:
        raise ValueError(f"Unknown rule type: {unknown}")
    return results
