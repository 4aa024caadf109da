"""Ordered per-key operators that stay balanced when one key is huge.

A window ``PARTITION BY key`` sends every row of a key to one task. When a key
can hold a third of all rows (the anonymous ``user_id = -1``, one heavy
customer), or when the order is global, that task does not finish. Here the
rows are cut into ranges of the sort order instead, and running aggregates
come from prefix sums over the ranges:

1. the input is computed once and written under the shared checkpoint folder;
   everything below reads that table;
2. a sample of (key, order) gives cut points: every ``SAMPLE_PER_BUCKET``-th
   sampled row of a key in its order. A key gets cuts in proportion to its
   rows, a small key none, so every (key, range) holds a bounded share of the
   table. There is no list of hot keys and no threshold: all keys are treated
   alike. The sample, and so the cuts, are bounded by ``MAX_BUCKETS``, which
   bounds their broadcast; a row finds its range by binary search;
3. per (key, range): row count and partial sums / maxima / edge values, a
   map-side combined aggregation that reads only the columns it needs;
4. prefix offsets over those, in a tree: ranges are grouped ``FAN`` at a time,
   the groups' totals again, and the offsets are handed down, so that no task
   ever holds more than ``FAN`` entries of a key;
5. the offsets are joined back on (key, range), and a window over (key, range)
   finishes on the join's partitioning. The data is shuffled once.

The cuts decide only which rows are worked on together; any cuts give the
same result. LAG / LEAD by one row use the same pass: a range's first row
takes the last value of the range before it, its last row the first value of
the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.numeric import null_add
from tally.session import materialize

_K, _B = "_tly_k", "_tly_b"
# Rows a range aims at, and the fewest worth a cut of their own.
BUCKET_ROWS = 250_000
MIN_BUCKET_ROWS = 2_000
# Sampled rows for one cut: a range's size varies by about 1 / sqrt of this.
SAMPLE_PER_BUCKET = 64
# Most ranges of a table (the bound of the cuts' broadcast).
MAX_BUCKETS = 1 << 16
# Entries that one step of the offset tree takes together.
FAN = 256


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


@dataclass(frozen=True)
class Prefix:
    """One ordered aggregate per row.

    ``fn`` in {"sum", "max", "xor", "count"}: over the rows of the key up to
    this row (``inclusive``) or before it; ``count`` inclusive is ROW_NUMBER.
    ``fn`` in {"lag", "lead"}: ``value`` of the previous / next row (NULL at
    the key's edge)."""

    name: str
    fn: str
    value: Column | str | None = None
    inclusive: bool = True


def _xor(a: Column, b: Column) -> Column:
    return F.coalesce(a.bitwiseXOR(b), a, b)


_COMBINE = {"sum": null_add, "max": F.greatest, "xor": _xor}
_AGGREGATE = {"sum": F.sum, "max": F.max, "xor": F.bit_xor}


def _range_count(rows: int, parallel: int, bucket_rows: int, least: int) -> int:
    return max(1, min(MAX_BUCKETS, max(rows // bucket_rows, 2 * parallel), rows // max(1, least)))


def _cut_points(rows: DataFrame, order: Column, ranges: int, total: int) -> DataFrame:
    """(key, sorted cut points) of the keys that are cut; at most about ``ranges`` points in all."""
    share = min(1.0, ranges * SAMPLE_PER_BUCKET / total)
    per = SAMPLE_PER_BUCKET if share < 1.0 else max(1, total // ranges)
    sample = rows.select(_K, order.alias("_tly_at")).sample(share, 42)
    nth = F.row_number().over(Window.partitionBy(_K).orderBy("_tly_at"))
    cuts = sample.select("*", nth.alias("_tly_nth")).filter(F.col("_tly_nth") % per == 0)
    return materialize(cuts.groupBy(_K).agg(F.array_sort(F.collect_set("_tly_at")).alias("_tly_cuts")), "cuts")


def _range_of(order: Column, ranges: int) -> Column:
    """How many cut points are at or below ``order``: binary search over the sorted array."""
    steps = [1 << k for k in range((2 * ranges).bit_length() - 1, -1, -1)]
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        F.get("_tly_cuts", at + step - 1) <= order, at + step).otherwise(at))
    return F.when(F.col("_tly_cuts").isNotNull(), found).otherwise(F.lit(0))


def prefix_aggregate(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     aggs: Sequence[Prefix], *, total: str | None = None,
                     cut_by: Sequence[str | Column] | None = None,
                     bucket_rows: int = BUCKET_ROWS, min_bucket_rows: int = MIN_BUCKET_ROWS) -> DataFrame:
    """Add running aggregates per ``keys`` in ``order`` (a total order, ascending, NULLs first).

    ``total`` adds the group size. ``keys=()`` is one global order. ``cut_by`` gives
    narrower columns for the cut points where ``order`` is wide (texts); it must not
    decrease along ``order``. The input is read once, when this is called.
    """
    for a in aggs:
        if a.fn not in ("count", "lag", "lead", *_AGGREGATE):
            raise ValueError(f"unknown prefix function {a.fn!r}")
    order_c = _cols(order)
    out_cols = [F.col(f"`{c}`") for c in df.columns]
    spark = df.sparkSession
    rows = materialize(df, "ordered-rows")
    n = rows.count()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = _range_count(n, parallel, bucket_rows, min_bucket_rows)
    rows = rows.select("*", F.struct(*([F.col(f"`{k}`") for k in keys] or [F.lit(0).alias("_")])).alias(_K))
    if ranges > 1:
        at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(cut_by or order))])
        cuts = _cut_points(rows, at, ranges, n)
        rows = rows.join(F.broadcast(cuts), _K, "left").select(*out_cols, _K, _range_of(at, ranges).alias(_B))
    else:
        rows = rows.select("*", F.lit(0).alias(_B))

    vals = {a.name: (F.col(f"`{a.value}`") if isinstance(a.value, str) else a.value) for a in aggs}
    lead_col = order[0] if isinstance(order[0], str) else None
    part = [F.count(F.lit(1)).alias("_tly_n")]
    for a in aggs:
        if a.fn in _AGGREGATE:
            p = _AGGREGATE[a.fn](vals[a.name])
        elif a.fn in ("lag", "lead"):
            # the leading order column itself: the last / first row of a range holds
            # its max / min (hash-aggregatable, unlike an ordering struct). Edge values
            # are wrapped, so that a NULL value is told from no row
            if isinstance(a.value, str) and a.value == lead_col and a.fn == "lag":
                p = F.max(vals[a.name])
            elif a.fn == "lag":
                p = F.max_by(vals[a.name], F.struct(*order_c))
            else:
                p = F.min_by(vals[a.name], F.struct(*order_c))
            p = F.struct(p.alias("v"))
        else:
            continue
        part.append(p.alias(f"_tly_p_{a.name}"))
    stats = rows.groupBy(_K, _B).agg(*part)
    if 2 * ranges > FAN:
        stats = materialize(stats, "range-stats")
    stats = _offsets(stats, aggs, 2 * ranges + 1, total is not None)

    wb = Window.partitionBy(_K, _B).orderBy(*order_c)
    rn = F.row_number().over(wb)
    new_cols = []
    for a in aggs:
        frame = wb.rowsBetween(Window.unboundedPreceding, 0 if a.inclusive else -1)
        o = F.col(f"_tly_o_{a.name}") if a.fn != "count" else None
        if a.fn == "count":
            c = (F.col("_tly_off") + rn - (0 if a.inclusive else 1)).cast("long")
        elif a.fn in _COMBINE:
            c = _COMBINE[a.fn](_AGGREGATE[a.fn](vals[a.name]).over(frame), o)
        elif a.fn == "lag":
            c = F.when(rn == 1, o["v"]).otherwise(F.lag(vals[a.name]).over(wb))
        else:
            c = F.when(rn == F.col("_tly_n"), o["v"]).otherwise(F.lead(vals[a.name]).over(wb))
        new_cols.append(c.alias(a.name))
    if total:
        new_cols.append(F.col("_tly_tot").alias(total))
    return rows.join(stats, [_K, _B], "inner").select(*out_cols, *new_cols)


def _offsets(stats: DataFrame, aggs: Sequence[Prefix], size: int, total: bool) -> DataFrame:
    """(key, range, _tly_n) with what precedes (or, for lead, follows) each range.

    ``size`` bounds the range numbers. Up to ``FAN`` ranges of a key go through one
    window; more are grouped, and the groups' own offsets found the same way.
    """
    grouped = size > FAN
    group = [F.floor(F.col(_B) / FAN).cast("int").alias("_tly_g")] if grouped else []
    s = stats.select("*", *group)
    part = Window.partitionBy(_K, "_tly_g") if grouped else Window.partitionBy(_K)
    w = part.orderBy(_B)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum("_tly_n").over(before), F.lit(0)).alias("_tly_off")]
    if total and not grouped:
        offs.append(F.sum("_tly_n").over(part).alias("_tly_tot"))
    for a in aggs:
        p, o = f"_tly_p_{a.name}", f"_tly_o_{a.name}"
        if a.fn in _AGGREGATE:
            offs.append(_AGGREGATE[a.fn](p).over(before).alias(o))
        elif a.fn != "count":
            offs.append((F.lag if a.fn == "lag" else F.lead)(p).over(w).alias(o))
    within = s.select(_K, _B, "_tly_n", *(["_tly_g"] if grouped else []), *offs)
    if not grouped:
        return within

    ups = [F.sum("_tly_n").alias("_tly_n")]
    for a in aggs:
        p = f"_tly_p_{a.name}"
        if a.fn in _AGGREGATE:
            ups.append(_AGGREGATE[a.fn](p).alias(p))
        elif a.fn != "count":
            ups.append((F.max_by if a.fn == "lag" else F.min_by)(p, _B).alias(p))
    upper = _offsets(s.groupBy(_K, F.col("_tly_g").alias(_B)).agg(*ups), aggs, -(-size // FAN), total)
    names = ["_tly_off", *[f"_tly_o_{a.name}" for a in aggs if a.fn != "count"]]
    upper = upper.select(_K, F.col(_B).alias("_tly_g"), *[F.col(c).alias(f"{c}_up") for c in names],
                         *(["_tly_tot"] if total else []))
    out = [(F.col("_tly_off") + F.col("_tly_off_up")).alias("_tly_off")]
    for a in aggs:
        if a.fn == "count":
            continue
        o, up = F.col(f"_tly_o_{a.name}"), F.col(f"_tly_o_{a.name}_up")
        out.append((_COMBINE[a.fn](o, up) if a.fn in _COMBINE else F.coalesce(o, up)).alias(f"_tly_o_{a.name}"))
    return within.join(upper, [_K, "_tly_g"]).select(_K, _B, "_tly_n", *(["_tly_tot"] if total else []), *out)


def sequence_index(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], *,
                   idx: str = "idx", idx_inverse: str | None = "idx_inverse",
                   count: str | None = "group_count", extra: Sequence[Prefix] = (),
                   **options) -> DataFrame:
    """R2: forward index (1 = first), reverse index (1 = last) and group size.

    The reverse index is ``count - idx + 1``: same values as a descending
    ROW_NUMBER over the reversed total order, without a second sort.
    """
    tot = count or ("_tly_count" if idx_inverse else None)
    out = prefix_aggregate(df, keys, order, [Prefix(idx, "count"), *extra], total=tot, **options)
    cols = [c for c in out.columns if c != tot or count]
    if idx_inverse:
        cols.append((F.col(tot) - F.col(idx) + 1).alias(idx_inverse))
    return out.select(*cols)


def running_total(df: DataFrame, value: str | Column, order: Sequence[str | Column],
                  keys: Sequence[str] = (), *, name: str = "running_total", **options) -> DataFrame:
    """SUM(value) over rows unbounded preceding .. current row.

    ``keys=()`` is a global running total, as balanced as a keyed one.
    """
    return prefix_aggregate(df, list(keys), order, [Prefix(name, "sum", value)], **options)
