"""Chain walks without recursion: along a sequence, and over unordered links.

A recursive walk starts at the first row of a key and repeatedly joins the
row whose ``start`` equals the current ``end``. When ``end`` of each row is the
next row's ``start`` (rows built with LEAD, as the subscription staging is),
the chain is the sequence itself: step k is the row with ``seq = k``. So the
walk is a semi-join to keys whose first row passes the anchor test and a stop
at the first row whose ``start`` is not the previous ``end``. There is no
longest chain; ``max_depth`` cuts chains only where a caller asks for it. The
previous ``end`` comes from a LAG over ranges of the order, so a key with very many rows is
never one task.

With tied start times a recursive walk fans out (a zero-length period joins
itself); this form keeps each row once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.ordered import Prefix, prefix_aggregate
from tally.session import materialize



def walk_chain(df: DataFrame, key: str, seq: str, start: str, end: str, *,
               anchor: Column | None = None, max_depth: int | None = None,
               out_seq: str = "period_seq") -> DataFrame:
    """Rows reached by the walk, with the step number in ``out_seq``."""
    first = df.filter(F.col(seq) == 1)
    if anchor is not None:
        first = first.filter(anchor)
    rows = df if max_depth is None else df.filter(F.col(seq) <= max_depth)
    rows = rows.join(first.select(key), key, "left_semi")
    linked = prefix_aggregate(rows, [key], [seq], [Prefix("_tly_prev", "lag", end)])
    broken = (F.col(seq) > 1) & ~F.coalesce(F.col("_tly_prev") == F.col(start), F.lit(False))
    stops = linked.filter(broken).groupBy(F.col(key).alias("_tly_key")).agg(
        F.min(seq).alias("_tly_stop"))
    return (linked.join(stops, F.col(key) == F.col("_tly_key"), "left")
            .filter(F.col("_tly_stop").isNull() | (F.col(seq) < F.col("_tly_stop")))
            .drop("_tly_prev", "_tly_key", "_tly_stop")
            .withColumn(out_seq, F.col(seq).cast("long")))


def walk_links(df: DataFrame, keys: Sequence[str], start: str, end: str, *,
               anchor: Column, max_depth: int | None = None,
               out_seq: str = "period_seq") -> DataFrame:
    """R6 over an unordered table of links: the rows that a walk from the
    ``anchor`` rows reaches by joining ``start`` to the ``end`` before it, per
    ``keys``, each with the least number of steps to it in ``out_seq``.

    Nothing is assumed about the rows: links may be missing, branch (several
    rows with one start), meet again, or be repeated; each row comes once per
    input row. A row that ends at or before its start is reached but leads
    nowhere (a zero-length row could only lead to rows of its own start, all
    reached in as many steps). NULL in a key or start: not reached.

    Pointer doubling on the points (keys, time): jump table k holds the pairs
    that exactly 2^k links connect, made by joining table k-1 with itself. The
    walk then takes the tables from the longest jumps down, keeping each
    point's least distance; a shortest path's parts are shortest paths, so the
    binary digits of its length lead along it. A chain of n links takes log2(n)
    joins up and as many down, where a step by step walk takes n. All joins
    are on (keys, time), so a key with very many rows is spread by its times.
    A table has one pair a point where links only branch; only where they also
    meet again and again can it grow beyond the number of rows.
    """
    cols = [f"`{k}`" for k in keys]
    ks = [f"_tly_k{i}" for i in range(len(keys))]
    rows = materialize(df.select("*", F.coalesce(anchor, F.lit(False)).alias("_tly_anchor")), "links")
    keyed = [F.col(c).alias(k) for c, k in zip(cols, ks)]
    starts = rows.select(*keyed, F.col(start).alias("_tly_b")).distinct()
    jumps = [materialize(rows.filter(F.col(end) > F.col(start)).select(
        *keyed, F.col(start).alias("_tly_a"), F.col(end).alias("_tly_b")).distinct()
        .join(starts, [*ks, "_tly_b"], "left_semi"), "jumps")]
    while not jumps[-1].isEmpty() and (max_depth is None or 2 ** len(jumps) < max_depth):
        far = jumps[-1].select(*ks, F.col("_tly_a").alias("_tly_b"), F.col("_tly_b").alias("_tly_c"))
        jumps.append(materialize(jumps[-1].join(far, [*ks, "_tly_b"]).select(
            *ks, "_tly_a", F.col("_tly_c").alias("_tly_b")).distinct(), "jumps"))
    reached = rows.filter(F.col("_tly_anchor") & (F.col(end) > F.col(start))).select(
        *keyed, F.col(end).alias("_tly_a"), F.lit(1).cast("long").alias("_tly_d")).distinct()
    for k in range(len(jumps) - 1, -1, -1):
        step = reached.join(jumps[k], [*ks, "_tly_a"]).select(
            *ks, F.col("_tly_b").alias("_tly_a"), (F.col("_tly_d") + 2 ** k).alias("_tly_d"))
        reached = materialize(reached.union(step).groupBy(*ks, "_tly_a").agg(
            F.min("_tly_d").alias("_tly_d")), "reached")
    match = [F.col(c) == F.col(k) for c, k in zip(cols, ks)] + [F.col(start) == F.col("_tly_a")]
    first = F.col("_tly_anchor") & F.col(start).isNotNull()
    for c in cols:
        first = first & F.col(c).isNotNull()
    seq = F.when(first, F.lit(1).cast("long")).otherwise(F.col("_tly_d") + 1)
    found = rows.join(reached, match, "left").filter(seq.isNotNull())
    if max_depth is not None:
        found = found.filter(seq <= max_depth)
    return found.select(*[F.col(f"`{c}`") for c in df.columns], seq.alias(out_seq))
