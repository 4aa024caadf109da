"""Walks over unordered links and joins of instants to intervals, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tally.operators.chain import walk_links
from tally.operators.intervals import interval_join


def _walk(rows, max_depth=None):
    """Least steps to each row by breadth-first search; rows are (id, key, start, end, first)."""
    steps = {r[0]: 1 for r in rows if r[4] and r[1] is not None and r[2] is not None}
    front = [r for r in rows if r[0] in steps]
    depth = 1
    while front and (max_depth is None or depth < max_depth):
        depth += 1
        ends = {(r[1], r[3]) for r in front if r[3] is not None and r[3] > r[2]}
        front = [r for r in rows if r[0] not in steps and r[1] is not None and (r[1], r[2]) in ends]
        steps.update((r[0], depth) for r in front)
    return steps


@pytest.mark.parametrize("max_depth", [None, 1, 2, 5, 40])
def test_walk_over_broken_branching_and_tied_links(spark, df, max_depth):
    rnd = random.Random(4)
    rows = [(i, 0, i, i + 1, i == 0) for i in range(150)]                      # one long chain
    rows += [(1000 + i, 1, i, i + 1, i == 0) for i in range(30) if i != 17]     # broken
    rows += [(2000 + i, rnd.choice([2, 3, None]), s := rnd.randint(0, 30), s + rnd.choice([-2, 0, 0, 1, 1, 2, 3]),
              rnd.random() < 0.1) for i in range(150)]                        # branching, meeting, tied, reversed
    rows += [(3000, 4, None, 5, True), (3001, 4, 5, None, True), (3002, 4, 5, 6, None), (3003, None, 1, 2, True)]
    d = df(rows, "id long, k long, s long, e long, first boolean").repartition(3)
    got = walk_links(d, ["k"], "s", "e", anchor=F.col("first"), max_depth=max_depth)
    assert {r.id: r.period_seq for r in got.collect()} == _walk(rows, max_depth)
    assert got.columns == ["id", "k", "s", "e", "first", "period_seq"]


def test_walk_keeps_repeated_rows_and_empty_tables(spark, df):
    d = df([(1, 0, 1, True), (1, 1, 2, False), (1, 1, 2, False)], "k int, s int, e int, a boolean")
    assert sorted(r.period_seq for r in walk_links(d, ["k"], "s", "e", anchor=F.col("a")).collect()) == [1, 2, 2]
    assert walk_links(d.limit(0), ["k"], "s", "e", anchor=F.col("a")).count() == 0


@pytest.mark.parametrize("closed", [False, True])
def test_intervals_of_any_length(spark, df, closed):
    rnd = random.Random(8)
    t0 = dt.datetime(1969, 12, 30)
    at = lambda: t0 + dt.timedelta(microseconds=rnd.choice([rnd.randrange(10**6) * 10**6, rnd.randrange(4 * 10**11)]))
    spans = [(i, rnd.choice([1, 2]), s := at(), s + dt.timedelta(seconds=rnd.choice([0, 0.000001, 1, 90, 4000, 10**5, 10**8, -5])))
             for i in range(120)] + [(500, 1, None, t0), (501, 1, t0, None), (502, None, t0, t0 + dt.timedelta(days=9))]
    points = [(1000 + i, rnd.choice([1, 2, None]), at()) for i in range(80)] + [(2000 + i, 1, r[2]) for i, r in enumerate(spans[:20])] \
        + [(3000 + i, 1, r[3]) for i, r in enumerate(spans[:20])] + [(4000, 1, None)]
    p = df(points, "pid long, k int, at timestamp_ntz")
    s = df(spans, "sid long, k int, lo timestamp_ntz, hi timestamp_ntz")
    inside = lambda x, lo, hi: None not in (x, lo, hi) and lo <= x and (x <= hi if closed else x < hi)
    keyed = interval_join(p, "at", s, "lo", "hi", ["k"], closed=closed)
    assert keyed.columns == ["pid", "k", "at", "sid", "lo", "hi"]
    assert sorted((r.pid, r.sid) for r in keyed.collect()) == sorted(
        (a, b) for a, k, x in points for b, j, lo, hi in spans if k is not None and k == j and inside(x, lo, hi))
    free = interval_join(p.drop("k"), "at", s.drop("k"), "lo", "hi", closed=closed)
    plan = free._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sorted((r.pid, r.sid) for r in free.collect()) == sorted(
        (a, b) for a, _, x in points for b, _, lo, hi in spans if inside(x, lo, hi))
    assert interval_join(p, "at", s.limit(0), "lo", "hi", ["k"]).count() == 0
