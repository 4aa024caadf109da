"""Sums and distinct ids per covered day, against a plain walk over the days of each period."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tally.operators.periods import count_ids_by_day, sum_by_day

DAY0 = dt.date(1969, 10, 1)  # day numbers below zero too


@pytest.mark.parametrize("lo, hi", [(None, None), ("1969-12-20", "1970-03-01")])
def test_days_equal_brute_force(df, lo, hi):
    rnd = random.Random(5)
    day = lambda: DAY0 + dt.timedelta(days=rnd.randrange(400))
    rows = [(rnd.choice([None, 1, 2, 3, 10**12]), rnd.choice(["a", "b", None]), a, a + dt.timedelta(days=rnd.choice([-3, 0, 5, 63, 64, 200])), rnd.choice([None, 7]))
            for a in (day() for _ in range(60))]
    rows += [(1, "a", None, day(), 1), (1, "a", day(), None, 1), rows[0], rows[0]]
    d = df(rows, "id long, kind string, a date, b date, v long")
    days = {}
    for i, kind, a, b, v in rows:
        for k in range((b - a).days + 1 if a and b else 0):
            at = a + dt.timedelta(days=k)
            if (lo is None or str(at) >= lo) and (hi is None or str(at) <= hi):
                days.setdefault(at, []).append((i, kind, v))
    got = {r[0]: tuple(r)[1:] for r in sum_by_day(d, "a", "b", {"n": F.lit(1), "v": F.col("v")}, lo, hi).collect()}
    assert got == {at: (len(x), sum(v for *_, v in x if v) if any(v for *_, v in x) else None) for at, x in days.items()}
    flags = {"ids": F.lit(True), "a_ids": F.col("kind") == "a", "not_a": F.col("kind") != "a"}
    got = {r[0]: tuple(r)[1:] for r in count_ids_by_day(d, "a", "b", "id", flags, lo, hi).collect()}
    assert got == {at: (len({i for i, *_ in x}), len({i for i, k, _ in x if k == "a"}), len({i for i, k, _ in x if k == "b"})) for at, x in days.items()}


def test_no_row_per_period_and_day_is_shuffled(spark, df):
    """2,000 periods of a year are 730,000 days; what is grouped by id are words of 64 days."""
    d = spark.range(2000).select("id", F.lit(dt.date(2024, 1, 1)).alias("a"), F.lit(dt.date(2024, 12, 31)).alias("b"))
    plan = count_ids_by_day(d, "a", "b", "id", {"ids": F.lit(True)})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("_tly_bit") < plan.index("bit_or")  # days are laid out above the merged words only
    assert {r.ids for r in count_ids_by_day(d, "a", "b", "id", {"ids": F.lit(True)}).collect()} == {2000}
