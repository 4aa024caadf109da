"""Distinct counts from daily bitmaps equal direct counts over any span."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tally.operators import bitmaps

CLASSES = {"a": "a_users", "b": "b_users", "none seen": "c_users"}


def test_rolled_up_bitmaps_equal_direct_counts(spark, df):
    rnd = random.Random(6)
    ids = [-1, 0, 1, 32768, 32769, -32768, 10**12, None, *range(100, 140)]
    rows = [(rnd.choice(ids), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(60)), rnd.choice(["a", "b", "x", None]))
            for _ in range(800)]
    d = df(rows, "user_id long, day date, class string")
    days = bitmaps.build(d, ["day", "class"], "user_id")
    for span in ("week", "month"):
        got = bitmaps.count_ids_by(days.withColumn("span", F.trunc("day", span)), ["span"], "class", CLASSES, "users")
        want = d.groupBy(F.trunc("day", span).alias("span")).agg(
            F.countDistinct("user_id").alias("users"),
            *[F.countDistinct(F.when(F.col("class") == v, F.col("user_id"))).alias(n) for v, n in CLASSES.items()])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    merged = bitmaps.roll_up(days, ["day"])
    want = {r.day: r.n for r in d.groupBy("day").agg(F.countDistinct("user_id").alias("n")).collect() if r.n}
    assert {r.day: r.ids for r in bitmaps.count_ids(merged, ["day"]).collect()} == want


def test_empty_table(spark, df):
    days = bitmaps.build(df([], "user_id long, day date, class string"), ["day", "class"], "user_id")
    assert bitmaps.count_ids_by(days, ["day"], "class", CLASSES).count() == 0


def test_sparse_ids_take_a_word_each(spark):
    """Ids far apart: no more rows than ids, of one word (a block of 32,768 ids took 4 KB for each)."""
    days = bitmaps.build(spark.range(500).select((F.col("id") * 10**6).alias("user_id"), F.lit(dt.date(2024, 1, 1)).alias("day")), ["day"], "user_id")
    assert days.schema[bitmaps.BITS].dataType.simpleString() == "bigint"
    assert days.count() == 500 and bitmaps.count_ids(days, ["day"]).first().ids == 500
