"""Ordered operators over ranges equal the plain window form, whatever the ranges."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tally.operators import ordered
from tally.operators.ordered import Prefix, prefix_aggregate, running_total, sequence_index


def _rows(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # key -1 is hot (~40 % of rows); some NULL keys and NULL values
        k = -1 if rnd.random() < 0.4 else rnd.choice([None, 1, 2, 3, 4, 5])
        v = None if rnd.random() < 0.1 else rnd.randint(-50, 50)
        t = None if rnd.random() < 0.05 else rnd.randint(0, 50)
        rows.append((i, k, t, v))
    return rows


SCHEMA = "id long, k long, t long, v long"
AGGS = [Prefix("rn", "count"), Prefix("before", "count", inclusive=False),
        Prefix("prev_t", "lag", "t"), Prefix("next_t", "lead", "t"),
        Prefix("s", "sum", "v"), Prefix("s_ex", "sum", "v", inclusive=False),
        Prefix("m", "max", "v"), Prefix("m_ex", "max", "v", inclusive=False),
        Prefix("x", "xor", "v"), Prefix("x_ex", "xor", "v", inclusive=False),
        Prefix("prev_v", "lag", "v"), Prefix("next_v", "lead", "v")]
FNS = {"sum": F.sum, "max": F.max, "xor": F.bit_xor}


def _plain(d, keys):
    w = Window.partitionBy(*keys).orderBy("t", "id")
    cols = []
    for a in AGGS:
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if a.inclusive else -1)
        if a.fn == "count":
            c = F.row_number().over(w) - (0 if a.inclusive else 1)
        elif a.fn in FNS:
            c = FNS[a.fn](a.value).over(frame)
        else:
            c = (F.lag if a.fn == "lag" else F.lead)(a.value).over(w)
        cols.append(c.alias(a.name))
    return d.select("*", *cols, F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("tot"))


def _collect(df):
    return sorted(tuple(r) for r in df.select("id", *[a.name for a in AGGS], "tot").collect())


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("bucket_rows, least, fan", [(250_000, 2_000, 256), (40, 1, 256), (3, 1, 4), (1, 1, 2)])
def test_ranges_equal_plain_windows(spark, df, monkeypatch, keys, bucket_rows, least, fan):
    monkeypatch.setattr(ordered, "FAN", fan)
    d = df(_rows(), SCHEMA).repartition(3)
    got = prefix_aggregate(d, keys, ["t", "id"], AGGS, total="tot", bucket_rows=bucket_rows, min_bucket_rows=least)
    assert _collect(got) == _collect(_plain(d, keys))


def test_cuts_on_a_narrower_column(spark, df):
    d = df(_rows(300, 3), SCHEMA)
    got = prefix_aggregate(d, ["k"], ["t", "id"], AGGS, total="tot", cut_by=["t"], bucket_rows=5, min_bucket_rows=1)
    assert _collect(got) == _collect(_plain(d, ["k"]))


def test_a_hot_key_is_cut_and_small_keys_are_not(spark, df):
    rows = [(i, 0 if i % 3 else i, i, 1) for i in range(6000)]
    d = df(rows, SCHEMA)
    ranged = prefix_aggregate(d, ["k"], ["t", "id"], [Prefix("s", "sum", "v")], bucket_rows=200, min_bucket_rows=1)
    plan = ranged._jdf.queryExecution().analyzed().toString()
    assert "_tly_cuts" in plan
    staged = df(rows, SCHEMA).select("*", F.struct("k").alias("_tly_k"))
    cuts = {r[0][0]: len(r[1]) for r in ordered._cut_points(staged, F.struct("t", "id"), 30, 6000).collect()}
    assert set(cuts) == {0} and 10 <= cuts[0] <= 30
    assert sorted(r.s for r in ranged.filter("k = 0").collect()) == list(range(1, 4002))


def test_empty_table(spark, df):
    d = df([], SCHEMA)
    assert prefix_aggregate(d, ["k"], ["t", "id"], AGGS, total="tot").count() == 0
    assert running_total(d, "v", ["t", "id"]).count() == 0


def test_input_is_read_once(spark, df):
    """The input's own rows pass through exactly one evaluation."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    d = df(_rows(5000), SCHEMA).select("id", "k", "t", counted("v").alias("v"))
    running_total(d, "v", ["t", "id"], name="rt", bucket_rows=500).collect()
    assert seen.value == 5000


def test_sequence_index_invariant(spark, df):
    d = df(_rows(), SCHEMA)
    out = sequence_index(d, ["k"], ["t", "id"], bucket_rows=20, min_bucket_rows=1)
    bad = out.filter(F.col("idx") + F.col("idx_inverse") != F.col("group_count") + 1).count()
    assert bad == 0
    # indices are 1..n per key
    per = out.groupBy("k").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"),
                               F.count(F.lit(1)).alias("n"),
                               F.countDistinct("idx").alias("d")).collect()
    for r in per:
        assert r["lo"] == 1 and r["hi"] == r["n"] == r["d"]


def test_plan_has_no_single_key_window_on_data(spark, df):
    d = df(_rows(50), SCHEMA)
    out = sequence_index(d, ["k"], ["t", "id"], bucket_rows=5, min_bucket_rows=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the data-side window is partitioned by (key, range), never by the key alone
    assert "_tly_b" in plan


def test_unknown_function_is_refused(spark, df):
    with pytest.raises(ValueError):
        prefix_aggregate(df(_rows(5), SCHEMA), ["k"], ["t"], [Prefix("p", "median", "v")])
