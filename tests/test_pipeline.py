"""The batch runner: layers written, validation passes, window replace keeps history."""

from tally.catalog import TEST_DICTIONARY
from tally.plans.pipeline import run_all
from tally.sources.fixtures import VIEWS, RawTables


def _counts(t):
    return {r["metric_date"]: r["total_events"] for r in t["daily_event_counts"].collect()}


def test_run_all_twice_then_short_window(spark):
    raw = RawTables(spark, "/root/testdata/sf0.001")
    views = {v: raw[v] for v in VIEWS}
    t = run_all(spark, views, "2024-01-31", database="tally_t1", bronze_lookback=30,
                activity_lookback=30, dictionaries={"reviews": TEST_DICTIONARY})
    assert t["event_log"].count() == views["user_events"].count() + \
        views["system_events"].count() + views["api_events"].count()
    assert t["event_log"].filter("idx + idx_inverse != user_event_count + 1").count() == 0
    assert 0 < t["daily_revenue_counts"].count() <= 31   # days with billing or MRR
    assert t["subscription_summary"].count() > 0 and t["reviews_categories"].count() > 0
    first = _counts(t)
    assert len(first) == 30
    assert sum(first.values()) == t["event_log"].count()
    activity = sorted(map(tuple, t["user_activity"].collect()))
    # same input again: same tables (idempotent window replace)
    t2 = run_all(spark, views, "2024-01-31", database="tally_t1", bronze_lookback=30,
                 activity_lookback=30)
    assert _counts(t2) == first
    assert sorted(map(tuple, t2["user_activity"].collect())) == activity
    # a normal daily run (3-day event log) rewrites only its window: history stays
    t3 = run_all(spark, views, "2024-01-31", database="tally_t1")
    assert _counts(t3) == first
    assert t3["user_activity"].count() == len(activity)


def test_daily_runs_keep_history(spark):
    """Daily runs with default look-backs equal one run over the whole history."""
    raw = RawTables(spark, "/root/testdata/sf0.001")
    views = {v: raw[v] for v in VIEWS}
    run_all(spark, views, "2024-01-23", database="tally_t2", bronze_lookback=30, activity_lookback=30,
            validate=False)
    for day in ("2024-01-24", "2024-01-25"):
        daily = run_all(spark, views, day, database="tally_t2", validate=False)
    whole = run_all(spark, views, "2024-01-25", database="tally_t3", bronze_lookback=30,
                    activity_lookback=30, validate=False)
    for name in ("daily_event_counts", "subscription_periods", "subscription_events",
                 "subscription_summary", "period_calc", "billing_events"):
        cols = sorted(whole[name].columns)
        days = "metric_date > '2024-01-01'" if name == "daily_event_counts" else "true"
        got, want = ([tuple(map(str, r)) for r in t[name].filter(days).select(*cols).collect()]
                     for t in (daily, whole))
        assert sorted(got) == sorted(want), name
