"""Invariants of the registered jobs on the sf0.01 test tables."""

from pyspark.sql import functions as F

from tally import catalog

SF = "/root/testdata/sf0.01"


def test_event_counts_sum_and_index(spark):
    daily = catalog.QUERIES["daily_event_counts"](spark, SF)
    assert daily.filter("user_events + system_events + api_events != total_events").count() == 0
    log = catalog.QUERIES["event_log"](spark, SF)
    assert log.filter("idx + idx_inverse != user_event_count + 1").count() == 0
    total = daily.agg(F.sum("total_events")).collect()[0][0]
    assert total == log.count()


def test_cumulative_users_monotone(spark):
    rows = catalog.QUERIES["daily_user_counts"](spark, SF).orderBy("metric_date").collect()
    cum = [r["cumulative_users"] for r in rows]
    assert cum == sorted(cum)
    assert cum[-1] == sum(r["new_users"] for r in rows)


def test_periods_chain_and_plans(spark):
    per = catalog.QUERIES["subscription_periods"](spark, SF)
    assert per.filter("period_start > period_end").count() == 0
    plan = catalog.QUERIES["daily_revenue_counts"](spark, SF)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoopJoin" not in plan


def test_no_python_in_any_registered_plan(spark):
    for name, q in catalog.QUERIES.items():
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                     "FlatMapGroupsInPandas"):
            assert node not in plan, (name, node)
