"""Cohort jobs (N4-N7). The source system names these jobs and describes them in
one line each; the definitions below are ours.

* N4 ``merged_periods``: exact duplicates dropped, then per (user, plan) the
  periods are merged into islands: a new island starts when a period starts
  after the latest end of all earlier periods (touching periods merge).
* N5 ``cohort_base``: per user the month of the first period start.
* N6 ``retention_matrix``: per (cohort month, month offset) the users active
  in that month (a user is active in every month its periods touch), the
  cohort size and the rate.
* N7 ``revenue_by_cohort``: per (cohort month, revenue month = month of
  period start) the MRR sum and the users with positive MRR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.numeric import round_half
from tally.operators.ordered import Prefix, prefix_aggregate


def merged_periods(periods: DataFrame, keys: Sequence[str] = ("user_id", "plan_id"),
                   start: str = "period_start", end: str = "period_end") -> DataFrame:
    """``(keys..., island_seq, period_start, period_end, period_count)``.

    Gaps-and-islands with a running maximum of the end; both running
    operations work on ranges of the order, so a (user, plan) with a huge
    history is spread over many tasks.
    """
    keys = list(keys)
    d = periods.dropDuplicates()
    order = [start, end, *[c for c in d.columns if c not in (*keys, start, end)]]
    p1 = prefix_aggregate(d, keys, order, [Prefix("_tly_prev_end", "max", end, inclusive=False)])
    p1 = p1.withColumn("_tly_brk", F.when(
        F.col("_tly_prev_end").isNull() | (F.col(start) > F.col("_tly_prev_end")),
        F.lit(1)).otherwise(F.lit(0)))
    p2 = prefix_aggregate(p1, keys, order, [Prefix("island_seq", "sum", "_tly_brk")])
    return p2.groupBy(*keys, "island_seq").agg(
        F.min(start).alias(start), F.max(end).alias(end),
        F.count(F.lit(1)).alias("period_count"))


def cohort_base(periods: DataFrame) -> DataFrame:
    """``(user_id, cohort_month date, first_period_start)``."""
    return periods.groupBy("user_id").agg(F.min("period_start").alias("first_period_start")) \
        .select("user_id", F.trunc("first_period_start", "month").alias("cohort_month"),
                "first_period_start")


def retention_matrix(periods: DataFrame, cohorts: DataFrame) -> DataFrame:
    """``(cohort_month, month_offset, active_users, cohort_size, retention_rate)``.

    Each period becomes the months it touches (bounded by its length), one
    row per (user, month) after ``distinct`` (map-side), then joined to the
    user's cohort. Rate rounded to 4 places.
    """
    # a reversed period touches no month; one without an end touches its first
    ended = F.coalesce("period_end", "period_start")
    months = periods.filter(F.col("period_start") <= ended).select(
        "user_id", F.explode(F.sequence(F.trunc("period_start", "month"),
                                        F.trunc(ended, "month"),
                                        F.expr("INTERVAL 1 MONTH"))).alias("activity_month")
    ).distinct()
    coh = cohorts.select("user_id", "cohort_month")
    active = (months.join(coh, "user_id")
              .groupBy("cohort_month",
                       F.months_between("activity_month", "cohort_month").cast("int")
                       .alias("month_offset"))
              .agg(F.count(F.lit(1)).alias("active_users")))
    size = coh.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return active.join(size, "cohort_month").select(
        "cohort_month", "month_offset", "active_users", "cohort_size",
        round_half(F.col("active_users") / F.col("cohort_size"), 4).alias("retention_rate"))


def revenue_by_cohort(periods: DataFrame, cohorts: DataFrame) -> DataFrame:
    """``(cohort_month, revenue_month, month_offset, revenue_cents, paying_users)``.

    Periods are first reduced to one row per (user, month) -- so a user with
    a huge history sends one row per month to the join, not all its rows.
    """
    per_user = periods.groupBy("user_id", F.trunc("period_start", "month")
                               .alias("revenue_month")).agg(
        F.sum("mrr_cents").alias("mrr_cents"), F.max(F.col("mrr_cents") > 0).alias("paid"))
    j = per_user.join(cohorts.select("user_id", "cohort_month"), "user_id")
    return j.groupBy("cohort_month", "revenue_month").agg(
        F.sum("mrr_cents").alias("revenue_cents"),
        F.count_if(F.col("paid")).alias("paying_users")).select(
        "cohort_month", "revenue_month",
        F.months_between("revenue_month", "cohort_month").cast("int").alias("month_offset"),
        "revenue_cents", "paying_users")
