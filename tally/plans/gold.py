"""Gold jobs: daily event counts (J8), daily user counts (J9), daily revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.numeric import guarded_pct, round_half
from tally.functions.time import as_date, date_lit

DAILY_EVENT_COLUMNS = ["metric_date", "total_events", "user_events", "system_events",
                       "api_events", "unique_users", "prev_day_total_events", "dod_change_pct"]


def change_pct(df: DataFrame, col: str, order: str, direction: str = "lag", *,
               other: str | None = None, out: str = "dod_change_pct") -> DataFrame:
    """Period-over-period change in percent over a small, aggregated frame.

    ``lag``: compares with the previous row; ``other`` (default
    ``prev_<col>``) holds the previous value, 0 when absent, and the change is
    0.00 when there is no or a zero base.
    ``lead``: compares the next row with this one; ``other`` (default
    ``next_<col>``) is NULL on the last row, so is the change; a zero base
    gives 0.00.

    The window has no partition: it is meant for per-day results of a bounded
    date range (a few hundred rows), never for raw rows.
    """
    w = Window.orderBy(order)
    if direction == "lag":
        other = other or f"prev_{col}"
        prev = F.lag(col).over(w)
        return (df.withColumn("_tly_prev", prev)
                  .withColumn(out, guarded_pct(F.col(col), F.col("_tly_prev"),
                                               zero_base=F.lit(0.0)))
                  .withColumn(other, F.coalesce(F.col("_tly_prev"), F.lit(0)))
                  .drop("_tly_prev"))
    if direction == "lead":
        other = other or f"next_{col}"
        nxt = F.lead(col).over(w)
        return (df.withColumn(other, nxt)
                  .withColumn(out, F.when(F.col(col) == 0, F.lit(0.0)).otherwise(
                      round_half((F.col(other) - F.col(col)).cast("double")
                                 / F.col(col).cast("double") * 100.0))))
    raise ValueError(f"direction must be 'lag' or 'lead', not {direction!r}")


def daily_event_counts(event_log_df: DataFrame, as_of: str | dt.date,
                       lookback_days: int = 30, stored: DataFrame | None = None) -> DataFrame:
    """Per day totals by source, distinct users (> 0), previous day, change %.

    ``stored`` (rows of this job's own table) gives the first day its previous
    day, if that lies before the look-back.
    """
    lo = as_date(as_of) - dt.timedelta(days=lookback_days)
    daily = (event_log_df.filter(F.col("event_date") >= date_lit(lo))
             .groupBy(F.col("event_date").alias("metric_date"))
             .agg(F.count(F.lit(1)).alias("total_events"),
                  F.count_if(F.col("event_source") == "user").alias("user_events"),
                  F.count_if(F.col("event_source") == "system").alias("system_events"),
                  F.count_if(F.col("event_source") == "api").alias("api_events"),
                  F.countDistinct(F.when(F.col("user_id") > 0, F.col("user_id")))
                  .alias("unique_users")))
    if stored is not None:
        before = stored.filter(F.col("metric_date") < date_lit(lo)).select(*daily.columns)
        daily = daily.unionByName(before)
    out = change_pct(daily, "total_events", "metric_date", "lag",
                     other="prev_day_total_events")
    return out.filter(F.col("metric_date") >= date_lit(lo)).select(*DAILY_EVENT_COLUMNS)


DAILY_USER_COLUMNS = ["metric_date", "new_users", "returning_users", "total_active_users",
                      "churned_users", "cumulative_users", "next_day_active_users",
                      "dod_change_pct"]

DAILY_REVENUE_COLUMNS = ["metric_date", "total_revenue_cents", "subscription_revenue_cents",
                         "addon_revenue_cents", "refund_cents", "net_revenue_cents", "mrr_cents",
                         "arr_cents", "free_tier_users", "standard_tier_users",
                         "premium_tier_users", "enterprise_tier_users", "paying_users",
                         "arpu_cents"]

# Billed statuses and plan tiers.
BILLED_STATUSES = ("completed", "refunded")
TIERS = ("free", "standard", "premium", "enterprise")


def daily_user_counts(user_activity_df: DataFrame, periods: DataFrame, as_of: str | dt.date,
                      lookback_days: int = 30) -> DataFrame:
    """Per activity day: new, returning, active and churned users,
    cumulative new users (over the loaded days), next day's actives and the
    change to it in percent (NULL on the last day).

    The activity rows are joined to the periods containing the day (equi on
    user, range residual). Conditional distinct counts are computed as one
    row per (day, user) with class flags, then ``count_if``: no Expand.
    """
    from tally.operators.periods import join_containing

    lo = as_date(as_of) - dt.timedelta(days=lookback_days)
    act = user_activity_df.filter(F.col("activity_date") >= date_lit(lo)).select(
        "user_id", "activity_date")
    per = periods.select("user_id", "period_seq", "period_start", "period_end",
                         "transition_type")
    j = join_containing(act, "activity_date", per, "period_start", "period_end", "user_id")
    day = F.col("activity_date")
    start_d, end_d = F.to_date("period_start"), F.to_date("period_end")
    per_user = j.groupBy("activity_date", "user_id").agg(
        F.max((F.col("period_seq") == 1) & (start_d == day)).alias("is_new"),
        F.max((F.col("period_seq") > 1) | (start_d < day)).alias("is_returning"),
        F.max((F.col("transition_type") == "churn") & (end_d == day)).alias("is_churned"))
    daily = per_user.groupBy(F.col("activity_date").alias("metric_date")).agg(
        F.count_if(F.col("is_new")).alias("new_users"),
        F.count_if(F.col("is_returning")).alias("returning_users"),
        F.count(F.lit(1)).alias("total_active_users"),
        F.count_if(F.col("is_churned")).alias("churned_users"))
    w = Window.orderBy("metric_date")
    out = daily.withColumn("cumulative_users", F.sum("new_users").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    out = change_pct(out, "total_active_users", "metric_date", "lead",
                     other="next_day_active_users")
    return out.select(*DAILY_USER_COLUMNS)


def daily_revenue_counts(payment_billing_df: DataFrame, periods: DataFrame,
                         as_of: str | dt.date, lookback_days: int = 30,
                         point_in_time: bool = False) -> DataFrame:
    """Per day of the window: billed revenue by category, MRR / ARR and
    users per tier from the periods covering the day, ARPU.

    Default: periods flagged ``is_active`` today count on every day they
    cover (as defined). ``point_in_time=True``: every non-churn period
    covering the day counts, open or not.

    Periods are clipped to the window and exploded into days (no range join);
    per-tier distinct users come from one row per (day, user) with tier flags.
    """
    from tally.operators.periods import count_ids_by_day, merge_metrics, sum_by_day

    hi = as_date(as_of)
    lo = hi - dt.timedelta(days=lookback_days)
    cat = F.col("invoice_category")
    total = F.col("total_cents")
    zero = F.lit(0).cast("long")
    billing = (payment_billing_df
               .filter((F.col("invoice_date") >= date_lit(lo))
                       & F.col("payment_status").isin(*BILLED_STATUSES))
               .groupBy(F.col("invoice_date").alias("metric_date"))
               .agg(F.sum(total).alias("total_revenue_cents"),
                    F.sum(F.when(cat == "subscription", total).otherwise(zero))
                    .alias("subscription_revenue_cents"),
                    F.sum(F.when(cat == "addon", total).otherwise(zero))
                    .alias("addon_revenue_cents"),
                    F.sum(F.when(cat == "refund", F.abs(total)).otherwise(zero))
                    .alias("refund_cents"),
                    F.sum(F.coalesce(F.col("net_revenue_cents"), zero))
                    .alias("net_revenue_cents")))
    live = (F.col("transition_type") != "churn") if point_in_time else F.col("is_active")
    tier, per = F.col("plan_tier"), periods.filter(live)
    sums = sum_by_day(per, "period_start", "period_end", {"mrr_cents": F.col("mrr_cents")}, lo, hi)
    users = count_ids_by_day(per, "period_start", "period_end", "user_id",
                             {**{f"{t}_tier_users": tier == t for t in TIERS}, "paying_users": tier != "free"}, lo, hi)
    mrr = sums.join(users, "metric_date")
    m = merge_metrics(billing, mrr, "metric_date", fill=0)
    paying = F.col("paying_users")
    return m.select(
        *DAILY_REVENUE_COLUMNS[:7],
        (F.col("mrr_cents") * 12).alias("arr_cents"),
        *DAILY_REVENUE_COLUMNS[8:13],
        F.when(paying == 0, F.lit(0.0)).otherwise(
            round_half(F.col("mrr_cents").cast("double") / paying.cast("double")))
        .alias("arpu_cents"))
