"""Derived facts (N1-N3, N8-N13). The source system names these jobs (and for some
gives a one-line description or a validation rule); the definitions are ours.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.time import as_date, date_lit
from tally.operators.ordered import Prefix, prefix_aggregate
from tally.operators.periods import date_spine


def billing_events(event_log_df: DataFrame, billing_transactions: DataFrame,
                   as_of: str | dt.date) -> DataFrame:
    """Billing transactions whose event lies in the calendar month of ``as_of``."""
    d = as_date(as_of)
    lo = d.replace(day=1)
    hi = (lo + dt.timedelta(days=32)).replace(day=1)
    ev = event_log_df.filter((F.col("event_date") >= date_lit(lo))
                             & (F.col("event_date") < date_lit(hi)))
    bill = billing_transactions.withColumnRenamed("reference_event_id", "event_id")
    return ev.join(bill, ["user_id", "event_id"]).select(
        "user_id", "event_id", "event_ts", "event_type", "plan_id", "amount_cents", "currency",
        "transaction_status")


def subscription_events_enriched(staging: DataFrame, plan_info_df: DataFrame,
                                 plans: DataFrame | None = None) -> DataFrame:
    """Staging rows with the plan's metadata (left join, plan may be unknown)."""
    dim = plan_info_df.select(
        "plan_id", "plan_name", "plan_tier", F.col("is_active").alias("plan_is_active"),
        "monthly_price_cents", "annual_price_cents", "trial_days")
    return staging.join(dim, "plan_id", "left").select(
        "user_id", "event_seq", "plan_id", "prev_plan_id", "transition_type", "period_start",
        "period_end", "amount_cents", "currency", "plan_name", "plan_tier", "plan_is_active",
        "monthly_price_cents", "annual_price_cents", "trial_days")


def period_calc(staging: DataFrame) -> DataFrame:
    """Periods with ``days_active`` and ``is_churned`` (this period or the
    next one is a churn). The next period comes from a LEAD over ``event_seq``."""
    nxt = prefix_aggregate(staging, ["user_id"], ["event_seq"],
                           [Prefix("_tly_next", "lead", "transition_type")])
    churn = (F.col("transition_type") == "churn") | F.coalesce(
        F.col("_tly_next") == "churn", F.lit(False))
    return nxt.select("user_id", "event_seq", "plan_id", "period_start", "period_end",
                      F.col("period_days").alias("days_active"), churn.alias("is_churned"))


def user_accounts(event_log_df: DataFrame, periods: DataFrame) -> DataFrame:
    """Per user > 0: first / last event, event count, distinct sources and
    the plan of the latest subscription period (NULL without periods)."""
    ev = event_log_df.filter(F.col("user_id") > 0).groupBy("user_id").agg(
        F.min("event_ts").alias("first_event_ts"), F.max("event_ts").alias("last_event_ts"),
        F.count(F.lit(1)).alias("event_count"),
        F.countDistinct("event_source").alias("source_count"))
    cur = periods.groupBy("user_id").agg(F.max_by(
        F.struct("plan_id", "plan_tier", "is_active"), F.col("period_seq")).alias("c"))
    return ev.join(cur, "user_id", "left").select(
        "user_id", "first_event_ts", "last_event_ts", "event_count", "source_count",
        F.col("c.plan_id").alias("current_plan_id"),
        F.col("c.plan_tier").alias("current_plan_tier"),
        F.col("c.is_active").alias("subscription_active"))


def daily_signups(staging: DataFrame, as_of: str | dt.date, lookback_days: int = 30) -> DataFrame:
    """Users per date of their first ``new`` transition, zero-filled over
    the days ``as_of - lookback_days`` .. ``as_of``."""
    hi = as_date(as_of)
    lo = hi - dt.timedelta(days=lookback_days)
    first = staging.filter(F.col("transition_type") == "new").groupBy("user_id").agg(
        F.min(F.to_date("period_start")).alias("metric_date"))
    counts = first.groupBy("metric_date").agg(F.count(F.lit(1)).alias("signups"))
    spine = date_spine(staging.sparkSession, lo, hi)
    return spine.join(counts, "metric_date", "left").select(
        "metric_date", F.coalesce("signups", F.lit(0).cast("long")).alias("signups"))


def billing(payment_billing_df: DataFrame) -> DataFrame:
    """Invoice facts keyed by ``billing_id`` with ``is_paid``."""
    cols = [c for c in payment_billing_df.columns if c != "invoice_id"]
    return payment_billing_df.select(
        F.col("invoice_id").alias("billing_id"), *cols,
        (F.col("payment_status") == "completed").alias("is_paid"))


def subscription_events(staging: DataFrame) -> DataFrame:
    """Staging rows that change plan or state (not renewals)."""
    return staging.filter(F.col("transition_type") != "renewal")


def payment_history(payment_billing_df: DataFrame) -> DataFrame:
    """Per user in (invoice_date, invoice_id) order: payment number,
    running net revenue (NULL counted as 0) and days since the previous
    invoice. A heavy payer spans many tasks."""
    net = F.coalesce(F.col("net_revenue_cents"), F.lit(0).cast("long"))
    h = prefix_aggregate(
        payment_billing_df.withColumn("_tly_net", net), ["user_id"], ["invoice_date", "invoice_id"],
        [Prefix("payment_number", "count"),
         Prefix("running_net_revenue_cents", "sum", "_tly_net"),
         Prefix("_tly_prev_date", "lag", "invoice_date")])
    return h.select("user_id", "invoice_id", "invoice_date", "payment_status",
                    "net_revenue_cents", "payment_number", "running_net_revenue_cents",
                    F.datediff("invoice_date", "_tly_prev_date").alias("days_since_prev_payment"))


def subscription_summary(periods: DataFrame) -> DataFrame:
    """One row per user: period count, latest period's plan / tier /
    transition / start and active flag, lifetime MRR."""
    g = periods.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("period_count"),
        F.max_by(F.struct("plan_id", "plan_tier", "transition_type", "period_start", "is_active"),
                 F.col("period_seq")).alias("l"),
        F.sum("mrr_cents").alias("lifetime_revenue_cents"))
    return g.select("user_id", "period_count", F.col("l.plan_id").alias("latest_plan_id"),
                    F.col("l.plan_tier").alias("latest_plan_tier"),
                    F.col("l.transition_type").alias("latest_transition_type"),
                    F.col("l.period_start").alias("latest_period_start"),
                    "lifetime_revenue_cents", F.col("l.is_active").alias("is_active"))
