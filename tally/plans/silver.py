"""Silver jobs: plan dimension (J3), subscription timeline (J4), daily user
activity (J5), weekly actives (J6) and invoice facts (J7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.numeric import round_half
from tally.functions.time import as_date, as_timestamp, date_lit, ts_lit
from tally.operators.activity import bucket_count, first_last_by
from tally.operators.category import dominant_category
from tally.operators.chain import walk_chain
from tally.operators.ordered import Prefix, prefix_aggregate
from tally.operators.pivot import max_columns, pivot_flags

# Plan feature flags, price intervals and plan defaults.
FEATURE_FLAGS = {"sso": "has_sso", "api_access": "has_api_access",
                 "priority_support": "has_priority_support"}
PRICE_INTERVALS = {"month": "monthly_price_cents", "year": "annual_price_cents"}
PLAN_DEFAULTS = {"plan_tier": "standard", "is_active": True, "max_seats": 1, "currency": "USD",
                 "trial_days": 0}

PLAN_INFO_COLUMNS = ["plan_id", "plan_name", "plan_tier", "is_active", "max_seats", "has_sso",
                     "has_api_access", "has_priority_support", "monthly_price_cents",
                     "annual_price_cents", "currency", "trial_days", "created_at", "updated_at"]

PERIOD_COLUMNS = ["user_id", "period_seq", "plan_id", "plan_name", "plan_tier", "period_start",
                  "period_end", "period_days", "transition_type", "prev_plan_tier", "mrr_cents",
                  "is_trial", "is_active", "cumulative_revenue_cents"]

ACTIVITY_COLUMNS = ["user_id", "activity_date", "session_count", "total_events",
                    "first_event_ts", "last_event_ts", "first_event_type", "last_event_type",
                    "active_seconds", "activity_status"]

WEEKLY_COLUMNS = ["week_start", "week_end", "total_active_users", "power_users",
                  "regular_active_users", "low_activity_users", "avg_sessions_per_user",
                  "avg_events_per_user"]

# Line item type -> category, and category priority.
ITEM_CATEGORY = (("subscription", "subscription"), ("addon", "addon"), ("credit", "refund"))
CATEGORY_PRIORITY = ("subscription", "addon", "refund")
BILLING_COLUMNS = ["invoice_id", "user_id", "invoice_date", "invoice_category",
                   "line_item_count", "subtotal_cents", "tax_cents", "total_cents", "currency",
                   "payment_status", "payment_method_type", "paid_at", "refunded_at",
                   "net_revenue_cents"]


def plan_info(plans: DataFrame, plan_features: DataFrame, plan_pricing: DataFrame) -> DataFrame:
    """Live plans with feature flags and current prices, defaults filled.

    Prices: MAX per interval over the rows without ``effective_end`` (over
    all currencies, as defined); currency MAX, trial days MAX.
    """
    base = plans.filter(F.col("deleted_at").isNull()).select(
        "plan_id", "plan_name",
        F.coalesce("plan_tier", F.lit(PLAN_DEFAULTS["plan_tier"])).alias("plan_tier"),
        F.coalesce("is_active", F.lit(PLAN_DEFAULTS["is_active"])).alias("is_active"),
        F.coalesce("max_seats", F.lit(PLAN_DEFAULTS["max_seats"])).alias("max_seats"),
        "created_at", "updated_at")
    flags = pivot_flags(plan_features, "plan_id", "feature_key", FEATURE_FLAGS)
    prices = plan_pricing.filter(F.col("effective_end").isNull()).groupBy("plan_id").agg(
        *max_columns("billing_interval", "price_cents", PRICE_INTERVALS),
        F.max("currency").alias("currency"), F.max("trial_days").alias("trial_days"))
    out = base.join(flags, "plan_id", "left").join(prices, "plan_id", "left")
    return out.select(
        "plan_id", "plan_name", "plan_tier", "is_active", "max_seats",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in FEATURE_FLAGS.values()],
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in PRICE_INTERVALS.values()],
        F.coalesce("currency", F.lit(PLAN_DEFAULTS["currency"])).alias("currency"),
        F.coalesce("trial_days", F.lit(PLAN_DEFAULTS["trial_days"])).alias("trial_days"),
        "created_at", "updated_at")


def subscription_periods(staging: DataFrame, plan_info_df: DataFrame, as_of: str | dt.date,
                         as_of_ts: str | dt.datetime | None = None, lookback_days: int = 90,
                         max_periods: int | None = None, plans: DataFrame | None = None) -> DataFrame:
    """The period chain of users whose first subscription event lies in the
    look-back (all its periods, or ``max_periods``), with plan, previous tier, MRR,
    trial and active flags and running revenue.

    ``is_active``: not a churn, and the period is still open (or ends after
    ``as_of_ts``). MRR: free tier 0, else the amount (one currency assumed).
    ``plans`` (the raw plan table, one plan_info row per plan at most) lets
    the broadcast size check run on the source instead of the dimension.
    """
    now = as_of_ts if isinstance(as_of_ts, dt.datetime) else as_timestamp(as_of_ts, as_of)
    lo = as_timestamp(None, as_date(as_of) - dt.timedelta(days=lookback_days))
    chain = walk_chain(staging, "user_id", "event_seq", "period_start", "period_end",
                       anchor=F.col("period_start") >= ts_lit(lo), max_depth=max_periods)
    dim = plan_info_df.select("plan_id", "plan_name", "plan_tier",
                                                "trial_days")
    # the same dimension frame twice: one broadcast, reused for both roles
    c, pi, pp = chain.alias("c"), dim.alias("pi"), dim.alias("pp")
    j = (c.join(pi, F.col("c.plan_id") == F.col("pi.plan_id"), "left")
          .join(pp, F.col("c.prev_plan_id") == F.col("pp.plan_id"), "left")
          .select("c.*", "pi.plan_name", "pi.plan_tier", "pi.trial_days",
                  F.col("pp.plan_tier").alias("prev_plan_tier")))
    days = F.datediff(F.to_date("period_end"), F.to_date("period_start"))
    mrr = (F.when(F.col("plan_tier") == "free", F.lit(0).cast("long"))
           .when(F.col("currency") == "USD", F.col("amount_cents"))
           .otherwise(F.round(F.col("amount_cents") * F.lit(1.0)).cast("long")))
    trial = F.coalesce((F.col("transition_type") == "new") & (F.col("trial_days") > 0)
                       & (days <= F.col("trial_days")), F.lit(False))
    active = ((F.col("transition_type") != "churn")
              & (F.col("is_open") | (F.col("period_end") > ts_lit(now))))
    enriched = j.select("user_id", "period_seq", "plan_id", "plan_name", "plan_tier",
                        "period_start", "period_end", days.alias("period_days"),
                        "transition_type", "prev_plan_tier", mrr.alias("mrr_cents"),
                        trial.alias("is_trial"), F.coalesce(active, F.lit(False)).alias("is_active"))
    return prefix_aggregate(enriched, ["user_id"], ["period_seq"],
                            [Prefix("cumulative_revenue_cents", "sum", "mrr_cents")]).select(*PERIOD_COLUMNS)


# Activity classes and the weekly columns that count their users.
ACTIVITY_USERS = {"power_user": "power_users", "active": "regular_active_users",
                  "low_activity": "low_activity_users"}


def user_activity(event_log_df: DataFrame, as_of: str | dt.date, lookback_days: int = 7,
                  power: int = 10, active: int = 3) -> DataFrame:
    """One row per (user > 0, day): half-hour sessions, events, first / last
    time and type, active seconds (second boundaries), activity class.

    First / last type use the order (event_ts, event_source, event_id), so
    ties are stable. A single aggregation: partial aggregates per task keep
    a heavy user from reaching one task with all its rows.
    """
    lo = as_date(as_of) - dt.timedelta(days=lookback_days)
    ev = event_log_df.filter((F.col("event_date") >= date_lit(lo)) & (F.col("user_id") > 0))
    first_type, last_type = first_last_by("event_type", ["event_ts", "event_source", "event_id"])
    g = ev.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        bucket_count("event_ts", 30).alias("session_count"),
        F.count(F.lit(1)).alias("total_events"),
        F.min("event_ts").alias("first_event_ts"),
        F.max("event_ts").alias("last_event_ts"),
        first_type.alias("first_event_type"),
        last_type.alias("last_event_type"))
    n = F.col("total_events")
    return g.select(
        *ACTIVITY_COLUMNS[:8],
        (F.unix_timestamp("last_event_ts") - F.unix_timestamp("first_event_ts"))
        .alias("active_seconds"),
        F.when(n >= power, "power_user").when(n >= active, "active")
        .otherwise("low_activity").alias("activity_status"))


def active_users_weekly(user_activity_df: DataFrame, as_of: str | dt.date,
                        lookback_days: int = 28) -> DataFrame:
    """Per Monday week: distinct users, users per class, mean sessions and
    events per (user, class) row. A user with days in two classes counts in
    both classes (groups are (week, user, class), as defined)."""
    d = as_date(as_of) - dt.timedelta(days=lookback_days)
    lo = d - dt.timedelta(days=d.weekday())
    per_user = (user_activity_df.filter(F.col("activity_date") >= date_lit(lo))
                .groupBy(F.trunc("activity_date", "week").alias("week_start"), "user_id",
                         "activity_status")
                .agg(F.sum("session_count").alias("weekly_sessions"),
                     F.sum("total_events").alias("weekly_events")))
    st = F.col("activity_status")
    g = per_user.groupBy("week_start").agg(
        F.countDistinct("user_id").alias("total_active_users"),
        # (week, user, class) rows are unique: count_if is a distinct count
        F.count_if(st == "power_user").alias("power_users"),
        F.count_if(st == "active").alias("regular_active_users"),
        F.count_if(st == "low_activity").alias("low_activity_users"),
        round_half(F.avg("weekly_sessions")).alias("avg_sessions_per_user"),
        round_half(F.avg("weekly_events")).alias("avg_events_per_user"))
    return g.withColumn("week_end", F.date_add("week_start", 6)).select(*WEEKLY_COLUMNS)


def item_category(item_type: str = "item_type", amount: str = "amount_cents"):
    expr = None
    for t, cat in ITEM_CATEGORY:
        cond = F.col(item_type) == F.lit(t)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr.when(F.col(amount) < 0, F.lit("refund")).otherwise(F.lit("other"))


def invoice_summary(line_items: DataFrame) -> DataFrame:
    """Per invoice: dominant category, line count, subtotal (amount x quantity)."""
    return line_items.groupBy("invoice_id").agg(
        dominant_category(item_category(), CATEGORY_PRIORITY, "other").alias("invoice_category"),
        F.count(F.lit(1)).alias("line_item_count"),
        F.sum(F.col("amount_cents") * F.col("quantity")).alias("subtotal_cents"))


def payment_billing(invoices: DataFrame, line_items: DataFrame, payment_methods: DataFrame,
                    as_of: str | dt.date, lookback_days: int | None = 30) -> DataFrame:
    """Invoice facts of the look-back (``None``: all invoices).

    Line items are first reduced to the invoices of the window (left semi
    join), then aggregated; invoices without line items are dropped (inner
    join). Total = subtotal + tax (NULL tax = 0); net revenue: refunded 0,
    completed total, else NULL.
    """
    inv = invoices
    items = line_items
    if lookback_days is not None:
        lo = as_timestamp(None, as_date(as_of) - dt.timedelta(days=lookback_days))
        inv = inv.filter(F.col("invoice_date") >= ts_lit(lo))
        items = items.join(inv.select("invoice_id"), "invoice_id", "left_semi")
    methods = payment_methods.select("payment_method_id", "method_type")
    info = inv.join(methods, "payment_method_id", "left")
    j = info.join(invoice_summary(items), "invoice_id", "inner")
    tax = F.coalesce(F.col("tax_cents"), F.lit(0).cast("long"))
    total = F.col("subtotal_cents") + tax
    status = F.col("status")
    return j.select(
        "invoice_id", "user_id", F.to_date("invoice_date").alias("invoice_date"),
        "invoice_category", "line_item_count", "subtotal_cents", tax.alias("tax_cents"),
        total.alias("total_cents"), F.coalesce("currency", F.lit("USD")).alias("currency"),
        status.alias("payment_status"),
        F.coalesce("method_type", F.lit("unknown")).alias("payment_method_type"),
        "paid_at", "refunded_at",
        F.when(status == "refunded", F.lit(0).cast("long"))
        .when(status == "completed", total).alias("net_revenue_cents"))
