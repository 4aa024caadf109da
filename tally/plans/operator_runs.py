"""The reusable operators (R1-R16, V1-V7) applied to whole tables.

Each function takes a ``tally.catalog.Pipeline`` (raw views plus lazily
built jobs) and returns the operator's output; ``tally.catalog`` registers
them under the operator's key.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.operators import bitmaps
from tally.operators.activity import bucket_count, first_last_by
from tally.operators.category import dominant_category
from tally.operators.chain import walk_chain, walk_links
from tally.operators.counting import count_distinct_by
from tally.operators.intervals import interval_join
from tally.operators.ordered import running_total, sequence_index
from tally.operators.periods import count_ids_by_day, join_containing, merge_metrics, sum_by_day
from tally.operators.pivot import pivot_flags, pivot_max
from tally.operators.replace import replace_window
from tally.operators.transitions import transitions
from tally.operators.union import union_sources
from tally.functions.time import as_date, as_timestamp, date_lit, ts_lit
from tally.plans import derived, gold, quality, silver, text
from tally.plans.history import PeriodHistory
from tally.plans.pipeline import PLAN_SHEET_SCHEMA
from tally.session import checkpoint_dir, materialize
from tally.sinks.versions import VersionedTable
from tally.sources.dictionaries import merge_dictionaries
from tally.sources.sheets import parse_cells

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "event_payload", "epoch_ts", "created_at"]


def union_events(p) -> DataFrame:
    r = p.raw
    return union_sources({t: r[f"{t}_events"].select(*EVENT_COLUMNS)
                          for t in ("user", "system", "api")},
                         "event_source", null_key=("user_id", -1), except_tags=("user",))


def invoice_sequence(p) -> DataFrame:
    inv = p.raw["invoices"].select("invoice_id", "user_id", "invoice_date")
    return sequence_index(inv, ["user_id"], ["invoice_date", "invoice_id"])


def period_transitions(p) -> DataFrame:
    per = p.raw["order_periods"]
    rules = [(F.col("plan_id") > F.col("prev_plan_id"), "upgrade"),
             (F.col("plan_id") < F.col("prev_plan_id"), "downgrade")]
    t = transitions(per, ["user_id"], ["period_start", "plan_id", "period_end", "mrr_cents"],
                    value="plan_id", time="period_start", rules=rules, default="renewal")
    return t.select("user_id", "seq", "plan_id", "prev_plan_id", "period_start",
                    "next_period_start", "transition_type")


def feature_flags(p) -> DataFrame:
    return pivot_flags(p.raw["plan_features"], "plan_id", "feature_key", silver.FEATURE_FLAGS)


def price_pivot(p) -> DataFrame:
    return pivot_max(p.raw["plan_pricing"], "plan_id", "billing_interval", "price_cents",
                     silver.PRICE_INTERVALS)


def chain_walk(p) -> DataFrame:
    lo = as_timestamp(None, dt.date.fromisoformat(p.as_of) - dt.timedelta(days=90))
    c = walk_chain(p.staging, "user_id", "event_seq", "period_start", "period_end",
                   anchor=F.col("period_start") >= ts_lit(lo))
    return c.select("user_id", "period_seq", "plan_id", "period_start", "period_end")


def chain_links(p) -> DataFrame:
    return walk_links(p.raw["order_links"], ["user_id"], "period_start", "period_end",
                      anchor=F.col("is_first")).select(
        "order_id", "user_id", "period_start", "period_end", "period_seq")


def session_buckets(p) -> DataFrame:
    return p.event_log.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        bucket_count("event_ts", 30).alias("session_count"))


def first_last(p) -> DataFrame:
    first, last = first_last_by("event_type", ["event_ts", "event_source", "event_id"])
    return p.event_log.groupBy("user_id", F.col("event_date").alias("activity_date")).agg(
        first.alias("first_event_type"), last.alias("last_event_type"))


def active_by_day(p) -> DataFrame:
    per = p.raw["order_periods"]
    sums = sum_by_day(per, "period_start", "period_end", {"active_periods": F.lit(1), "mrr_cents": F.col("mrr_cents")})
    users = count_ids_by_day(per, "period_start", "period_end", "user_id", {"active_users": F.lit(True)})
    return sums.join(users, "metric_date").select("metric_date", "active_periods", "active_users", "mrr_cents")


def point_in_period(p) -> DataFrame:
    act = p.activity.select("user_id", "activity_date")
    per = p.periods.select("user_id", "period_seq", "plan_id", "period_start", "period_end")
    return join_containing(act, "activity_date", per, "period_start", "period_end",
                           "user_id").select("user_id", "activity_date", "period_seq", "plan_id")


def incremental_periods(p) -> DataFrame:
    """J4 after three daily runs, each with the events known by its day (the last one: all)."""
    history = PeriodHistory(p.spark, f"{checkpoint_dir(p.spark)}/tally-history/{uuid.uuid4().hex}")
    for day in ("2024-01-15", "2024-01-25", None):
        known = p.event_log if day is None else p.event_log.filter(F.col("event_date") <= F.lit(day).cast("date"))
        history.update(known, p.raw["billing_transactions"])
    return silver.subscription_periods(history.staging(p.as_of_ts), p.plan_info, p.as_of, p.as_of_ts, 90, None,
                                       plans=p.raw["plans"])


def active_by_hour(p) -> DataFrame:
    """Periods open at each full hour that lies in the periods' own span, and their amounts."""
    per = p.staging.select("period_start", "period_end", "amount_cents")
    span = per.agg(F.min("period_start").alias("lo"), F.max("period_end").alias("hi"))
    hours = span.select(F.explode(F.sequence(
        F.date_trunc("hour", F.col("lo").cast("timestamp")), F.col("hi").cast("timestamp"),
        F.expr("INTERVAL 1 HOUR"))).alias("at")).select(F.col("at").cast("timestamp_ntz").alias("metric_hour"))
    pairs = interval_join(hours, "metric_hour", per, "period_start", "period_end")
    return pairs.groupBy("metric_hour").agg(F.count(F.lit(1)).alias("active_periods"),
                                            F.sum("amount_cents").alias("amount_cents"))


def dictionaries(p) -> DataFrame:
    return merge_dictionaries(p.raw["dictionary_files"]).select(
        F.col("ord").cast("long").alias("ord"), "category", F.array_join("keywords", ",").alias("keywords"))


def incremental_categories(p, dictionary) -> DataFrame:
    """All documents' categories, stored in two runs: first one text source, then all of them."""
    table = VersionedTable(p.spark, f"{checkpoint_dir(p.spark)}/tally-categories/{uuid.uuid4().hex}")
    for source in ("text_faq", "text_documents"):
        stored = text.categorize_into(table, p.raw[source], dictionary, text.CATEGORY_TYPES["faq"], delete_flag=False)
    return stored.select("id", "category", "category_type", F.sha2(F.col("nouns").cast("binary"), 256).alias("nouns_sha256"))


def sheet_rows(p) -> DataFrame:
    return parse_cells(p.raw["plan_sheet"], PLAN_SHEET_SCHEMA)[0]


def sheet_rejects(p) -> DataFrame:
    return parse_cells(p.raw["plan_sheet"], PLAN_SHEET_SCHEMA, row="sheet_row")[1]


def invoice_categories(p) -> DataFrame:
    return p.raw["invoice_line_items"].groupBy("invoice_id").agg(
        dominant_category(silver.item_category(), silver.CATEGORY_PRIORITY, "other")
        .alias("invoice_category"))


def global_running_total(p) -> DataFrame:
    b = p.billing(None).select("invoice_id", "invoice_date", "total_cents")
    return running_total(b, "total_cents", ["invoice_date", "invoice_id"],
                         name="running_total_cents")


def _daily_invoices(p) -> DataFrame:
    return p.billing(None).groupBy(F.col("invoice_date").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("invoices"))


def dod_lag(p) -> DataFrame:
    return gold.change_pct(_daily_invoices(p), "invoices", "metric_date", "lag").select(
        "metric_date", "invoices", "prev_invoices", "dod_change_pct")


def dod_lead(p) -> DataFrame:
    return gold.change_pct(_daily_invoices(p), "invoices", "metric_date", "lead").select(
        "metric_date", "invoices", "next_invoices", "dod_change_pct")


def tier_users(p) -> DataFrame:
    plans = p.raw["plans"].select("plan_id", "plan_tier")
    per = p.raw["order_periods"].join(plans, "plan_id", "left").withColumn(
        "metric_month", F.trunc("period_start", "month"))
    return count_distinct_by(per, ["metric_month"], "user_id", "plan_tier",
                             {t: f"{t}_users" for t in gold.TIERS})


def weekly_from_days(p) -> DataFrame:
    """J6's user counts from bitmaps kept per day and class, without going back to the activity rows."""
    days = materialize(bitmaps.build(p.activity, ["activity_date", "activity_status"], "user_id"), "daily-bitmaps")
    lo = as_date(p.as_of) - dt.timedelta(days=28)
    weeks = days.withColumn("week_start", F.trunc("activity_date", "week")).filter(
        F.col("week_start") >= F.trunc(date_lit(lo), "week"))
    return bitmaps.count_ids_by(weeks, ["week_start"], "activity_status", silver.ACTIVITY_USERS, "total_active_users")


def tiers_from_days(p) -> DataFrame:
    """R14's monthly users by tier from bitmaps kept per day and tier."""
    plans = p.raw["plans"].select("plan_id", F.coalesce("plan_tier", F.lit("none")).alias("plan_tier"))
    per = p.raw["order_periods"].join(plans, "plan_id", "left").select(
        "user_id", F.to_date("period_start").alias("day"), F.coalesce("plan_tier", F.lit("none")).alias("plan_tier"))
    days = materialize(bitmaps.build(per, ["day", "plan_tier"], "user_id"), "daily-bitmaps")
    return bitmaps.count_ids_by(days.withColumn("metric_month", F.trunc("day", "month")), ["metric_month"], "plan_tier",
                                {t: f"{t}_users" for t in gold.TIERS})


def merged_daily(p) -> DataFrame:
    started = p.raw["order_periods"].groupBy(
        F.to_date("period_start").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("periods_started"))
    return merge_metrics(_daily_invoices(p), started, "metric_date", fill=0)


def window_replace(p) -> DataFrame:
    existing = gold.daily_event_counts(p.event_log, "2024-01-20", 30)
    new = gold.daily_event_counts(p.event_log, p.as_of, 10)
    return replace_window(existing, new, "metric_date", "2024-01-21")


# --- data quality -------------------------------------------------------

def dq(p, table: str, rules: list[dict]) -> DataFrame:
    frames = {
        "subscription_summary": lambda: derived.subscription_summary(p.periods),
        "daily_user_counts": lambda: gold.daily_user_counts(p.activity, p.periods, p.as_of, 30),
        "billing": lambda: derived.billing(p.billing(None)),
        "event_log": lambda: p.event_log,
        "subscription_periods": lambda: p.periods,
        "plan_info": lambda: p.plan_info,
    }
    return quality.check(frames[table](), table, rules, p.as_of_ts)


# Rule sets of the registered checks (the report one mixes passing and failing rules).
DQ_REPORT_RULES = [
    {"type": "not_empty"},
    {"type": "no_nulls", "column": "user_id"},
    {"type": "unique", "column": "user_id"},
    {"type": "unique_key", "columns": ["user_id", "period_seq"]},
    {"type": "expression", "condition": "period_start > period_end"},
    {"type": "freshness", "column": "period_start", "max_hours": 48},
    {"type": "row_count_range", "min": 1},
]
