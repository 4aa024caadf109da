"""Daily batch run of all jobs for one ``as_of`` date.

Storage follows the layers:

* bronze (event log, subscription staging) is per run: written once under
  the shared ``spark.checkpoint.dir`` and read back, so the lineage is cut
  (a lost executor recomputes only the current job) and the event log is
  computed once for all its readers;
* dimension and per-user tables (plan info, periods, summaries, cohorts) are
  fully replaced (R17);
* windowed facts (daily activity, invoices, daily / weekly metrics) are
  versioned tables partitioned by their date and updated with the idempotent
  window replace (R16), one commit each: the partitions of the look-back are
  replaced, history before it is kept, and a second run with the same input
  gives the same tables. A run that stops leaves every table whole;
* subscription histories are kept by change (``history``): only users with
  new, late or corrected events or billing are computed again;
* categorised texts are kept with a ledger of the rows done (``text``).

The delete bound of a windowed table is its job's look-back, never wider
than the data the job reads (the event log's look-back bounds the activity
window), so no history inside the deleted range is lost.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.time import as_date
from tally.operators import bitmaps
from tally.plans import bronze, cohorts, derived, gold, quality, silver, text
from tally.session import materialize
from tally.plans.history import PeriodHistory
from tally.sources import sheets
from tally.sources.dictionaries import load_dictionaries
from tally.sinks.tables import replace_table, replace_window_table, window_table

# The validation rule set of the daily run.
VALIDATION_RULES = {
    "plan_info": [{"type": "not_empty"}, {"type": "no_nulls", "column": "plan_id"},
                  {"type": "unique", "column": "plan_id"}],
    "daily_user_counts": [{"type": "not_empty"},
                          {"type": "row_count_range", "min": 1, "max": 500_000},
                          {"type": "freshness", "column": "metric_date", "max_hours": 48}],
    "billing": [{"type": "not_empty"}, {"type": "no_nulls", "column": "billing_id"}],
    "subscription_summary": [{"type": "not_empty"}],
}

# The columns of the plan sheet.
PLAN_SHEET_SCHEMA = "plan_id long, plan_name string, max_seats int, monthly_price double, is_active boolean, valid_from date"


def run_all(spark: SparkSession, raw: Mapping[str, DataFrame], as_of: str | dt.date,
            as_of_ts: str | dt.datetime | None = None, database: str = "analytics", *,
            bronze_lookback: int | None = 3, activity_lookback: int = 7, gold_lookback: int = 30,
            billing_lookback: int = 30, dictionaries: Mapping[str, list] | None = None,
            dictionary_files: Mapping[str, list[str]] | None = None, plan_sheet: DataFrame | None = None,
            plan_sheet_schema: str = PLAN_SHEET_SCHEMA, plan_sheet_row: str | None = None,
            validate: bool = True, now: str | dt.datetime | None = None) -> dict[str, DataFrame]:
    """Run every job in dependency order; return the tables (as read back).

    ``raw`` maps the raw table names (``user_events``, ``billing_transactions``,
    ``plans``, ``invoices``, ``order_periods``, ``text_*`` ...) to DataFrames.
    ``dictionaries`` maps a text source (``reviews`` ...) to its dictionary,
    ``dictionary_files`` to the JSON files to load it from; ``plan_sheet`` holds
    the plan sheet's string cells (see ``sources.sheets.read_cells``).
    """
    d = as_date(as_of)
    as_of_ts = as_of_ts or f"{d.isoformat()} 00:00:00"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    t: dict[str, DataFrame] = {}

    def staged(name: str, build: Callable[[], DataFrame], sort_by: list[str]) -> DataFrame:
        t[name] = materialize(build(), name, sort_by)
        return t[name]

    def full(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        replace_table(build(), f"{database}.{name}")
        t[name] = spark.table(f"{database}.{name}")
        return t[name]

    def windowed(name: str, date_col: str, lower: dt.date,
                 build: Callable[[], DataFrame]) -> DataFrame:
        t[name] = replace_window_table(spark, f"{database}.{name}", build(), date_col, lower).read()
        return t[name]

    # A window never reaches back further than the data its job reads
    src_lo = d - dt.timedelta(days=bronze_lookback) if bronze_lookback is not None else None

    def clip(lo: dt.date) -> dt.date:
        return max(lo, src_lo) if src_lo else lo

    activity_lo = clip(d - dt.timedelta(days=activity_lookback))
    gold_lo = d - dt.timedelta(days=gold_lookback)
    events_lo = clip(gold_lo)
    week_lo = d - dt.timedelta(days=28)
    week_lo -= dt.timedelta(days=week_lo.weekday())

    staged("event_log", lambda: bronze.event_log(
        raw["user_events"], raw["system_events"], raw["api_events"], d, bronze_lookback),
        ["event_date", "event_ts", "event_source"])
    # subscription events and billed events are kept for good, day by day: sequences, periods
    # and the month's billing need more than one run's look-back, and are a small part of all events
    kept_lo = src_lo or dt.date.min
    kept = ["user_id", "event_id", "event_ts", "event_type", "event_source", "event_date"]
    windowed("subscription_event_log", "event_date", kept_lo, lambda: t["event_log"].filter(
        F.col("event_type").isin(*bronze.SUBSCRIPTION_EVENT_TYPES)).select(*kept))
    windowed("billed_event_log", "event_date", kept_lo, lambda: t["event_log"].join(
        raw["billing_transactions"].withColumnRenamed("reference_event_id", "event_id"),
        ["user_id", "event_id"], "left_semi").select(*kept))
    history = PeriodHistory(spark, window_table(spark, f"{database}.subscription_history").path)
    history.update(t["subscription_event_log"], raw["billing_transactions"])
    staged("subscription_staging", lambda: history.staging(as_of_ts), ["user_id", "period_start"])
    full("plan_info", lambda: silver.plan_info(raw["plans"], raw["plan_features"],
                                               raw["plan_pricing"]))
    full("subscription_periods", lambda: silver.subscription_periods(
        t["subscription_staging"], t["plan_info"], d, as_of_ts, plans=raw["plans"]))
    windowed("user_activity", "activity_date", activity_lo, lambda: silver.user_activity(
        t["event_log"], d, (d - activity_lo).days))
    windowed("daily_user_bitmaps", "activity_date", activity_lo, lambda: bitmaps.build(
        t["user_activity"], ["activity_date", "activity_status"], "user_id"))
    windowed("active_users_weekly", "week_start", week_lo, lambda: silver.active_users_weekly(
        t["user_activity"], d))
    windowed("payment_billing", "invoice_date", d - dt.timedelta(days=billing_lookback),
             lambda: silver.payment_billing(raw["invoices"], raw["invoice_line_items"],
                                            raw["payment_methods"], d, billing_lookback))
    counts = window_table(spark, f"{database}.daily_event_counts")
    stored = counts.read() if counts.exists() else None
    windowed("daily_event_counts", "metric_date", events_lo, lambda: gold.daily_event_counts(
        t["event_log"], d, (d - events_lo).days, stored))
    windowed("daily_user_counts", "metric_date", gold_lo, lambda: gold.daily_user_counts(
        t["user_activity"], t["subscription_periods"], d, gold_lookback))
    windowed("daily_revenue_counts", "metric_date", gold_lo, lambda: gold.daily_revenue_counts(
        t["payment_billing"], t["subscription_periods"], d, gold_lookback))
    full("billing_events", lambda: derived.billing_events(
        t["billed_event_log"], raw["billing_transactions"], d))
    full("subscription_events_enriched", lambda: derived.subscription_events_enriched(
        t["subscription_staging"], t["plan_info"], raw["plans"]))
    full("period_calc", lambda: derived.period_calc(t["subscription_staging"]))
    full("user_accounts", lambda: derived.user_accounts(t["event_log"],
                                                        t["subscription_periods"]))
    windowed("daily_signups", "metric_date", events_lo, lambda: derived.daily_signups(
        t["subscription_staging"], d, (d - events_lo).days))
    full("billing", lambda: derived.billing(t["payment_billing"]))
    full("subscription_events", lambda: derived.subscription_events(t["subscription_staging"]))
    full("payment_history", lambda: derived.payment_history(t["payment_billing"]))
    full("subscription_summary", lambda: derived.subscription_summary(t["subscription_periods"]))
    if "order_periods" in raw:
        full("merged_periods", lambda: cohorts.merged_periods(raw["order_periods"]))
        full("cohort_base", lambda: cohorts.cohort_base(raw["order_periods"]))
        full("retention_matrix", lambda: cohorts.retention_matrix(raw["order_periods"],
                                                                  t["cohort_base"]))
        full("revenue_by_cohort", lambda: cohorts.revenue_by_cohort(raw["order_periods"],
                                                                    t["cohort_base"]))
    if dictionary_files:
        loaded = {src: load_dictionaries(spark, paths) for src, paths in dictionary_files.items()}
        dictionaries = {**loaded, **(dictionaries or {})}
    for src, dictionary in (dictionaries or {}).items():
        if f"text_{src}" in raw:
            name = f"{src}_categories"
            t[name] = text.categorize_into(window_table(spark, f"{database}.{name}"), raw[f"text_{src}"], dictionary,
                                           text.CATEGORY_TYPES.get(src, src), text.DELETE_FLAGS.get(src, True))
    if plan_sheet is not None:
        rows, rejects = sheets.parse_cells(plan_sheet, plan_sheet_schema, row=plan_sheet_row)
        full("plan_master", lambda: rows)
        full("plan_master_rejects", lambda: rejects)
    if validate:
        for table, rules in VALIDATION_RULES.items():
            quality.validate(t[table], table, rules, now or as_of_ts)
    return t
