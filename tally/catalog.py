"""Named queries over the driver's test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and runs one job or operator
over the raw views of ``tally.sources.fixtures`` (whole tables). The test clock
is ``AS_OF``; bronze and activity look-backs are 30 days so that the gold
jobs see the whole month of events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tally.plans import bronze, cohorts, derived, gold, operator_runs as ops, silver, text
from tally.session import materialize, utc_session
from tally.sources.fixtures import RawTables

# Test clock and look-backs of the registered queries.
AS_OF = "2024-01-31"
AS_OF_TS = "2024-01-31 00:00:00"
BRONZE_LOOKBACK = 30
ACTIVITY_LOOKBACK = 30

# The test dictionary (ordered).
TEST_DICTIONARY = [("motion", ["from", "with"]), ("quality", ["tion", "thon"]),
                   ("people", ["ther"])]

Query = Callable[[SparkSession, str], DataFrame]


_RAW: dict[tuple[SparkSession, str], RawTables] = {}


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """The raw view definitions of one session and folder, parsed once.

    Only the (lazy) view plans are shared between queries; every query
    still reads and computes everything from the parquet files.
    """
    key = (spark, sf_dir.rstrip("/"))
    if key not in _RAW:
        _RAW[key] = RawTables(spark, sf_dir)
    utc_session(spark)  # the jobs convert epochs in UTC; re-pin on every query
    return _RAW[key]


class Pipeline:
    """Lazily composed jobs over one set of raw tables (one plan per frame)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.raw = raw_tables(spark, sf_dir)
        self.spark = self.raw.spark
        self.as_of = AS_OF
        self.as_of_ts = AS_OF_TS
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def indexed_event_log(self) -> DataFrame:
        r = self.raw
        return self._get("indexed_event_log", lambda: bronze.event_log(
            r["user_events"], r["system_events"], r["api_events"], AS_OF, BRONZE_LOOKBACK))

    @property
    def event_log(self) -> DataFrame:
        """The event log without the per-user index columns (no job below reads them)."""
        r = self.raw
        return self._get("event_log", lambda: bronze.event_log(
            r["user_events"], r["system_events"], r["api_events"], AS_OF, BRONZE_LOOKBACK,
            index=False))

    @property
    def staging(self) -> DataFrame:
        """Written once under ``spark.checkpoint.dir`` and read back (lineage cut):
        the chain walk and most downstream jobs read it more than once."""
        return self._get("staging", lambda: materialize(bronze.subscription_staging(
            self.event_log, self.raw["billing_transactions"], AS_OF_TS), "staging"))

    @property
    def plan_info(self) -> DataFrame:
        r = self.raw
        return self._get("plan_info", lambda: silver.plan_info(
            r["plans"], r["plan_features"], r["plan_pricing"]))

    @property
    def periods(self) -> DataFrame:
        return self._get("periods", lambda: silver.subscription_periods(
            self.staging, self.plan_info, AS_OF, AS_OF_TS, 90, None, plans=self.raw["plans"]))

    @property
    def activity(self) -> DataFrame:
        return self._get("activity", lambda: silver.user_activity(
            self.event_log, AS_OF, ACTIVITY_LOOKBACK))

    def billing(self, lookback_days: int | None = 30) -> DataFrame:
        r = self.raw
        return self._get(f"billing_{lookback_days}", lambda: silver.payment_billing(
            r["invoices"], r["invoice_line_items"], r["payment_methods"], AS_OF,
            lookback_days))

    @property
    def cohorts(self) -> DataFrame:
        return self._get("cohorts", lambda: cohorts.cohort_base(self.raw["order_periods"]))


def _q(fn: Callable[[Pipeline], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Pipeline(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    "event_log": _q(lambda p: p.indexed_event_log),
    "subscription_staging": _q(lambda p: p.staging),
    "daily_event_counts": _q(lambda p: gold.daily_event_counts(p.event_log, AS_OF, 30)),
    "plan_info": _q(lambda p: p.plan_info),
    "subscription_periods": _q(lambda p: p.periods),
    "user_activity": _q(lambda p: p.activity),
    "active_users_weekly": _q(lambda p: silver.active_users_weekly(p.activity, AS_OF, 28)),
    "payment_billing": _q(lambda p: p.billing(30)),
    "daily_user_counts": _q(lambda p: gold.daily_user_counts(p.activity, p.periods, AS_OF, 30)),
    "daily_revenue_counts": _q(lambda p: gold.daily_revenue_counts(
        p.billing(30), p.periods, AS_OF, 30)),
    "daily_revenue_point_in_time": _q(lambda p: gold.daily_revenue_counts(
        p.billing(30), p.periods, AS_OF, 30, point_in_time=True)),
    **{f"categorize_{src}": _q(lambda p, src=src, ct=ct: text.categorize_text(
        p.raw[f"text_{src}"], TEST_DICTIONARY, ct)) for src, ct in text.CATEGORY_TYPES.items()},
    "extract_terms": _q(lambda p: text.term_table(p.raw["text_documents"])),
    "match_categories": _q(lambda p: text.category_table(p.raw["text_turns"], TEST_DICTIONARY)),
    "billing_events": _q(lambda p: derived.billing_events(
        p.event_log, p.raw["billing_transactions"], AS_OF)),
    "subscription_events_enriched": _q(lambda p: derived.subscription_events_enriched(
        p.staging, p.plan_info, p.raw["plans"])),
    "period_calc": _q(lambda p: derived.period_calc(p.staging)),
    "merged_periods": _q(lambda p: cohorts.merged_periods(p.raw["order_periods"])),
    "cohort_base": _q(lambda p: p.cohorts),
    "retention_matrix": _q(lambda p: cohorts.retention_matrix(p.raw["order_periods"],
                                                              p.cohorts)),
    "revenue_by_cohort": _q(lambda p: cohorts.revenue_by_cohort(p.raw["order_periods"],
                                                                p.cohorts)),
    "user_accounts": _q(lambda p: derived.user_accounts(p.event_log, p.periods)),
    "daily_signups": _q(lambda p: derived.daily_signups(p.staging, AS_OF, 30)),
    "billing": _q(lambda p: derived.billing(p.billing(None))),
    "subscription_events": _q(lambda p: derived.subscription_events(p.staging)),
    "payment_history": _q(lambda p: derived.payment_history(p.billing(None))),
    "subscription_summary": _q(lambda p: derived.subscription_summary(p.periods)),
    # reusable operators on whole tables
    "union_sources": _q(ops.union_events),
    "sequence_index": _q(ops.invoice_sequence),
    "transitions": _q(ops.period_transitions),
    "pivot_flags": _q(ops.feature_flags),
    "pivot_max": _q(ops.price_pivot),
    "walk_chain": _q(ops.chain_walk),
    "chain_links": _q(ops.chain_links),
    "subscription_periods_incremental": _q(ops.incremental_periods),
    "active_by_hour": _q(ops.active_by_hour),
    "categorize_incremental": _q(lambda p: ops.incremental_categories(p, TEST_DICTIONARY)),
    "load_dictionaries": _q(ops.dictionaries),
    "load_sheet": _q(ops.sheet_rows),
    "load_sheet_rejects": _q(ops.sheet_rejects),
    "session_buckets": _q(ops.session_buckets),
    "first_last_by": _q(ops.first_last),
    "active_by_day": _q(ops.active_by_day),
    "point_in_period": _q(ops.point_in_period),
    "dominant_category": _q(ops.invoice_categories),
    "running_total": _q(ops.global_running_total),
    "dod_change_lag": _q(ops.dod_lag),
    "dod_change_lead": _q(ops.dod_lead),
    "tier_users": _q(ops.tier_users),
    "weekly_users_from_days": _q(ops.weekly_from_days),
    "tier_users_from_days": _q(ops.tiers_from_days),
    "merge_metrics": _q(ops.merged_daily),
    "replace_window": _q(ops.window_replace),
    # data-quality rules
    "dq_not_empty": _q(lambda p: ops.dq(p, "subscription_summary", [{"type": "not_empty"}])),
    "dq_row_count": _q(lambda p: ops.dq(p, "daily_user_counts", [
        {"type": "row_count_range", "min": 1, "max": 500_000}])),
    "dq_no_nulls": _q(lambda p: ops.dq(p, "billing", [{"type": "no_nulls",
                                                        "column": "billing_id"}])),
    "dq_unique": _q(lambda p: ops.dq(p, "event_log", [{"type": "unique",
                                                        "column": "event_id"}])),
    "dq_freshness": _q(lambda p: ops.dq(p, "daily_user_counts", [
        {"type": "freshness", "column": "metric_date", "max_hours": 48}])),
    "dq_period_order": _q(lambda p: ops.dq(p, "subscription_periods", [
        {"type": "expression", "condition": "period_start > period_end"}])),
    "dq_unique_key": _q(lambda p: ops.dq(p, "subscription_periods", [
        {"type": "unique_key", "columns": ["user_id", "period_seq"]}])),
    "dq_report": _q(lambda p: ops.dq(p, "subscription_periods", ops.DQ_REPORT_RULES)),
}
