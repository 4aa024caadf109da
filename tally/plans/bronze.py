"""Bronze jobs: the indexed event log (J1) and subscription staging."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.time import as_timestamp, day_start_epoch, epoch_to_ts, ts_lit
from tally.operators.ordered import Prefix, sequence_index
from tally.operators.transitions import classify_transitions
from tally.operators.union import union_sources

EVENT_LOG_COLUMNS = ["event_id", "user_id", "event_type", "event_payload", "event_source",
                     "event_ts", "event_date", "source_created_at", "idx", "idx_inverse",
                     "user_event_count"]

# Subscription event types and their transition classes.
SUBSCRIPTION_EVENT_TYPES = ("subscription_created", "subscription_upgraded",
                            "subscription_downgraded", "subscription_cancelled",
                            "subscription_renewed")
TRANSITION_RULES = (
    ("subscription_upgraded", "upgrade"),
    ("subscription_downgraded", "downgrade"),
    ("subscription_cancelled", "churn"),
    ("subscription_renewed", "renewal"),
)

STAGING_COLUMNS = ["user_id", "plan_id", "prev_plan_id", "period_start", "period_end",
                   "transition_type", "amount_cents", "currency", "transaction_status",
                   "event_seq", "period_days", "is_open"]


def event_log(user_events: DataFrame, system_events: DataFrame, api_events: DataFrame,
              as_of: str | dt.date, lookback_days: int | None = 3,
              index: bool = True) -> DataFrame:
    """The three event sources in one indexed log.

    * look-back on the raw ``epoch_ts`` (pushed into each parquet scan);
      ``lookback_days=None`` keeps the whole history;
    * NULL ``user_id`` becomes -1 for system and api events (user events keep NULL);
    * per user: ``idx`` (1 = oldest), ``idx_inverse`` (1 = newest) and the
      count, ordered by (epoch_ts, event_source, event_id) so ties are stable.

    The per-user index comes from prefix offsets over ranges of each user's
    order, so the anonymous user -1 does not end up in one task.
    ``index=False`` leaves the three index columns out (no shuffle at all):
    the downstream jobs read only the event columns.
    """
    where = None
    if lookback_days is not None:
        where = F.col("epoch_ts") >= F.lit(day_start_epoch(as_of, lookback_days))
    cols = ["event_id", "user_id", "event_type", "event_payload", "epoch_ts", "created_at"]
    union = union_sources(
        {"user": user_events.select(*cols), "system": system_events.select(*cols),
         "api": api_events.select(*cols)},
        "event_source", null_key=("user_id", -1), except_tags=("user",), where=where)
    base = [
        "event_id", "user_id", "event_type", "event_payload", "event_source",
        epoch_to_ts("epoch_ts").alias("event_ts"),
        F.to_date(epoch_to_ts("epoch_ts")).alias("event_date"),
        F.col("created_at").alias("source_created_at")]
    if not index:
        return union.select(*base)
    indexed = sequence_index(
        union, ["user_id"], ["epoch_ts", "event_source", "event_id"],
        idx="idx", idx_inverse="idx_inverse", count="user_event_count")
    return indexed.select(*base, "idx", "idx_inverse", "user_event_count")


def subscription_staging(event_log_df: DataFrame, billing_transactions: DataFrame,
                         as_of_ts: str | dt.datetime) -> DataFrame:
    """Subscription events joined to billing, one row per period.

    ``event_seq`` orders a user's events by (event_ts, event_source, event_id)
    and, for several billing rows of one event, by the billing columns.
    ``period_end`` is the next event's time, or ``as_of_ts`` for the open last
    period (``is_open``). ``period_days`` counts calendar-day boundaries.
    ``transition_type``: ``new`` for a first ``created`` event, then upgrade /
    downgrade / churn / renewal, else ``other``.
    """
    ts_end = ts_lit(as_of_ts if isinstance(as_of_ts, dt.datetime) else as_timestamp(as_of_ts))
    ev = event_log_df.filter(F.col("event_type").isin(*SUBSCRIPTION_EVENT_TYPES)).select(
        "user_id", "event_id", "event_ts", "event_type", "event_source")
    bill = billing_transactions.select(
        "user_id", F.col("reference_event_id").alias("event_id"), "plan_id", "amount_cents",
        "currency", "transaction_status")
    joined = ev.join(bill, ["user_id", "event_id"], "inner")
    seq = sequence_index(
        joined, ["user_id"],
        ["event_ts", "event_source", "event_id", "plan_id", "amount_cents", "currency",
         "transaction_status"],
        idx="event_seq", idx_inverse=None, count=None,
        extra=[Prefix("prev_plan_id", "lag", "plan_id"),
               Prefix("next_event_ts", "lead", "event_ts")])
    classified = classify_transitions(
        seq, "event_type", rules=TRANSITION_RULES,
        first=(F.col("event_seq") == 1) & (F.col("event_type") == "subscription_created"),
        first_label="new", default="other", out="transition_type")
    period_end = F.coalesce(F.col("next_event_ts"), ts_end)
    return classified.select(
        "user_id", "plan_id", "prev_plan_id",
        F.col("event_ts").alias("period_start"),
        period_end.alias("period_end"),
        "transition_type", "amount_cents", "currency", "transaction_status", "event_seq",
        F.datediff(F.to_date(period_end), F.to_date("event_ts")).alias("period_days"),
        F.col("next_event_ts").isNull().alias("is_open"))
