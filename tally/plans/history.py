"""J4's history kept up to date by change: only users with changed events are computed anew.

The stored rows are the subscription staging (J2) of all users, free of the run's
date: an open period has no end yet, and gets the run's time when it is read. A
user's rows carry a fingerprint of the events and billing rows they came from
(their number, and the sums of two hashes of each). A run

1. takes the fingerprints of all users, one map-side combined aggregation, and
   compares them with the stored ones: late, corrected and withdrawn events or
   billing rows all show, whenever they happened;
2. recomputes the sequences of the users that differ (a semi-join, so only their
   events are sorted);
3. appends their rows as one segment of a ``VersionedTable``, in one commit. A
   user's newest segment counts, a user without events left gets an empty mark.

Files of earlier segments are never rewritten; ``compact`` writes the current rows
as one segment when segments have become many. The result equals a run over the
whole history.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.time import as_timestamp, ts_lit
from tally.plans import bronze
from tally.session import materialize
from tally.sinks.versions import SEGMENT, VersionedTable

_PRINT = ["print_rows", "print_a", "print_b"]
_EVENT = ["user_id", "event_id", "event_ts", "event_type", "event_source"]


def fingerprints(events: DataFrame, billing_transactions: DataFrame) -> DataFrame:
    """(user_id, number of rows, two sums of row hashes) over each user's billed subscription events."""
    bill = billing_transactions.select("user_id", F.col("reference_event_id").alias("event_id"), "plan_id",
                                       "amount_cents", "currency", "transaction_status")
    rows = events.filter(F.col("event_type").isin(*bronze.SUBSCRIPTION_EVENT_TYPES)).select(*_EVENT).join(bill, ["user_id", "event_id"])
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rows.columns]
    wide = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias(_PRINT[0]), wide(*cols).alias(_PRINT[1]),
                                       wide(F.lit("b"), *cols).alias(_PRINT[2]))


class PeriodHistory:
    """The subscription staging of all users under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    def _current(self) -> DataFrame:
        rows = self.table.read(segments=True)
        newest = rows.groupBy(F.col("user_id").alias("_tly_user")).agg(F.max(SEGMENT).alias("_tly_newest"))
        return rows.join(newest, (F.col("user_id") == F.col("_tly_user")) & (F.col(SEGMENT) == F.col("_tly_newest"))).drop(
            "_tly_user", "_tly_newest", SEGMENT)

    def changed(self, events: DataFrame, billing_transactions: DataFrame) -> DataFrame:
        """(user_id, fingerprint now) of the users whose input differs from the stored one."""
        now = fingerprints(events, billing_transactions)
        if not self.table.exists():
            return now
        newest = self.table.read(segments=True).groupBy(F.col("user_id").alias("_tly_user")).agg(
            F.max(F.struct(SEGMENT, *_PRINT)).alias("_tly_was"))
        differ = ~F.coalesce(F.struct(*_PRINT) == F.struct(*[f"_tly_was.{c}" for c in _PRINT]), F.lit(False))
        gone = F.col("print_rows").isNull() & F.col("_tly_was.print_rows").isNull()
        return (now.join(newest, F.col("user_id") == F.col("_tly_user"), "full_outer").filter(differ & ~gone)
                .select(F.coalesce("user_id", "_tly_user").alias("user_id"), *_PRINT))

    def update(self, events: DataFrame, billing_transactions: DataFrame) -> int:
        """Bring the history up to the given events (all of them) and billing; the number of users computed."""
        users = materialize(self.changed(events, billing_transactions), "changed-users")
        n = users.count()
        if n == 0 and self.table.exists():
            return 0
        staging = bronze.subscription_staging(events.join(users.select("user_id"), "user_id", "left_semi"),
                                              billing_transactions, "1970-01-01 00:00:00")
        closed = [F.when(~F.col("is_open"), F.col(c)).alias(c) if c in ("period_end", "period_days") else F.col(c)
                  for c in bronze.STAGING_COLUMNS]
        marked = users.join(staging.select(*closed), "user_id", "left")
        self.table.append(marked.select(*bronze.STAGING_COLUMNS, *_PRINT))
        return n

    def compact(self) -> None:
        self.table.replace(self._current().filter("event_seq is not null"))

    def staging(self, as_of_ts: str | dt.datetime) -> DataFrame:
        """The staging as a run at ``as_of_ts`` would make it from the whole history."""
        end = ts_lit(as_of_ts if isinstance(as_of_ts, dt.datetime) else as_timestamp(as_of_ts))
        filled = {"period_end": F.coalesce("period_end", end),
                  "period_days": F.coalesce("period_days", F.datediff(F.to_date(end), F.to_date("period_start")))}
        return self._current().filter("event_seq is not null").select(
            *[filled[c].alias(c) if c in filled else c for c in bronze.STAGING_COLUMNS])
