"""Date / time helpers. The session time zone is UTC (see ``tally.session``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    """Parse a job's ``as_of`` parameter."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def as_timestamp(value: str | dt.date | dt.datetime | None,
                 default_date: str | dt.date | None = None) -> dt.datetime:
    """Parse an ``as_of_ts`` parameter; a bare date means its midnight."""
    if value is None:
        value = as_date(default_date)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def day_start_epoch(as_of: str | dt.date, days_back: int = 0) -> int:
    """Epoch seconds of midnight UTC ``days_back`` days before ``as_of``.

    A plain literal, so a filter ``epoch_ts >= day_start_epoch(...)`` reaches
    the parquet scan as a pushed filter.
    """
    d = as_date(as_of) - dt.timedelta(days=days_back)
    return (d - _EPOCH).days * 86400


def epoch_to_ts(col: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (wall clock in UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_seconds(c).cast("timestamp_ntz")


def ts_lit(value: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def date_lit(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")
