"""Idempotent window replace (DELETE rows >= bound, INSERT new rows)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.functions.time import as_date, date_lit


def replace_window(existing: DataFrame, new: DataFrame, date_col: str,
                   lower: str | dt.date) -> DataFrame:
    """Existing rows before ``lower`` (and rows with a NULL date, which a
    ``DELETE ... WHERE d >= lower`` never removes) plus all new rows.

    Running it again with the same ``new`` gives the same table. Pick
    ``lower`` no earlier than the first day the new rows cover, or history
    inside the gap is lost.
    """
    d = F.col(date_col)
    keep = existing.filter(d.isNull() | (d < date_lit(as_date(lower))))
    return keep.unionByName(new.select(*existing.columns))
