"""Table writers (R16-R18): catalog tables, and versioned tables for windows (see ``versions``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tally.sinks.versions import VersionedTable

MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def replace_table(df: DataFrame, name: str) -> None:
    """Full replace (CREATE TABLE AS / DELETE all + INSERT)."""
    df.write.mode("overwrite").saveAsTable(name)


def write_table(df: DataFrame, name: str, mode: str = "append",
                partition_by: list[str] | None = None) -> bool:
    """``append`` / ``replace`` / ``fail`` (if the table exists).

    An empty input is a no-op (returns False); the check stops at the first
    row. No chunking: partitions are the unit of work.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {sorted(MODES)}, not {mode!r}")
    if df.isEmpty():
        return False
    w = df.write.mode(MODES[mode])
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return True


def window_table(spark: SparkSession, name: str) -> VersionedTable:
    """The versioned table ``name`` (``database.table``) in the warehouse."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return VersionedTable(spark, f"{root}/{name.replace('.', '/')}.versions")


def replace_window_table(spark: SparkSession, name: str, new: DataFrame, date_col: str,
                         lower: str | dt.date) -> VersionedTable:
    """R16 at rest: one commit replaces the window's rows, see ``VersionedTable.replace_window``."""
    table = window_table(spark, name)
    table.replace_window(new, date_col, lower)
    return table
