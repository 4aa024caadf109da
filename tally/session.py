"""Spark session helpers.

Every job is a pure ``DataFrame -> DataFrame`` function; the only session
requirement is a UTC session time zone, because epoch seconds are turned into
timestamps and back.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture for error messages costs several JVM round trips per
    # column function while the plans are built; off for batch jobs
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app: str = "tally", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    utc_session(spark)
    return spark


def utc_session(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (epoch <-> timestamp conversions)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``; only when it is unset in a local session
    (tests) a scratch folder is created and registered. A cluster must name one,
    as its executors do not see each other's local folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tally-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df, name: str, sort_by: list[str] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the frame once (an
    eager reliable checkpoint computes it twice unless it is also cached), and
    the readers get a columnar scan with pushdown. ``sort_by`` sorts within
    each partition (no shuffle) so that the row-group statistics let later
    filters on those columns skip data.
    """
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tally-tables/{name}-{uuid.uuid4().hex}"
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
