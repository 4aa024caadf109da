"""Tables whose changes are one atomic commit: written segments and a manifest naming the current ones.

``data/_tly_v=<segment>/`` holds the parquet files of one commit and is never written
again; ``manifests/<number>.json`` lists the parts (a segment, or one partition of
it) that make up the table after that commit. A writer first writes its segment,
then creates the next manifest, which must not exist yet. A job that stops
anywhere before that leaves the table as it was; readers keep the version they
began with. The manifest has one entry per partition, whatever the rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tally.functions.time import as_date, date_lit

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
SEGMENT = "_tly_v"


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version that this one was about to create."""


class VersionedTable:
    """A table under ``path``, a folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._hadoop_path = hadoop.Path
        self._fs = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self._hadoop_path(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest whole manifest (or the one of ``version``); None before the first commit."""
        for name in reversed(self._names("manifests")):
            if not name.endswith(".json") or name.startswith((".", "_")):
                continue
            if version is None or int(name[:-5]) == version:
                text = self.spark.read.text(f"{self.path}/manifests/{name}", wholetext=True).first()
                try:
                    return json.loads(text[0])
                except (TypeError, ValueError):
                    continue  # a writer stopped while creating it: not a commit
        return None

    def exists(self) -> bool:
        return self.manifest() is not None

    def _commit(self, parts: list, schema: StructType, partition: str | None) -> None:
        taken = [int(n[:-5]) for n in self._names("manifests") if n.endswith(".json")]
        version = max(taken, default=0) + 1
        body = json.dumps({"version": version, "schema": schema.json(), "partition": partition, "parts": parts})
        try:
            out = self._fs.create(self._hadoop_path(f"{self.path}/manifests/{version:012d}.json"), False)
        except Exception as e:
            raise ConcurrentCommit(f"version {version} of {self.path}") from e
        out.write(bytearray(body.encode()))
        out.close()

    def _write(self, df: DataFrame, partition: str | None) -> tuple[str, list]:
        """Write one segment; its name and its parts."""
        segment = f"{max([int(n[:-5]) for n in self._names('manifests')], default=0) + 1:012d}-{uuid.uuid4().hex}"
        w = df.write
        if partition:
            w = w.partitionBy(partition)
        w.parquet(f"{self.path}/data/{SEGMENT}={segment}")
        if not partition:
            return segment, [[None, segment]]
        names = [n for n in self._names(f"data/{SEGMENT}={segment}") if n.startswith(f"{partition}=")]
        return segment, [[n.split("=", 1)[1], segment] for n in names]

    def read(self, version: int | None = None, segments: bool = False) -> DataFrame:
        """The rows of the newest (or given) version; ``segments`` adds each row's segment name."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version of {self.path}")
        schema = StructType.fromJson(json.loads(m["schema"]))
        col = m["partition"]
        paths = [f"{self.path}/data/{SEGMENT}={seg}" + (f"/{col}={value}" if col else "") for value, seg in m["parts"]]
        out = [F.col(f"`{c}`") for c in schema.names]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.select(*out, F.lit("").alias(SEGMENT)) if segments else empty
        df = (self.spark.read.schema(StructType([*schema.fields]).add(SEGMENT, StringType()))
              .option("basePath", f"{self.path}/data").parquet(*paths))
        return df.select(*out, *([F.col(SEGMENT)] if segments else []))

    def replace(self, df: DataFrame) -> None:
        """All rows anew."""
        _, parts = self._write(df, None)
        self._commit(parts, df.schema, None)

    def append(self, df: DataFrame) -> None:
        """One more segment; earlier files are not touched."""
        m = self.manifest()
        if m:
            df = df.select(*StructType.fromJson(json.loads(m["schema"])).names)
        _, parts = self._write(df, None)
        self._commit((m["parts"] if m else []) + parts, df.schema, None)

    def replace_window(self, new: DataFrame, date_col: str, lower: str | dt.date) -> None:
        """Rows from ``lower`` on give way to those of ``new``, in one commit.

        Days of the window without new rows go; days before it and rows without a
        date stay, their files untouched. Running it again with the same rows gives
        the same table.
        """
        lo, m = as_date(lower), self.manifest()
        new = new.filter(F.col(date_col) >= date_lit(lo))
        if m:
            new = new.select(*StructType.fromJson(json.loads(m["schema"])).names)
        _, parts = self._write(new, date_col)
        kept = [p for p in (m["parts"] if m else []) if p[0] == NULL_PARTITION or as_date(p[0]) < lo]
        self._commit(kept + parts, new.schema, date_col)

    def vacuum(self, keep: int = 2) -> None:
        """Drop all but the newest ``keep`` versions and the segments only they named."""
        names = [n for n in self._names("manifests") if n.endswith(".json")]
        live = {seg for n in names[-keep:] for _, seg in (self.manifest(int(n[:-5])) or {"parts": []})["parts"]}
        for n in names[:-keep]:
            self._fs.delete(self._hadoop_path(f"{self.path}/manifests/{n}"), False)
        oldest = names[-keep:][0][:-5] if names else ""
        for d in self._names("data"):
            # segments newer than the oldest kept version may belong to a commit under way
            segment = d.split("=", 1)[1]
            if segment not in live and segment.split("-")[0] < oldest:
                self._fs.delete(self._hadoop_path(f"{self.path}/data/{d}"), True)
