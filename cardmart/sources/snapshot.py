"""Versioned parquet tables.

A managed table lives under ``<root>/<name>/``:

* ``slot=a/``, ``slot=b/`` -- two physical copies: the current version and the
  previous one;
* ``_commits/``            -- an append-only parquet log, one row per version
  (version, slot, time, rows).

A write goes to the slot that is NOT current (``overwrite`` of that folder,
which no reader of the current version touches), and only *then* appends its
row to the commit log.  A reader takes the largest committed version, so it
never sees a half-written one; a writer that dies before the log append
leaves a slot that nobody reads and the next write overwrites.  Storage stays
at two copies however many runs there are.  Everything is plain
``spark.read`` / ``df.write`` -- no filesystem client -- so ``root`` can be
any Hadoop URI the cluster shares.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmart.schemas import TableSpec

_LOG_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("slot", T.StringType(), False),
    T.StructField("committed_at", T.TimestampNTZType(), True),
    T.StructField("rows", T.LongType(), True),
])


# One writer per table path inside this driver: concurrent pipeline branches
# (two staging loads advancing their marks) must not both commit version N+1.
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark, self.spec = spark, spec
        self.path = f"{root.rstrip('/')}/{spec.name}"
        self.log_path = f"{self.path}/_commits"

    @property
    def lock(self) -> threading.RLock:
        """Hold across read-modify-write (upsert) of this table."""
        return _LOCKS[self.path]

    # --- reading ---------------------------------------------------------------------------
    def _commits(self) -> list[tuple[int, str]]:
        """The last two commits (version, slot), newest first."""
        try:
            rows = (self.spark.read.parquet(self.log_path).orderBy(F.col("version").desc())
                    .select("version", "slot").limit(2).collect())
        except AnalysisException:
            return []
        return [(int(r[0]), r[1]) for r in rows]

    def current_version(self) -> int | None:
        c = self._commits()
        return c[0][0] if c else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.spec.schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or the previous one (older versions are overwritten)."""
        commits = self._commits()
        if not commits:
            return self.empty()
        slots = dict(commits)
        v = commits[0][0] if version is None else version
        if v not in slots:
            raise ValueError(f"{self.spec.name}: version {v} is no longer kept "
                             f"(kept: {sorted(slots)})")
        return self.spark.read.schema(self.spec.schema).parquet(f"{self.path}/slot={slots[v]}")

    # --- writing ---------------------------------------------------------------------------
    def write(self, df: DataFrame, rows: int | None = None) -> int:
        """Write ``df`` as the next version and commit it; returns the version number."""
        with self.lock:
            return self._write(df, rows)

    def _write(self, df: DataFrame, rows: int | None) -> int:
        commits = self._commits()
        v = commits[0][0] + 1 if commits else 1
        slot = "b" if commits and commits[0][1] == "a" else "a"
        out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                          for f in self.spec.schema.fields])
        out.write.mode("overwrite").parquet(f"{self.path}/slot={slot}")
        log = self.spark.createDataFrame([(v, slot, None, rows)], _LOG_SCHEMA).withColumn(
            "committed_at", F.current_timestamp().cast("timestamp_ntz"))
        log.coalesce(1).write.mode("append").parquet(self.log_path)
        return v

    def create_if_absent(self) -> int:
        """An empty typed version 1 when the table does not exist yet."""
        cur = self.current_version()
        return cur if cur is not None else self.write(self.empty(), rows=0)

    def truncate(self) -> int:
        """A new, empty version (schema preserved)."""
        return self.write(self.empty(), rows=0)

    def history(self) -> DataFrame:
        try:
            return self.spark.read.parquet(self.log_path).orderBy(F.col("version").desc())
        except AnalysisException:
            return self.spark.createDataFrame([], _LOG_SCHEMA)


def replace_table(df: DataFrame, path: str) -> None:
    """Full-refresh write (``CREATE OR REPLACE TABLE ... AS``).

    Never overwrite a path that ``df`` reads from; materialise elsewhere
    first (Spark refuses it anyway).
    """
    df.write.mode("overwrite").parquet(path)
