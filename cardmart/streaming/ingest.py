"""Structured Streaming flavour of the incremental loads (ST1, ST2).

The batch loads keep a high-water mark in a control table; here the streaming file
source keeps the set of processed files in its checkpoint, so every landed file is
read once:

* ST1 -- ``readStream`` over a landing folder -> ``foreachBatch`` keyed upsert (U01)
  into a bucketed table, ``trigger(availableNow=True)`` to drain what is there and stop.
* ST2 -- the latest event per key is a streaming aggregation: Spark's state store holds
  the largest ``(ts, id)`` of every key, across restarts.  Update mode sends the keys that
  a batch changed to the table.  The state grows with the keys; a deployment picks
  its store by ``spark.sql.streaming.stateStore.providerClass``.

A batch that is replayed after a failure upserts the same rows again, which changes
nothing.  Checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardmart.schemas import TableSpec
from cardmart.session import checkpoint_root
from cardmart.sources.bucketed import BUCKET, BucketTable


def _checkpoint(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"


def _landed(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def _drained(stream: DataFrame, mode: str, merge: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    (stream.writeStream.outputMode(mode).foreachBatch(merge).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def ingest_files(spark: SparkSession, source_dir: str, schema: T.StructType, target: BucketTable,
                 transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                 name: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """ST1: drain ``source_dir`` into ``target`` with one keyed upsert per micro-batch."""
    target.create_if_absent()

    def merge(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001
        target.upsert(transform(batch))

    _drained(_landed(spark, source_dir, schema, fmt, max_files_per_trigger), "append", merge, _checkpoint(spark, name or target.spec.name))


def maintain_latest(spark: SparkSession, source_dir: str, schema: T.StructType, target: BucketTable | str, key: str, ts: str, event_id: str,
                    name: str, fmt: str = "parquet", max_files_per_trigger: int | None = None, now: Column | None = None) -> None:
    """ST2: keep each key's latest event (NULL times are latest, then the larger id) in ``target``.

    ``target`` is a table, or the folder of one with all columns of the events.
    """
    if isinstance(target, str):
        target = BucketTable(spark, target, TableSpec("latest", schema, (key,)))
    target.create_if_absent()
    order = ["__null", ts, event_id]
    values = [f.name for f in target.spec.schema.fields if f.name in schema.names and f.name not in (key, ts, event_id)]
    stream = _landed(spark, source_dir, schema, fmt, max_files_per_trigger).withColumn("__null", F.col(ts).isNull())
    latest = stream.groupBy(key).agg(F.max(F.struct(*order, *values)).alias("latest"))

    def merge(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001
        target.upsert(batch.select(key, "latest.*"), now, unique=True)

    _drained(latest, "update", merge, _checkpoint(spark, name))


def current_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in a folder that ``maintain_latest`` fills (None before the first event)."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path).drop(BUCKET)
    except AnalysisException:
        return None
