"""Managed tables as plain Parquet, partitioned by a hash bucket of the key.

An upsert rewrites only the buckets that hold a key of its rows (Spark's dynamic
partition overwrite); files of other buckets keep their names, and nothing is
written when nothing changes.  There is no version and no log beside Spark's own
commit of a write: a run that dies is run again, which an upsert by key absorbs.
One writer at a time.

``buckets`` belongs to the stored layout and is a parameter of the table; choose it so that a
bucket is one task's work (about a gigabyte).  Keys are unique, so buckets are even.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql import types as T

from cardmart.functions.keys import load_time
from cardmart.operators.upsert import ACTION, DuplicateKeyError, check_unique_keys, updated_column
from cardmart.schemas import TableSpec
from cardmart.session import checkpoint_root

BUCKET = "key_bucket"
_NEW, _PART = "__new", "__part"
LOADED = "source_loaded_at"
#: Hashes of keys that a task of the key check groups.
_HASHES = 1_000_000
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Merged:
    """What one upsert did."""

    table: str
    inserted: int = 0
    updated: int = 0
    buckets: tuple[int, ...] = ()

    @property
    def rows(self) -> int:
        return self.inserted + self.updated

    def status(self, mark=None) -> str:
        return f"{self.table}: merged {self.rows} row(s)" + ("" if mark is None else f", watermark was {mark}")


@dataclass(frozen=True)
class BucketTable:
    spark: SparkSession
    path: str
    spec: TableSpec
    buckets: int = 32

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def create_if_absent(self) -> None:
        fs, p = self._fs(self.path)
        fs.mkdirs(p)

    def truncate(self) -> None:
        fs, p = self._fs(self.path)
        fs.delete(p, True)
        fs.mkdirs(p)

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.spec.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.key), F.lit(self.buckets).cast("long")).cast("int")

    def _typed(self, source: DataFrame) -> DataFrame:
        return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema.fields if f.name in source.columns])

    def _compared(self, source: DataFrame) -> DataFrame:
        """Rows of ``source`` that the table does not hold in the same form, with ACTION."""
        source = self._typed(source)
        values = [c for c in source.columns if c not in self.spec.key]
        held = self.read().select(*self.spec.key, F.struct(*values).alias("held"))
        mine = source.select(*self.spec.key, F.struct(*values).alias("mine"))
        action = F.when(F.col("held").isNull(), "insert").otherwise("update").alias(ACTION)
        return mine.join(held, list(self.spec.key), "left").where(~F.col("mine").eqNullSafe(F.col("held"))).select(*self.spec.key, "mine.*", action)

    def changes(self, source: DataFrame) -> DataFrame:
        """Rows of ``source`` that the table does not hold in the same form."""
        return self._compared(source).drop(ACTION)

    @contextmanager
    def _stored_once(self):
        """Writes a delta to a work folder and reads it from there; the folder goes in the end."""
        work = f"{checkpoint_root(self.spark).rstrip('/')}/deltas/{uuid.uuid4().hex}"

        def store(delta: DataFrame) -> tuple[DataFrame, dict[int, int]]:
            delta.write.option("compression", "zstd").parquet(work)
            delta = self.spark.read.parquet(work)
            return delta, {r[0]: r[1] for r in delta.groupBy(BUCKET).count().collect()}  # at most ``buckets`` numbers

        try:
            yield store
        finally:
            fs, p = self._fs(work)
            fs.delete(p, True)

    def _write(self, merged: DataFrame, touched: list[int] | None) -> Merged:
        """Replaces the buckets of ``merged``; a task keeps one file open a bucket, so that its rows need no sort."""
        counts = Observation(f"upsert_{self.spec.name}_{uuid.uuid4().hex}")
        merged = merged.observe(
            counts, F.count_if(F.col(ACTION) == "insert").alias("inserted"), F.count_if(F.col(ACTION) == "update").alias("updated"))
        before = self.spark.conf.get(_WRITERS)
        self.spark.conf.set(_WRITERS, str(self.buckets + 1))
        try:
            (merged.drop(ACTION).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
             .option("parquet.block.size", max(4, 128 // self.buckets) << 20).partitionBy(BUCKET).parquet(self.path))
        finally:
            self.spark.conf.set(_WRITERS, before)
        self.spark.catalog.refreshByPath(self.path)
        if touched is None:
            touched = sorted(r[0] for r in self._stored().select(BUCKET).distinct().collect())
        return Merged(self.spec.name, int(counts.get["inserted"]), int(counts.get["updated"]), tuple(touched))

    def upsert(self, source: DataFrame, now: Column | None = None, unique: bool = False) -> Merged:
        """Insert or update by key (U01, U13, U15, U16).  ``unique``: keys are unique by construction, so repeated ones are no error."""
        delta, empty = self._typed(source).withColumn(BUCKET, self._bucket()), self._stored().isEmpty()
        timed = not unique and LOADED in delta.columns
        with self._stored_once() as store:
            held, touched = None, None
            if timed or not empty:
                # Stored once: it names the buckets, and is what they are merged with.
                delta, rows = store(delta)
                touched = sorted(rows)
                if not touched:
                    return Merged(self.spec.name)
                held = None if empty else self._stored().where(F.col(BUCKET).isin(touched))
            try:
                merged = self._merged_by_days(held, delta, now, sum(rows.values())) if timed else self._merged(held, delta, now, unique)
                return self._write(merged, touched)
            except Exception:
                if not unique:
                    check_unique_keys(delta, list(self.spec.key))  # names the key that ended the write
                raise

    def _null_key(self) -> Column:
        return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.spec.key])

    def _met_days(self, held: DataFrame | None, delta: DataFrame, n_rows: int) -> tuple:
        """First and last day of load, in ``held`` and in ``delta``, of the rows whose key occurs again (None: there are none).

        Only hashes of keys and days are shuffled.  Two keys of one hash may widen the span, never narrow it.
        """
        def side(df: DataFrame, new: bool) -> DataFrame:
            return df.where(~self._null_key()).select(F.xxhash64(F.lit(13), *self.spec.key).alias("h"), F.lit(new).alias(_NEW), F.col(LOADED).cast("date").alias("t"))

        rows = side(delta, True) if held is None else side(delta, True).unionByName(side(held, False))
        parts = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // _HASHES))
        new = F.col(_NEW)
        met = rows.repartition(parts, "h").groupBy("h").agg(
            F.count_if(new).alias("n_new"), F.count(F.lit(1)).alias("n"),
            *[f(F.when(w, F.col("t"))).alias(f"{f.__name__}_{n}") for n, w in (("held", ~new), ("new", new)) for f in (F.min, F.max)])
        return tuple(met.where("n_new > 0 and n > 1").agg(F.min("min_held"), F.max("max_held"), F.min("min_new"), F.max("max_new")).first())

    def _merged_by_days(self, held: DataFrame | None, delta: DataFrame, now: Column | None, n_delta: int) -> DataFrame:
        """As ``_merged``; rows loaded on days when no key occurs again meet no other row and are taken as they lie, without a shuffle."""
        days = self._met_days(held, delta, n_delta + (0 if held is None else held.count()))

        def may_meet(first, last) -> Column:
            t = F.col(LOADED)
            known = F.lit(False) if first is None else t.cast("date").between(F.lit(first), F.lit(last))
            return self._null_key() | t.isNull() | F.coalesce(known, F.lit(True))

        now = load_time() if now is None else now
        old, new = may_meet(*days[:2]), may_meet(*days[2:])
        parts = [self._merged(None if held is None else held.where(old), delta.where(new), now, False), self._fresh(delta.where(~new), now)]
        if held is not None:
            parts.append(held.where(~old).withColumn(ACTION, F.lit("keep")))
        return reduce(DataFrame.unionByName, parts)

    def _fresh(self, rows: DataFrame, now: Column | None) -> DataFrame:
        """New rows as they are stored: audit times set, columns they lack null.  ACTION stays, or is insert."""
        now, audit = load_time() if now is None else now, ("dw_inserted_at", updated_column([f.name for f in self.spec.schema.fields]))
        action = F.col(ACTION) if ACTION in rows.columns else F.lit("insert").alias(ACTION)
        return rows.select(*[(now if f.name in audit else F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                             for f in self.spec.schema.fields], BUCKET, action)

    def _merged(self, held: DataFrame | None, delta: DataFrame, now: Column | None, unique: bool) -> DataFrame:
        """The rows of ``delta`` and those of ``held`` whose key it lacks, with ACTION, dealt for the write.

        Both sides are shuffled once, by parts of a bucket: rows of a key meet there, and the write takes them as they lie.
        NULL keys match nothing.  A key that ``delta`` has twice ends the job before it commits, unless ``unique``.
        """
        key, columns = list(self.spec.key), [f.name for f in self.spec.schema.fields]
        now = load_time() if now is None else now
        inserted_at, updated_at = "dw_inserted_at" if "dw_inserted_at" in columns else None, updated_column(columns)
        given = set(delta.columns)
        rows = delta.withColumn(_NEW, F.lit(True))
        rows = rows.select(*[F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in self.spec.schema.fields], BUCKET, _NEW)
        if held is not None:
            rows = rows.unionByName(held.withColumn(_NEW, F.lit(False)))
        parts = max(1, 2 * int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        rows = rows.withColumn(_PART, F.pmod(F.xxhash64(F.lit(11), *key), F.lit(parts).cast("long")).cast("int")).repartition(BUCKET, _PART)
        same = Window.partitionBy(BUCKET, _PART, *key)
        new, null = F.col(_NEW), self._null_key()
        kept = [c for c in columns if c == inserted_at or (c not in given and c != updated_at)]
        rows = rows.withColumns({"__n_new": F.count_if(new).over(same), "__n_held": F.count_if(~new).over(same),
                                 **{f"__held_{c}": F.max(F.when(~new, F.col(c))).over(same) for c in kept}})
        stays = new | null | (F.col("__n_new") == 0)
        if not unique:
            stays = F.when(F.col("__n_new") > 1, F.raise_error(F.lit("a key occurs more than once")).cast("boolean")).otherwise(stays)
        met = new & ~null & (F.col("__n_held") > 0)
        out = []
        for c in columns:
            if c == updated_at:
                out.append(F.when(new, now).otherwise(F.col(c)).alias(c))
            elif c in kept:
                fresh = now if c == inserted_at else F.col(c)
                out.append(F.when(met, F.col(f"__held_{c}")).when(new, fresh).otherwise(F.col(c)).alias(c))
            else:
                out.append(F.col(c))
        action = F.when(met, "update").when(new, "insert").otherwise("keep").alias(ACTION)
        return rows.where(stays).select(*out, BUCKET, action)

    def upsert_changes(self, source: DataFrame, now: Column | None = None) -> Merged:
        """Upsert of a whole recomputed table: only rows that differ are written, and only their audit columns move.

        The comparison tells new rows from changed ones, so the merge shuffles no wide row of the delta:
        what is stored and not changed stays, by an anti join with the changed keys.
        """
        columns = [f.name for f in self.spec.schema.fields]
        if "dw_inserted_at" in columns or set(columns) - {updated_column(columns), *source.columns}:
            return self.upsert(self.changes(source), now, unique=True)  # changed rows keep columns of the stored ones
        if self._stored().isEmpty():
            return self._write(self._fresh(self._typed(source).withColumn(BUCKET, self._bucket()), now), None)
        with self._stored_once() as store:
            delta, rows = store(self._compared(source).withColumn(BUCKET, self._bucket()))
            if not rows:
                return Merged(self.spec.name)
            changed = delta.where(F.col(ACTION) == "update").select(*self.spec.key).distinct()
            stays = self._stored().where(F.col(BUCKET).isin(sorted(rows))).join(changed, list(self.spec.key), "left_anti")
            return self._write(self._fresh(delta, now).unionByName(stays.withColumn(ACTION, F.lit("keep"))), sorted(rows))


__all__ = ["BUCKET", "BucketTable", "DuplicateKeyError", "Merged"]
