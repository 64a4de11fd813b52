"""Keyed upsert and high-water-mark incremental loads.

``merge_df`` is the pure relational core: target and source are joined on the
key, then per column "source if matched else target".  Nothing is ever deleted.  ``upsert`` wraps it around a ``SnapshotTable``: check the
source keys are unique, merge, write the next version, count what happened
with ``observe`` during that same write (no second pass).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardmart import constants as K
from cardmart.functions.keys import load_time
from cardmart.sources.snapshot import SnapshotTable

ACTION = "_merge_action"  # 'insert' | 'update' | 'keep'


class DuplicateKeyError(ValueError):
    """A source key occurs more than once: the merge would be ambiguous (U16)."""


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def duplicate_keys(source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once (Q07 grain check on a DataFrame)."""
    ks = _keys(key)
    return source.groupBy(*ks).count().filter(F.col("count") > 1)


def check_unique_keys(source: DataFrame, key: str | Sequence[str]) -> None:
    """Raise ``DuplicateKeyError`` when a key is matched more than once (U16)."""
    dup = duplicate_keys(source, key).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"source key {dict(dup[0].asDict())} occurs more than once")


def merge_df(target: DataFrame, source: DataFrame, key: str | Sequence[str],
             update_cols: Sequence[str] | None = None,
             inserted_at: str | None = "dw_inserted_at",
             updated_at: str | None = "dw_updated_at",
             now: Column | None = None, with_action: bool = True,
             strategy: str = "auto") -> DataFrame:
    """Upsert ``source`` into ``target`` by ``key``; returns the new table.

    Matched rows take the source value of every ``update_cols`` column (default:
    all source columns), keep the rest; unmatched source rows are inserted;
    target-only rows are kept unchanged.  ``inserted_at`` is set on insert only,
    ``updated_at`` on insert and update.  Source keys must be unique.

    * ``auto``: the target left joins the source, and source rows whose key the
      target does not hold are added (the target's key column is read a second
      time for that).  No hint: AQE broadcasts the source if its measured bytes
      allow it, and then the target is not shuffled; otherwise both sides are.
    * ``shuffle`` (full-table merges): one full outer join, both sides read once
      and hashed by key.  Keys are unique, so none of them is hot.
    """
    ks = _keys(key)
    now = load_time() if now is None else now
    src_cols = [c for c in source.columns if c not in ks]
    s = source.select(*ks, *[F.col(c).alias(f"__s_{c}") for c in src_cols],
                      F.lit(True).alias("__in_s"))
    t = target.withColumn("__in_t", F.lit(True))
    cols = _merge_columns(target.columns, ks, src_cols, update_cols, inserted_at, updated_at,
                          now, with_action)
    if strategy == "shuffle":
        return t.join(s, ks, "full_outer").select(*cols)
    if strategy != "auto":
        raise ValueError(f"unknown merge strategy {strategy}")
    tagged = t.join(s, ks, "left").select(*cols)
    known = target.select(*ks).join(source.select(*ks), ks, "left_semi")
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields if f.name not in ks]
    fresh = s.join(known, ks, "left_anti").select("*", *absent).select(*cols)
    return tagged.unionByName(fresh)


def _merge_columns(tcols, ks, src_cols, update_cols, inserted_at, updated_at, now,
                   with_action) -> list[Column]:
    audit = {c for c in (inserted_at, updated_at) if c}
    upd = set(update_cols) if update_cols is not None else set(src_cols)
    in_s, in_t = F.col("__in_s").isNotNull(), F.col("__in_t").isNotNull()
    out = []
    for c in tcols:
        if c in ks:
            out.append(F.col(c))
        elif c == inserted_at:
            out.append(F.when(in_t, F.col(c)).otherwise(now).alias(c))
        elif c == updated_at:
            out.append(F.when(in_s, now).otherwise(F.col(c)).alias(c))
        elif c in src_cols and c not in audit:
            sc = F.col(f"__s_{c}")
            if c in upd:
                out.append(F.when(in_s, sc).otherwise(F.col(c)).alias(c))
            else:  # not updated on match, but inserted
                out.append(F.when(in_t, F.col(c)).otherwise(sc).alias(c))
        else:
            out.append(F.col(c))
    if with_action:
        out.append(F.when(in_s & in_t, "update").when(in_s, "insert").otherwise("keep")
                   .alias(ACTION))
    return out


@dataclass
class MergeResult:
    table: str
    inserted: int
    updated: int
    version: int
    watermark_before: dt.datetime | None = None
    watermark_after: dt.datetime | None = None

    @property
    def merged(self) -> int:
        return self.inserted + self.updated

    def status(self) -> str:
        """The status string of a load procedure."""
        s = f"{self.table}: merged {self.merged} row(s)"
        if self.watermark_before is not None:
            s += f", watermark was {self.watermark_before}"
        return s


def upsert(table: SnapshotTable, source: DataFrame, update_cols: Sequence[str] | None = None,
           check_duplicates: bool = True, strategy: str = "auto") -> MergeResult:
    """Merge ``source`` into the snapshot table and commit a new version.

    ``check_duplicates=False`` is for sources unique by construction (a
    ``row_number() = 1`` output, a join of unique keys to unique masters): it
    saves a full evaluation of the source.  A full-table merge should pass
    ``strategy="shuffle"``, which reads both sides once.
    """
    key = list(table.spec.key)
    if check_duplicates:
        check_unique_keys(source, key)
    with table.lock:
        return _upsert_locked(table, source, key, update_cols, strategy)


def _upsert_locked(table: SnapshotTable, source: DataFrame, key: list[str],
                   update_cols: Sequence[str] | None, strategy: str) -> MergeResult:
    target = table.read()
    merged = merge_df(target, source, key, update_cols=update_cols, strategy=strategy,
                      inserted_at="dw_inserted_at" if "dw_inserted_at" in target.columns else None,
                      updated_at=updated_column(target.columns))
    obs = Observation(f"merge_{table.spec.name}")
    observed = merged.observe(
        obs,
        F.count_if(F.col(ACTION) == "insert").alias("inserted"),
        F.count_if(F.col(ACTION) == "update").alias("updated"),
        F.count(F.lit(1)).alias("rows"))
    version = table.write(observed.drop(ACTION))
    m = obs.get
    return MergeResult(table.spec.name, int(m["inserted"]), int(m["updated"]), version)


def updated_column(cols: Sequence[str]) -> str | None:
    for c in ("dw_updated_at", "dw_load_timestamp", "updated_at"):
        if c in cols:
            return c
    return None


# --- high-water mark (U08-U11) --------------------------------------------------------------

def delta(raw: DataFrame, mark: dt.datetime | None, ts_col: str = "_loaded_at",
          inclusive: bool = False) -> DataFrame:
    """Rows loaded after the mark (U08).  Strict ``>`` by default; ``inclusive``
    re-reads rows at exactly the mark (gap-free with an idempotent upsert)."""
    if mark is None:
        return raw
    lit = F.lit(mark).cast("timestamp_ntz")
    return raw.filter(F.col(ts_col) >= lit) if inclusive else raw.filter(F.col(ts_col) > lit)


def seed_watermarks(wm: SnapshotTable, sources: Sequence[str]) -> None:
    """Create the control table and add an epoch mark for each missing source."""
    from cardmart.operators.joins import seed_if_absent
    spark = wm.spark
    wm.create_if_absent()
    current = wm.read()
    seed = spark.createDataFrame([(s,) for s in sources], "source_table string").select(
        "source_table", F.lit(K.EPOCH).cast("timestamp_ntz").alias("last_loaded_at"),
        load_time().alias("updated_at"))
    missing = seed_if_absent(current, seed, "source_table")
    if missing.limit(1).count():
        wm.write(current.unionByName(missing))


def reset_watermarks(wm: SnapshotTable, sources: Sequence[str]) -> None:
    """Every mark back to the epoch."""
    spark = wm.spark
    wm.write(spark.createDataFrame([(s,) for s in sources], "source_table string").select(
        "source_table", F.lit(K.EPOCH).cast("timestamp_ntz").alias("last_loaded_at"),
        load_time().alias("updated_at")))


def read_watermark(wm: SnapshotTable, source_table: str) -> dt.datetime | None:
    """The saved mark of one source (a scalar)."""
    row = (wm.read().filter(F.col("source_table") == source_table)
           .select("last_loaded_at").first())
    return None if row is None else row[0]


def advance_watermark(wm: SnapshotTable, source_table: str, new_mark: dt.datetime | None) -> None:
    """Store the new mark; an empty slice (``None``) leaves the mark unchanged (trap #8)."""
    if new_mark is None:
        return
    spark = wm.spark
    row = spark.createDataFrame([(source_table, new_mark)],
                                "source_table string, last_loaded_at timestamp_ntz")
    upsert(wm, row.withColumn("updated_at", load_time()), check_duplicates=False)


def load_incremental(raw: DataFrame, target: SnapshotTable, wm: SnapshotTable,
                     source_table: str, transform, inclusive: bool = False) -> MergeResult:
    """One staging load: delta since the mark -> transform -> upsert -> advance mark.

    The new mark is the max load time of the slice actually merged, read in
    the same pass as the merge input (not a second look at the raw table), so
    rows that land meanwhile are picked up next time (trap #8).
    """
    mark = read_watermark(wm, source_table)
    slice_df = delta(raw, mark, inclusive=inclusive)
    key = list(target.spec.key)
    # One aggregate over the slice fixes the upper bound, tells an empty slice
    # and finds duplicate keys (U16).  Then merge exactly (mark, new_mark]:
    # rows that land while the job runs are above the bound and wait for next time.
    stats = (slice_df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"),
                                        F.max("_loaded_at").alias("m"))
             .agg(F.count(F.lit(1)).alias("keys"), F.max("n").alias("max_n"),
                  F.max("m").alias("new_mark")).first())
    if stats["max_n"] is not None and stats["max_n"] > 1:
        dup = duplicate_keys(slice_df, key).limit(1).collect()[0]
        raise DuplicateKeyError(f"source key {dict(dup.asDict())} occurs more than once")
    new_mark = stats["new_mark"]
    if not stats["keys"]:  # an empty slice writes nothing and leaves the mark
        return MergeResult(target.spec.name, 0, 0, target.current_version(), mark, mark)
    if new_mark is not None:
        slice_df = slice_df.filter(F.col("_loaded_at") <= F.lit(new_mark).cast("timestamp_ntz"))
    res = upsert(target, transform(slice_df), check_duplicates=False)
    advance_watermark(wm, source_table, new_mark)  # after the data commit: a crash in between re-merges (idempotent)
    res.watermark_before, res.watermark_after = mark, new_mark if new_mark is not None else mark
    return res
