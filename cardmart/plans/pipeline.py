"""The ledger pipeline: step graph, upsert and rebuild modes, run log.

Upsert mode reproduces the hand-written procedures: watermark delta loads into
staging, then full merges into the intermediate tables and the fact (net
amount at scale 2).  Rebuild mode reproduces the declarative models: every
mart recomputed from raw in one lazy plan and written as a new version.
Independent steps run concurrently from a thread pool on one SparkSession
(Spark schedules their jobs side by side).
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmart.functions.keys import load_time
from cardmart.operators.upsert import MergeResult, load_incremental, reset_watermarks
from cardmart.operators.upsert import seed_watermarks, upsert
from cardmart.plans import models as M
from cardmart.plans.loads import fact_of_stored
from cardmart.schemas import TABLES
from cardmart.sources.snapshot import SnapshotTable, replace_table

INCREMENTAL_SOURCES = ("raw_transactions", "raw_gateway_log")

RUN_LOG_SCHEMA = ("run_id string, step string, state string, started_at timestamp_ntz, "
                  "ended_at timestamp_ntz, rows_merged long, message string")

# step -> upstream steps (the task graph: root, 2 staging, 3 intermediate, 1 fact)
GRAPH: dict[str, tuple[str, ...]] = {
    "stg_transactions": (),
    "stg_gateway_log": (),
    "dimensions": (),
    "int_transactions_enriched": ("stg_transactions",),
    "int_settlements": ("stg_gateway_log",),
    "int_fees": ("stg_gateway_log",),
    "fact_payment_ledger": ("int_transactions_enriched", "int_settlements", "int_fees",
                            "dimensions"),
}


@dataclass
class StepResult:
    step: str
    state: str
    started_at: dt.datetime
    ended_at: dt.datetime
    rows_merged: int | None = None
    message: str = ""


@dataclass
class Pipeline:
    """All managed tables under ``root`` (a shared folder), fed by ``raw`` DataFrames."""
    spark: SparkSession
    root: str
    raw: dict[str, DataFrame]
    tables: dict[str, SnapshotTable] = field(init=False)

    def __post_init__(self) -> None:
        self.tables = {n: SnapshotTable(self.spark, self.root, s) for n, s in TABLES.items()}
        self.run_log_path = f"{self.root.rstrip('/')}/run_log"
        self.mart_path = f"{self.root.rstrip('/')}/marts"

    # --- setup ------------------------------------------------------------------------------
    def create(self) -> None:
        """S07 + S14: create missing tables, seed missing watermarks."""
        for name, t in self.tables.items():
            if name != "etl_watermark":
                t.create_if_absent()
        seed_watermarks(self.tables["etl_watermark"], INCREMENTAL_SOURCES)

    def reset(self) -> None:
        """Empty every pipeline table and rewind the watermarks."""
        for name, t in self.tables.items():
            if name != "etl_watermark":
                t.truncate()
        reset_watermarks(self.tables["etl_watermark"], INCREMENTAL_SOURCES)

    def dry_run(self) -> DataFrame:
        """Reset, run the whole graph, return the verification row counts."""
        self.reset()
        self.run()
        return self.row_counts()

    # --- upsert-mode steps ---------------------------------------------------------------------
    def _steps_upsert(self) -> dict[str, Callable[[], MergeResult | int]]:
        t, raw, wm = self.tables, self.raw, self.tables["etl_watermark"]
        return {
            "stg_transactions": lambda: load_incremental(
                raw["raw_transactions"], t["stg_transactions"], wm, "raw_transactions",
                M.stg_transactions),
            "stg_gateway_log": lambda: load_incremental(
                raw["raw_gateway_log"], t["stg_gateway_log"], wm, "raw_gateway_log",
                M.stg_gateway_log),
            "dimensions": self.build_dimensions,
            # Full-table merges (every row, each run): sources are unique by
            # construction (row_number = 1 outputs; unique staging keys joined to
            # masters whose keys the test suite checks), so no duplicate pass and
            # no key count -- one shuffled merge.
            "int_transactions_enriched": lambda: upsert(
                t["int_transactions_enriched"],
                M.int_transactions_enriched(t["stg_transactions"].read(),
                                            raw["raw_card_master"], raw["raw_merchant_master"]),
                check_duplicates=False, strategy="shuffle"),
            "int_settlements": lambda: upsert(
                t["int_settlements"], M.int_settlements(t["stg_gateway_log"].read()),
                check_duplicates=False, strategy="shuffle"),
            "int_fees": lambda: upsert(
                t["int_fees"], M.int_fees(t["stg_gateway_log"].read(), settled_only=True),
                check_duplicates=False, strategy="shuffle"),
            "fact_payment_ledger": lambda: upsert(
                t["fact_payment_ledger"],
                fact_of_stored(t["int_transactions_enriched"].read(), t["int_settlements"].read(),
                               t["int_fees"].read(), raw["dispute_memos"]),
                check_duplicates=False, strategy="shuffle"),
        }

    def build_dimensions(self) -> int:
        """Full-refresh dimension tables (S08): one overwrite per table."""
        n = 0
        dims = {
            "dim_merchant": M.dim_merchant(self.raw["raw_merchant_master"], True),
            "dim_card": M.dim_card(self.raw["raw_card_master"], True),
            "dim_mcc": M.dim_mcc(self.raw["raw_merchant_master"], True),
            "dim_currency": M.dim_currency(self.raw["raw_transactions"], True),
        }
        for name, df in dims.items():
            df.write.mode("overwrite").parquet(f"{self.mart_path}/{name}")
            n += 1
        return n

    def mart(self, name: str) -> DataFrame:
        """A published model: a dimension, or any model after ``rebuild``."""
        return self.spark.read.parquet(f"{self.mart_path}/{name}")

    # --- rebuild mode ---------------------------------------------------------------------------
    def rebuild(self) -> list[StepResult]:
        """Recompute every model from raw and publish it under ``marts`` (declarative-model flavour).

        Types are those of the models: ``net_amount`` keeps four decimals, unlike
        the fact table of the upsert mode, which is left alone.
        """
        started = _now()
        models = M.build_all(self.raw, with_load_time=True)
        for name, df in models.items():
            replace_table(df, f"{self.mart_path}/{name}")
        results = [StepResult("rebuild", "SUCCEEDED", started, _now(), None, f"rebuild: {len(models)} table(s)")]
        self._log(results)
        return results

    # --- run -------------------------------------------------------------------------------------
    def run(self, parallel: bool = True) -> list[StepResult]:
        """Every step in dependency order; independent steps concurrently."""
        self.create()
        steps = self._steps_upsert()
        done: dict[str, StepResult] = {}
        pending = dict(GRAPH)
        with ThreadPoolExecutor(max_workers=4 if parallel else 1) as pool:
            while pending:
                ready = [s for s, deps in pending.items() if all(d in done for d in deps)]
                failed = [s for s, deps in pending.items()
                          if any(done.get(d) and done[d].state != "SUCCEEDED" for d in deps)]
                for s in failed:
                    now = _now()
                    done[s] = StepResult(s, "SKIPPED", now, now, None, "upstream failed")
                    pending.pop(s)
                ready = [s for s in ready if s in pending]
                if not ready:
                    if pending and not failed:
                        raise RuntimeError(f"cycle or missing step in {list(pending)}")
                    continue
                futs = {s: pool.submit(_timed, s, steps[s]) for s in ready}
                for s, fut in futs.items():
                    done[s] = fut.result()
                    pending.pop(s)
        results = [done[s] for s in GRAPH]
        self._log(results)
        return results

    def _log(self, results: list[StepResult]) -> None:
        run_id = f"run-{int(time.time() * 1000)}"
        rows = [(run_id, r.step, r.state, r.started_at, r.ended_at, r.rows_merged, r.message)
                for r in results]
        (self.spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.run_log_path))

    def run_history(self, minutes: int = 30, limit: int | None = None) -> DataFrame:
        """Recent step runs, newest first."""
        try:
            log = self.spark.read.parquet(self.run_log_path)
        except AnalysisException:
            return self.spark.createDataFrame([], RUN_LOG_SCHEMA)
        since = load_time() - F.make_dt_interval(mins=F.lit(minutes))
        recent = log.filter(F.col("started_at") >= since).orderBy(F.col("started_at").desc(), F.col("step"))
        return recent if limit is None else recent.limit(limit)

    def row_counts(self) -> DataFrame:
        """Row count of every managed table as one result, ordered by name."""
        from functools import reduce
        parts = [t.read().agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("tbl"), "rows") for n, t in self.tables.items()]
        return reduce(DataFrame.unionByName, parts).orderBy("tbl")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _timed(step: str, fn: Callable[[], MergeResult | int]) -> StepResult:
    started = _now()
    try:
        res = fn()
    except Exception as e:  # noqa: BLE001 -- a failed step is recorded, downstream skipped
        return StepResult(step, "FAILED", started, _now(), None, f"{type(e).__name__}: {e}")
    if isinstance(res, MergeResult):
        return StepResult(step, "SUCCEEDED", started, _now(), res.merged, res.status())
    return StepResult(step, "SUCCEEDED", started, _now(), None, f"{step}: {res} table(s)")
