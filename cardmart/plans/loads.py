"""The six load procedures over bucketed tables (U02-U07), with the control table.

Staging loads take the rows after the saved mark and advance it to the largest load time of the
slice they merged; an empty slice writes nothing.  Intermediate and fact loads recompute their
rows from the stored tables below and write those that changed.  Nothing is ever deleted: a
transaction that was settled once stays, as in any merge without a delete clause.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cardmart import constants as K
from cardmart.functions.keys import load_time
from cardmart.operators.joins import existence_flag, seed_if_absent
from cardmart.operators.latest import latest_gateway_event
from cardmart.operators.upsert import delta
from cardmart.plans import models as M
from cardmart.schemas import TABLES
from cardmart.session import checkpoint_root
from cardmart.sources.bucketed import BucketTable, Merged

SOURCES = ("raw_transactions", "raw_gateway_log")
LOADS = ("stg_transactions", "stg_gateway_log", "int_transactions_enriched", "int_settlements", "int_fees", "fact_payment_ledger")


class Control:
    """One saved mark a source, in a table of its own."""

    def __init__(self, table: BucketTable):
        self.table = table

    def _rows(self, marks: dict[str, dt.datetime], now: Column) -> DataFrame:
        rows = self.table.spark.createDataFrame([(s, str(m)) for s, m in sorted(marks.items())], "source_table string, mark string")
        return rows.select("source_table", F.col("mark").cast("timestamp_ntz").alias("last_loaded_at"), now.alias("updated_at"))

    def seed(self, sources=SOURCES, now: Column | None = None) -> Merged:
        """Epoch marks for the sources that have none."""
        rows = self._rows({s: K.EPOCH for s in sources}, load_time() if now is None else now)
        return self.table.upsert(seed_if_absent(self.table.read(), rows, "source_table"), now)

    def reset(self, marks: dict[str, dt.datetime] | None = None, now: Column | None = None) -> Merged:
        """Marks back to the epoch, or to given times."""
        return self.table.upsert(self._rows(marks or {s: K.EPOCH for s in SOURCES}, load_time() if now is None else now), now)

    def mark(self, source: str) -> dt.datetime | None:
        row = self.table.read().where(F.col("source_table") == source).select("last_loaded_at").first()
        return None if row is None else row[0]

    def advance(self, source: str, mark: dt.datetime | None, now: Column | None = None) -> None:
        """The new mark of a source; an empty slice (None) leaves it."""
        if mark is not None:
            self.reset({source: mark}, now)


@dataclass
class Ledger:
    """The managed tables below ``root`` (a shared folder) and the loads that fill them from ``raw``."""

    spark: SparkSession
    root: str
    buckets: int = 32

    def __post_init__(self) -> None:
        self.tables = {n: BucketTable(self.spark, f"{self.root.rstrip('/')}/{n}", TABLES[n], self.buckets) for n in LOADS}
        self.control = Control(BucketTable(self.spark, f"{self.root.rstrip('/')}/etl_watermark", TABLES["etl_watermark"], 1))
        for t in [*self.tables.values(), self.control.table]:
            t.create_if_absent()

    def _staging(self, raw: DataFrame, source: str, name: str, model, now: Column | None) -> Merged:
        table, mark = self.tables[name], self.control.mark(source)
        rows = delta(raw, mark)
        top = rows.agg(F.max("_loaded_at")).first()[0]  # rows that land from now on wait for the next load
        if top is None:
            return Merged(name)
        done = table.upsert(model(rows.where(F.col("_loaded_at") <= F.lit(top).cast("timestamp_ntz"))), now)
        self.control.advance(source, top, now)  # after the data: a crash in between merges the slice again
        return done

    def load(self, name: str, raw: dict[str, DataFrame], now: Column | None = None, final: DataFrame | None = None) -> Merged:
        """One load; ``final`` has the final settled events of the stored staging rows, if they were ranked already."""
        t = {n: table.read for n, table in self.tables.items()}
        if name == "stg_transactions":
            return self._staging(raw["raw_transactions"], "raw_transactions", name, M.stg_transactions, now)
        if name == "stg_gateway_log":
            return self._staging(raw["raw_gateway_log"], "raw_gateway_log", name, M.stg_gateway_log, now)
        if name == "int_transactions_enriched":
            rows = M.int_transactions_enriched(t["stg_transactions"](), raw["raw_card_master"], raw["raw_merchant_master"])
        elif name == "int_settlements":
            rows = M.int_settlements(t["stg_gateway_log"]()) if final is None else final.select(
                "transaction_id", "settlement_amount", F.col("gateway_timestamp").alias("settled_at"))
        elif name == "int_fees":
            rows = (M.int_fees(t["stg_gateway_log"](), settled_only=True) if final is None
                    else final.select("transaction_id", "interchange_fee", "scheme_fee"))
        else:
            rows = fact_of_stored(t["int_transactions_enriched"](), t["int_settlements"](), t["int_fees"](), raw["dispute_memos"])
        return self.tables[name].upsert_changes(rows, now)

    def run(self, raw: dict[str, DataFrame], now: Column | None = None, upto: str = LOADS[-1]) -> list[Merged]:
        """The loads in order, up to the tables that ``upto`` needs."""
        self.control.seed(now=now)
        work = f"{checkpoint_root(self.spark).rstrip('/')}/final/{uuid.uuid4().hex}"
        done, final = [], None
        try:
            for name in needed(upto):
                if name == "int_settlements" and upto == "fact_payment_ledger":
                    final = self._final_events(work)  # settlements and fees are of the same events
                done.append(self.load(name, raw, now, final))
        finally:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        return done

    def _final_events(self, work: str) -> DataFrame:
        """The final settled event of every transaction, ranked once and stored."""
        final = latest_gateway_event(self.tables["stg_gateway_log"].read(), ["transaction_id", "settlement_amount", "gateway_timestamp",
                                                                             "interchange_fee", "scheme_fee"], settled_only=True)
        final.write.option("compression", "zstd").parquet(work)
        return self.spark.read.schema(final.schema).parquet(work)


def needed(name: str) -> list[str]:
    below = {"int_transactions_enriched": ["stg_transactions"], "int_settlements": ["stg_gateway_log"], "int_fees": ["stg_gateway_log"],
             "fact_payment_ledger": list(LOADS[:-1])}
    return [*below.get(name, []), name]


def fact_of_stored(enriched: DataFrame, settlements: DataFrame, fees: DataFrame, disputes: DataFrame) -> DataFrame:
    """The fact from the stored intermediate tables; the settlement is the grain."""
    money = settlements.select("transaction_id", "settlement_amount").join(
        fees.select("transaction_id", "interchange_fee", "scheme_fee"), "transaction_id")
    return M.ledger_rows(existence_flag(enriched.join(money, "transaction_id"), disputes, "transaction_id", "is_disputed"), net_scale2=True)
