"""Streaming queries (ST1, ST2): the incremental loads driven by Structured Streaming.

The source files are written from the test tables (raw transactions / gateway
events, range-partitioned by load time so each micro-batch is one slice of
load time) into a fresh folder under the shared checkpoint root, then drained
with ``availableNow``.  The results equal the batch models.
"""

from __future__ import annotations

import uuid

from pyspark.sql import types as T

from cardmart.plans import models as M
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.schemas import RAW_GATEWAY_LOG, TABLES, TableSpec
from cardmart.session import checkpoint_root
from cardmart.sources import driver_tables as DT
from cardmart.sources.bucketed import BucketTable
from cardmart.streaming.ingest import ingest_files, maintain_latest

#: The table of the latest gateway event of each transaction.
LATEST = TableSpec("latest_gateway_event", T.StructType([RAW_GATEWAY_LOG[c] for c in (
    "transaction_id", "gateway_log_id", "settlement_amount", "gateway_timestamp")]), ("transaction_id",))


def _scratch(spark) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/stream-runs/{uuid.uuid4().hex}"


def _land_files(df, path: str) -> None:
    """Slices by load time; their number follows the size of the data (shuffle partitions, AQE)."""
    df.repartitionByRange("_loaded_at").write.mode("overwrite").parquet(path)


@query("st1_ingest", with_views("""
SELECT transaction_id, card_id, merchant_id, transaction_type, amount, currency_code,
  transaction_timestamp, auth_status, mcc_code, entry_mode, is_international, source_loaded_at
FROM stg_transactions""", "stg_transactions"))
def st1(spark, sf_dir):
    root = _scratch(spark)
    raw = DT.raw_transactions(spark, sf_dir)
    _land_files(raw, f"{root}/landing")
    target = BucketTable(spark, f"{root}/stg_transactions", TABLES["stg_transactions"], 8)
    ingest_files(spark, f"{root}/landing", raw.schema, target, M.stg_transactions,
                 name=f"st1-{root.rsplit('/', 1)[-1]}")
    return target.read().drop("dw_inserted_at", "dw_updated_at")


@query("st2_latest_stream", with_views("""
SELECT transaction_id, gateway_log_id, settlement_amount, gateway_timestamp
FROM ranked_gateway WHERE rn = 1""", "ranked_gateway"))
def st2(spark, sf_dir):
    root = _scratch(spark)
    gw = DT.raw_gateway_log(spark, sf_dir)
    _land_files(gw, f"{root}/landing")
    target = BucketTable(spark, f"{root}/latest", LATEST, 8)
    maintain_latest(spark, f"{root}/landing", gw.schema, target, "transaction_id", "gateway_timestamp", "gateway_log_id",
                    name=f"st2-{root.rsplit('/', 1)[-1]}")
    return target.read()
