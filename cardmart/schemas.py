"""Typed schemas and keys of the raw, staging, intermediate and mart tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, TS, D, B = T.StringType(), T.TimestampNTZType(), T.DateType(), T.BooleanType()
AMT = T.DecimalType(12, 2)
FEE = T.DecimalType(12, 4)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in
                         ((f[0], f[1], f[2] if len(f) > 2 else True) for f in fields)])


# --- raw landing tables: column order == CSV header order (positional load) ---
RAW_MERCHANT_MASTER = _struct(
    ("merchant_id", S), ("merchant_name", S), ("mcc_code", S), ("mcc_description", S),
    ("merchant_country", S), ("merchant_city", S), ("onboarded_date", D),
    ("merchant_status", S), ("_loaded_at", TS))

RAW_CARD_MASTER = _struct(
    ("card_id", S), ("card_holder_name", S), ("bin", S), ("last_four", S), ("card_type", S),
    ("card_network", S), ("currency_code", S), ("issued_date", D), ("card_status", S),
    ("_loaded_at", TS))

RAW_TRANSACTIONS = _struct(
    ("transaction_id", S), ("card_id", S), ("merchant_id", S), ("transaction_type", S),
    ("amount", AMT), ("currency_code", S), ("transaction_timestamp", TS), ("auth_status", S),
    ("mcc_code", S), ("entry_mode", S), ("is_international", B), ("_loaded_at", TS))

RAW_GATEWAY_LOG = _struct(
    ("gateway_log_id", S), ("transaction_id", S), ("gateway_name", S), ("auth_code", S),
    ("response_code", S), ("response_message", S), ("gateway_timestamp", TS),
    ("settlement_amount", AMT), ("interchange_fee", FEE), ("scheme_fee", FEE), ("_loaded_at", TS))

DISPUTE_MEMOS = _struct(
    ("dispute_id", S), ("transaction_id", S), ("merchant_id", S), ("card_id", S),
    ("dispute_category", S), ("dispute_reason_code", S), ("dispute_status", S),
    ("created_date", D), ("memo_text", S))

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_merchant_master": RAW_MERCHANT_MASTER,
    "raw_card_master": RAW_CARD_MASTER,
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_gateway_log": RAW_GATEWAY_LOG,
    "dispute_memos": DISPUTE_MEMOS,
}

# --- control table (one high-water mark per incremental source) ---
ETL_WATERMARK = _struct(("source_table", S, False), ("last_loaded_at", TS, False),
                        ("updated_at", TS))

_AUDIT = (("source_loaded_at", TS), ("dw_inserted_at", TS), ("dw_updated_at", TS))

STG_TRANSACTIONS = _struct(*[(f.name, f.dataType) for f in RAW_TRANSACTIONS.fields
                             if f.name != "_loaded_at"], *_AUDIT)
STG_GATEWAY_LOG = _struct(*[(f.name, f.dataType) for f in RAW_GATEWAY_LOG.fields
                            if f.name != "_loaded_at"], *_AUDIT)

INT_TRANSACTIONS_ENRICHED = _struct(
    ("transaction_id", S, False), ("transaction_timestamp", TS), ("card_id", S),
    ("card_holder_name", S), ("card_type", S), ("card_network", S), ("merchant_id", S),
    ("merchant_name", S), ("mcc_code", S), ("mcc_description", S), ("merchant_country", S),
    ("merchant_city", S), ("currency_code", S), ("transaction_type", S), ("entry_mode", S),
    ("auth_status", S), ("is_international", B), ("amount", AMT), ("dw_updated_at", TS))

INT_SETTLEMENTS = _struct(("transaction_id", S, False), ("settlement_amount", AMT),
                          ("settled_at", TS), ("dw_updated_at", TS))
INT_FEES = _struct(("transaction_id", S, False), ("interchange_fee", FEE), ("scheme_fee", FEE),
                   ("dw_updated_at", TS))

FACT_PAYMENT_LEDGER = _struct(
    ("payment_ledger_key", T.LongType(), False), ("transaction_id", S, False),
    ("transaction_ts", TS), ("card_id", S), ("merchant_id", S), ("mcc_code", S),
    ("currency_code", S), ("transaction_type", S), ("entry_mode", S), ("auth_status", S),
    ("is_international", B), ("gross_amount", AMT), ("settlement_amount", AMT),
    ("interchange_fee", FEE), ("scheme_fee", FEE), ("net_amount", AMT), ("is_disputed", B),
    ("dw_load_timestamp", TS))


@dataclass(frozen=True)
class TableSpec:
    """Name, schema and primary key of a managed table (keys live here, not in parquet)."""
    name: str
    schema: T.StructType
    key: tuple[str, ...]


TABLES: dict[str, TableSpec] = {s.name: s for s in [
    TableSpec("etl_watermark", ETL_WATERMARK, ("source_table",)),
    TableSpec("stg_transactions", STG_TRANSACTIONS, ("transaction_id",)),
    TableSpec("stg_gateway_log", STG_GATEWAY_LOG, ("gateway_log_id",)),
    TableSpec("int_transactions_enriched", INT_TRANSACTIONS_ENRICHED, ("transaction_id",)),
    TableSpec("int_settlements", INT_SETTLEMENTS, ("transaction_id",)),
    TableSpec("int_fees", INT_FEES, ("transaction_id",)),
    TableSpec("fact_payment_ledger", FACT_PAYMENT_LEDGER, ("transaction_id",)),
]}

RAW_KEYS = {
    "raw_merchant_master": ("merchant_id",),
    "raw_card_master": ("card_id",),
    "raw_transactions": ("transaction_id",),
    "raw_gateway_log": ("gateway_log_id",),
    "dispute_memos": ("dispute_id",),
}

# Columns written from the clock; excluded from every comparison (trap #12).
LOAD_TIME_COLUMNS = ("dw_inserted_at", "dw_updated_at", "dw_load_timestamp", "updated_at")
