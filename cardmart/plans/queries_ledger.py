"""Queries for the ledger models: staging, intermediate, dimensions, fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmart.plans import models as M
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.sources import driver_tables as DT


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return DT.raw_tables(spark, sf_dir)


@query("d01_dim_merchant", with_views(
    "SELECT merchant_id, merchant_name, merchant_country, merchant_city, onboarded_date, "
    "merchant_status FROM raw_merchant_master", "raw_merchant_master"))
def d01(spark, sf_dir):
    return M.dim_merchant(DT.merchant_master(spark, sf_dir))


@query("d02_dim_card", with_views(
    "SELECT card_id, card_holder_name, bin, last_four, card_type, card_network, currency_code, "
    "issued_date, card_status FROM raw_card_master", "raw_card_master"))
def d02(spark, sf_dir):
    return M.dim_card(DT.card_master(spark, sf_dir))


@query("d03_dim_mcc", with_views(
    "SELECT DISTINCT mcc_code, mcc_description FROM raw_merchant_master", "raw_merchant_master"))
def d03(spark, sf_dir):
    return M.dim_mcc(DT.merchant_master(spark, sf_dir))


@query("d04_dim_currency", with_views(
    "SELECT DISTINCT currency_code FROM raw_transactions", "raw_transactions"))
def d04(spark, sf_dir):
    return M.dim_currency(DT.raw_transactions(spark, sf_dir))


@query("d05_stg_transactions", with_views("SELECT * FROM stg_transactions", "stg_transactions"))
def d05(spark, sf_dir):
    return M.stg_transactions(DT.raw_transactions(spark, sf_dir))


@query("d06_stg_gateway", with_views("SELECT * FROM stg_gateway_log", "stg_gateway_log"))
def d06(spark, sf_dir):
    return M.stg_gateway_log(DT.raw_gateway_log(spark, sf_dir))


@query("d07_enriched", with_views("SELECT * FROM int_transactions_enriched",
                                  "int_transactions_enriched"))
def d07(spark, sf_dir):
    r = raw(spark, sf_dir)
    return M.int_transactions_enriched(M.stg_transactions(r["raw_transactions"]),
                                       r["raw_card_master"], r["raw_merchant_master"])


@query("d08_settlements", with_views("SELECT * FROM int_settlements", "int_settlements"))
def d08(spark, sf_dir):
    return M.int_settlements(M.stg_gateway_log(DT.raw_gateway_log(spark, sf_dir)))


@query("d09_fees_all", with_views("SELECT * FROM int_fees", "int_fees"))
def d09_all(spark, sf_dir):
    return M.int_fees(M.stg_gateway_log(DT.raw_gateway_log(spark, sf_dir)))


@query("d09_fees_settled", with_views(
    "SELECT transaction_id, interchange_fee, scheme_fee FROM ranked_gateway "
    "WHERE rn = 1 AND settlement_amount IS NOT NULL", "ranked_gateway"))
def d09_settled(spark, sf_dir):
    return M.int_fees(M.stg_gateway_log(DT.raw_gateway_log(spark, sf_dir)), settled_only=True)


def fact(spark: SparkSession, sf_dir: str, net_scale2: bool = False) -> DataFrame:
    r = raw(spark, sf_dir)
    stg_tx = M.stg_transactions(r["raw_transactions"])
    enriched = M.int_transactions_enriched(stg_tx, r["raw_card_master"], r["raw_merchant_master"])
    return M.fact_payment_ledger(enriched, M.stg_gateway_log(r["raw_gateway_log"]),
                                 r["dispute_memos"], net_scale2=net_scale2)


@query("d10_fact", with_views("SELECT * FROM fact_payment_ledger", "fact_payment_ledger"))
def d10(spark, sf_dir):
    return fact(spark, sf_dir)


A02_SQL = """
SELECT CAST(count(*) AS BIGINT) AS total_rows,
  CAST(sum(CASE WHEN is_disputed THEN 1 ELSE 0 END) AS BIGINT) AS disputed_rows,
  CAST(round(sum(net_amount), 2) AS DECIMAL(18,2)) AS total_net_amount,
  CAST(count(DISTINCT currency_code) AS BIGINT) AS distinct_currencies
FROM fact_payment_ledger"""


@query("a02_fact_summary", with_views(A02_SQL, "fact_payment_ledger"))
def a02(spark, sf_dir):
    f = fact(spark, sf_dir)
    return f.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(F.col("is_disputed"), 1).otherwise(0)).cast("long").alias("disputed_rows"),
        F.round(F.sum("net_amount"), 2).cast("decimal(18,2)").alias("total_net_amount"),
        F.countDistinct("currency_code").alias("distinct_currencies"),
    )
