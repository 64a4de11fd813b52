"""The driver's TPC-H-like test tables seen as the card-payment raw layer.

Each function returns a lazy DataFrame with the column names and types of the
matching raw landing table (``cardmart.schemas``), derived from the test
tables by pure column expressions:

* card master      <- customer
* merchant master  <- supplier x nation
* transactions     <- orders (+ merchant / card currency lookups)
* gateway events   <- lineitem
* dispute memos    <- documents

Lookups into the fixed vocabularies (15 MCCs, 7 currencies, ...) are constant
arrays indexed with ``element_at`` -- no join, no shuffle.  The only joins are
orders -> supplier / customer for the two currencies (P22), which Spark plans
as ordinary equi-joins (broadcast only when AQE measures the side as small).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmart import constants as K
from cardmart.schemas import AMT, FEE

TEST_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """Constant-array lookup ``values[index]`` (0-based index)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def money(c: Column) -> Column:
    """Doubles become decimals before any arithmetic (exact sums and comparisons)."""
    return c.cast(AMT)


def batch_loaded_at(event_ts: Column, jitter_key: Column) -> Column:
    """Nightly batch load time: next day 02:00:00 + (key mod 3601) seconds."""
    secs = (jitter_key % 3601) + 26 * 3600
    return F.timestamp_add("SECOND", secs, F.date_trunc("DAY", event_ts))


@lru_cache(maxsize=64)
def _row_count(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count()


def table_rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Row count of a test table (answered from parquet footers; a scalar, not data)."""
    return _row_count(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def card_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    network = pick(K.CARD_NETWORKS, F.col("c_custkey") % 4)
    return c.select(
        F.col("c_custkey").cast("string").alias("card_id"),
        F.col("c_name").alias("card_holder_name"),
        F.when(network == "VISA", (F.col("c_custkey") % 100000 + 400000).cast("string"))
         .otherwise((F.col("c_custkey") % 50000 + 510000).cast("string")).alias("bin"),
        F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0").alias("last_four"),
        F.col("c_mktsegment").alias("card_type"),
        network.alias("card_network"),
        pick(K.CURRENCIES, F.col("c_nationkey") % 7).alias("currency_code"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("c_custkey") % 900).cast("int"))
         .alias("issued_date"),
        F.when(F.col("c_acctbal") < 0, "BLOCKED").otherwise("ACTIVE").alias("card_status"),
        batch_loaded_at(F.date_add(F.lit("2021-01-01").cast("date"),
                                   (F.col("c_custkey") % 900).cast("int")).cast("timestamp_ntz"),
                        F.col("c_custkey")).alias("_loaded_at"),
    )


def merchant_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    # nation has 25 rows by definition of the schema: a proven size bound.
    n = F.broadcast(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    mcc = F.col("s_suppkey") % len(K.MCCS)
    onboarded = F.date_add(F.lit("2019-01-01").cast("date"), (F.col("s_suppkey") % 1000).cast("int"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "inner").select(
        F.col("s_suppkey").cast("string").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        pick([c for c, _ in K.MCCS], mcc).alias("mcc_code"),
        pick([d for _, d in K.MCCS], mcc).alias("mcc_description"),
        F.col("n_name").alias("merchant_country"),
        F.concat(F.lit("CITY-"), (F.col("s_suppkey") % 97).cast("string")).alias("merchant_city"),
        onboarded.alias("onboarded_date"),
        F.when(F.col("s_acctbal") < 0, "INACTIVE").otherwise("ACTIVE").alias("merchant_status"),
        batch_loaded_at(onboarded.cast("timestamp_ntz"), F.col("s_suppkey")).alias("_loaded_at"),
    )


def _txn_type(key: Column) -> Column:
    p = key % 100
    return (F.when(p < 80, "PURCHASE").when(p < 88, "REFUND").when(p < 95, "REVERSAL")
            .otherwise("TRANSFER"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_sup = table_rows(spark, sf_dir, "supplier")
    o = read(spark, sf_dir, "orders")
    sup = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey"), pick(K.CURRENCIES, F.col("s_nationkey") % 7).alias("m_cur"))
    cust = read(spark, sf_dir, "customer").select(
        F.col("c_custkey"), pick(K.CURRENCIES, F.col("c_nationkey") % 7).alias("c_cur"))
    merchant_key = F.col("o_orderkey") % n_sup
    t = (o.withColumn("_mkey", merchant_key)
          .join(sup, F.col("_mkey") == F.col("s_suppkey"), "left")
          .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left"))
    return t.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("card_id"),
        F.col("_mkey").cast("string").alias("merchant_id"),
        _txn_type(F.col("o_orderkey")).alias("transaction_type"),
        money(F.col("o_totalprice")).alias("amount"),
        F.col("m_cur").alias("currency_code"),
        F.col("o_orderdate").alias("transaction_timestamp"),
        F.when(F.col("o_orderstatus") == "F", "DECLINED").otherwise("APPROVED").alias("auth_status"),
        pick([c for c, _ in K.MCCS], F.col("_mkey") % len(K.MCCS)).alias("mcc_code"),
        F.col("o_orderpriority").alias("entry_mode"),
        (F.col("c_cur") != F.col("m_cur")).alias("is_international"),
        batch_loaded_at(F.col("o_orderdate"), F.col("o_orderkey")).alias("_loaded_at"),
    )


def gateway_log_id(c_order: Column, c_line: Column, c_part: Column, c_supp: Column,
                   price: Column) -> Column:
    """Unique, fixed-width event id: string order == numeric order of the tie-break tuple."""
    return F.concat_ws(
        "-",
        F.lpad(c_order.cast("string"), 12, "0"), F.lpad(c_line.cast("string"), 3, "0"),
        F.lpad(c_part.cast("string"), 10, "0"), F.lpad(c_supp.cast("string"), 10, "0"),
        F.lpad(price.cast("string"), 15, "0"))


def raw_gateway_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    price = money(F.col("l_extendedprice"))
    gid = gateway_log_id(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                         F.col("l_suppkey"), price)
    returned = F.col("l_returnflag") == "R"
    return li.select(
        gid.alias("gateway_log_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        pick(K.GATEWAYS, F.col("l_suppkey") % 3).alias("gateway_name"),
        F.upper(F.substring(F.md5(gid), 1, 6)).alias("auth_code"),
        F.when(returned, "05").otherwise("00").alias("response_code"),
        F.when(returned, "Do Not Honor").otherwise("Approved").alias("response_message"),
        F.col("l_shipdate").alias("gateway_timestamp"),
        F.when(returned, F.lit(None).cast(AMT)).otherwise(price).alias("settlement_amount"),
        (price * F.col("l_discount").cast(AMT)).cast(FEE).alias("interchange_fee"),
        (price * F.col("l_tax").cast(AMT)).cast(FEE).alias("scheme_fee"),
        batch_loaded_at(F.col("l_shipdate"), F.col("l_orderkey") + F.col("l_linenumber"))
         .alias("_loaded_at"),
    )


def dispute_memos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memos from ``documents``; ``lang`` and ``source`` kept as extra grouping columns.

    ``card_id`` and ``created_date`` need the parent transaction; they are
    NULL here (no query groups by them) to keep this view free of a join.
    """
    n_sup = table_rows(spark, sf_dir, "supplier")
    n_orders = table_rows(spark, sf_dir, "orders")
    d = read(spark, sf_dir, "documents")
    cat = F.col("doc_id") % len(K.DISPUTE_TEMPLATES)
    txn = (F.col("doc_id") * 7) % n_orders
    return d.select(
        F.col("doc_id").cast("string").alias("dispute_id"),
        txn.cast("string").alias("transaction_id"),
        (txn % n_sup).cast("string").alias("merchant_id"),
        F.lit(None).cast("string").alias("card_id"),
        pick(K.DISPUTE_CATEGORIES, cat).alias("dispute_category"),
        pick([r for _, r, _ in K.DISPUTE_TEMPLATES], cat).alias("dispute_reason_code"),
        pick(K.DISPUTE_STATUSES, F.col("doc_id") % 4).alias("dispute_status"),
        F.lit(None).cast("date").alias("created_date"),
        F.col("text").alias("memo_text"),
        F.col("lang"),
        F.col("source"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five raw tables, lazily."""
    return {
        "raw_merchant_master": merchant_master(spark, sf_dir),
        "raw_card_master": card_master(spark, sf_dir),
        "raw_transactions": raw_transactions(spark, sf_dir),
        "raw_gateway_log": raw_gateway_log(spark, sf_dir),
        "dispute_memos": dispute_memos(spark, sf_dir),
    }
