"""Relational queries: aggregates, joins, top-k, predicates, upsert, data tests (A/J/L/P/Q/S/U/X)."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardmart import constants as K
from cardmart.functions.keys import cross_border, minus_minutes, surrogate_key
from cardmart.functions.text import prompt
from cardmart.operators import joins as J
from cardmart.operators import quality as Q
from cardmart.operators.upsert import delta, merge_df, ACTION
from cardmart.plans import models as M
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.plans.queries_ledger import fact
from cardmart.session import checkpoint_root
from cardmart.sources import driver_tables as DT

# A fixed high-water mark inside the test tables' load-time range.
MARK = dt.datetime(1997, 6, 1, 2, 30, 0)
#: Share of all rows from which a merchant is listed in the profile.
MERCHANT_SHARE = 0.01
MARK_SQL = "TIMESTAMP '1997-06-01 02:30:00'"
# Split of the transactions into "already loaded" and "arriving" for the merge query.
CUT_OLD, CUT_NEW = dt.datetime(1997, 1, 1), dt.datetime(1996, 1, 1)


def _models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = DT.raw_tables(spark, sf_dir)
    return {**raw, **M.build_all(raw)}


# --- aggregates --------------------------------------------------------------------------------

@query("a01_count_star", with_views(
    "SELECT CAST(count(*) AS BIGINT) AS fact_payment_ledger_rows FROM fact_payment_ledger",
    "fact_payment_ledger"))
def a01(spark, sf_dir):
    return fact(spark, sf_dir).agg(F.count(F.lit(1)).alias("fact_payment_ledger_rows"))


@query("a05_watermark", with_views(
    "SELECT max(_loaded_at) AS max_loaded_at FROM raw_transactions", "raw_transactions"))
def a05(spark, sf_dir):
    return DT.raw_transactions(spark, sf_dir).agg(F.max("_loaded_at").alias("max_loaded_at"))


@query("a06_group_count", with_views(
    "SELECT dispute_category, CAST(count(*) AS BIGINT) AS memos FROM dispute_memos "
    "GROUP BY 1 ORDER BY memos DESC, dispute_category", "dispute_memos"))
def a06(spark, sf_dir):
    return (DT.dispute_memos(spark, sf_dir).groupBy("dispute_category")
            .agg(F.count(F.lit(1)).alias("memos"))
            .orderBy(F.col("memos").desc(), "dispute_category"))


@query("a07_count_if", with_views(
    "SELECT CAST(count(*) FILTER (WHERE auth_status = 'DECLINED') AS BIGINT) AS declined, "
    "CAST(count(*) FILTER (WHERE is_international) AS BIGINT) AS international FROM raw_transactions",
    "raw_transactions"))
def a07(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.agg(F.count_if(F.col("auth_status") == "DECLINED").alias("declined"),
                 F.count_if(F.col("is_international")).alias("international"))


@query("a11_having_topk", with_views("""
SELECT m.merchant_name, CAST(count(*) AS BIGINT) AS dispute_count
FROM dispute_memos d JOIN raw_merchant_master m USING (merchant_id)
GROUP BY m.merchant_name HAVING count(*) >= 3
ORDER BY dispute_count DESC, merchant_name LIMIT 10""", "dispute_memos", "raw_merchant_master"))
def a11(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    m = DT.merchant_master(spark, sf_dir)
    return (d.join(m, "merchant_id").groupBy("merchant_name")
            .agg(F.count(F.lit(1)).alias("dispute_count"))
            .filter(F.col("dispute_count") >= 3)
            .orderBy(F.col("dispute_count").desc(), "merchant_name").limit(10))


RAW_NAMES = ["dispute_memos", "raw_card_master", "raw_gateway_log", "raw_merchant_master",
             "raw_transactions"]


@query("a12_row_counts", with_views(
    "\nUNION ALL ".join(f"SELECT '{n}' AS tbl, CAST(count(*) AS BIGINT) AS row_count FROM {n}"
                        for n in RAW_NAMES) + "\nORDER BY tbl", *RAW_NAMES))
def a12(spark, sf_dir):
    raw = DT.raw_tables(spark, sf_dir)
    return Q.row_counts({n: raw[n] for n in RAW_NAMES})


# --- joins -------------------------------------------------------------------------------------

@query("j04_exists_flag", with_views("""
SELECT transaction_id,
  EXISTS (SELECT 1 FROM dispute_memos d WHERE d.transaction_id = t.transaction_id) AS is_disputed
FROM stg_transactions t""", "stg_transactions", "dispute_memos"))
def j04(spark, sf_dir):
    t = M.stg_transactions(DT.raw_transactions(spark, sf_dir)).select("transaction_id")
    return J.existence_flag(t, DT.dispute_memos(spark, sf_dir), "transaction_id", "is_disputed")


@query("j05_using", with_views("""
SELECT d.dispute_id, d.merchant_id, m.merchant_name, m.merchant_country
FROM dispute_memos d JOIN raw_merchant_master m USING (merchant_id)""",
                               "dispute_memos", "raw_merchant_master"))
def j05(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir).select("dispute_id", "merchant_id")
    m = DT.merchant_master(spark, sf_dir).select("merchant_id", "merchant_name", "merchant_country")
    return d.join(m, "merchant_id")


@query("j08_no_events", with_views("""
SELECT transaction_id, amount FROM raw_transactions t
WHERE NOT EXISTS (SELECT 1 FROM raw_gateway_log g WHERE g.transaction_id = t.transaction_id)""",
                                   "raw_transactions", "raw_gateway_log"))
def j08(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir).select("transaction_id", "amount")
    return J.anti(t, DT.raw_gateway_log(spark, sf_dir), "transaction_id")


@query("j09_orphans", with_views("""
SELECT g.gateway_log_id, g.transaction_id FROM raw_gateway_log g
WHERE g.transaction_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM raw_transactions t WHERE t.transaction_type <> 'TRANSFER'
    AND t.transaction_id = g.transaction_id)""", "raw_gateway_log", "raw_transactions"))
def j09(spark, sf_dir):
    """Events whose parent is missing (parents filtered to non-transfers to create orphans)."""
    g = DT.raw_gateway_log(spark, sf_dir).select("gateway_log_id", "transaction_id")
    parents = DT.raw_transactions(spark, sf_dir).filter(F.col("transaction_type") != "TRANSFER")
    return J.orphans(g, "transaction_id", parents, "transaction_id")


@query("j10_disputed_semi", with_views("""
SELECT transaction_id, amount, transaction_type FROM raw_transactions t
WHERE EXISTS (SELECT 1 FROM dispute_memos d WHERE d.transaction_id = t.transaction_id)""",
                                       "raw_transactions", "dispute_memos"))
def j10(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir).select("transaction_id", "amount", "transaction_type")
    return J.semi(t, DT.dispute_memos(spark, sf_dir), "transaction_id")


# --- sort / limit / sample ---------------------------------------------------------------------

@query("l01_order_by", with_views(
    "SELECT currency_code, CAST(count(*) AS BIGINT) AS n FROM raw_transactions "
    "GROUP BY currency_code ORDER BY currency_code", "raw_transactions"))
def l01(spark, sf_dir):
    return (DT.raw_transactions(spark, sf_dir).groupBy("currency_code")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("currency_code"))


@query("l02_topk", with_views("""
SELECT transaction_id, gross_amount, net_amount FROM fact_payment_ledger
ORDER BY gross_amount DESC, transaction_id LIMIT 10""", "fact_payment_ledger"))
def l02(spark, sf_dir):
    """Top-k report: TakeOrderedAndProject (per-partition top-k, then merge of k rows)."""
    return (fact(spark, sf_dir).select("transaction_id", "gross_amount", "net_amount")
            .orderBy(F.col("gross_amount").desc(), "transaction_id").limit(10))


@query("l03_preview", with_views("""
SELECT dispute_id, dispute_category FROM dispute_memos
ORDER BY CAST(dispute_id AS BIGINT) LIMIT 10""", "dispute_memos"))
def l03(spark, sf_dir):
    """A preview gate: LIMIT with an order added so the rows are defined."""
    return (DT.dispute_memos(spark, sf_dir).select("dispute_id", "dispute_category")
            .orderBy(F.col("dispute_id").cast("long")).limit(10))


def sample_bucket(id_col: str) -> "F.Column":
    """Engine-independent hash bucket 0..99 of an id (md5-based)."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10)
                  .cast("long"), F.lit(100))


@query("l04_sample", with_views("""
SELECT dispute_id, dispute_category FROM dispute_memos
WHERE CAST(concat('0x', substr(md5(dispute_id), 1, 8)) AS BIGINT) % 100 < 10""", "dispute_memos"))
def l04(spark, sf_dir):
    """Deterministic 10% sample gate before costly work (the sampling operator itself)."""
    d = DT.dispute_memos(spark, sf_dir)
    return d.filter(sample_bucket("dispute_id") < 10).select("dispute_id", "dispute_category")


# --- projections / predicates / expressions ----------------------------------------------------

@query("p06_ilike", with_views("""
SELECT transaction_id, transaction_type, amount FROM raw_transactions
WHERE transaction_type ILIKE '%refund%'""", "raw_transactions"))
def p06(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.filter(F.col("transaction_type").ilike("%refund%")).select(
        "transaction_id", "transaction_type", "amount")


@query("p11_key", with_views("""
SELECT transaction_id, CAST(concat('0x', substr(md5(transaction_id), 1, 15)) AS BIGINT) AS payment_ledger_key
FROM raw_transactions""", "raw_transactions"))
def p11(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.select("transaction_id", surrogate_key("transaction_id").alias("payment_ledger_key"))


@query("p14_dateadd", with_views("""
SELECT transaction_id, _loaded_at - INTERVAL 30 MINUTE AS window_start FROM raw_transactions""",
                                 "raw_transactions"))
def p14(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.select("transaction_id", minus_minutes("_loaded_at", 30).alias("window_start"))


@query("p18_json_path", """
SELECT event_id, props->>'$.k' AS k, CAST(props->>'$.k' AS BIGINT) AS k_num FROM events""")
def p18(spark, sf_dir):
    e = DT.read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", k.alias("k"), k.cast("long").alias("k_num"))


FILTER_TEMPLATE = K.FILTER_PROMPT


@query("p20_prompt", with_views(f"""
SELECT dispute_id, replace('{FILTER_TEMPLATE}', '{{0}}', memo_text) AS prompt FROM dispute_memos""",
                                "dispute_memos"))
def p20(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    return d.select("dispute_id", prompt(FILTER_TEMPLATE, F.col("memo_text")).alias("prompt"))


@query("p21_load_batch", with_views(
    "SELECT transaction_id, transaction_timestamp, _loaded_at FROM raw_transactions",
    "raw_transactions"))
def p21(spark, sf_dir):
    return DT.raw_transactions(spark, sf_dir).select("transaction_id", "transaction_timestamp",
                                                     "_loaded_at")


@query("p22_cross_border", with_views("""
SELECT t.transaction_id, c.currency_code AS card_currency, t.currency_code AS merchant_currency,
  c.currency_code <> t.currency_code AS is_international
FROM raw_transactions t JOIN raw_card_master c ON t.card_id = c.card_id""",
                                      "raw_transactions", "raw_card_master"))
def p22(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir).select("transaction_id", "card_id",
                                                  F.col("currency_code").alias("merchant_currency"))
    c = DT.card_master(spark, sf_dir).select("card_id", F.col("currency_code").alias("card_currency"))
    return t.join(c, "card_id").select(
        "transaction_id", "card_currency", "merchant_currency",
        cross_border("card_currency", "merchant_currency").alias("is_international"))


@query("p16_round", with_views("""
SELECT transaction_type, CAST(round(sum(amount), 0) AS DECIMAL(18,0)) AS total_rounded
FROM raw_transactions GROUP BY transaction_type""", "raw_transactions"))
def p16(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.groupBy("transaction_type").agg(
        F.round(F.sum("amount"), 0).cast("decimal(18,0)").alias("total_rounded"))


# --- upsert and watermark (as pure queries over the test tables) -------------------------------

def _split(spark, sf_dir):
    """Target = transactions before CUT_OLD; source = transactions from CUT_NEW on, amount + 1."""
    stg = M.stg_transactions(DT.raw_transactions(spark, sf_dir))
    target = stg.filter(F.col("transaction_timestamp") < F.lit(CUT_OLD))
    source = (stg.filter(F.col("transaction_timestamp") >= F.lit(CUT_NEW))
              .withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)")))
    return target, source


@query("u01_merge", with_views("""
SELECT coalesce(s.transaction_id, t.transaction_id) AS transaction_id,
  CASE WHEN s.transaction_id IS NOT NULL THEN s.amount ELSE t.amount END AS amount,
  CASE WHEN s.transaction_id IS NOT NULL THEN s.transaction_type ELSE t.transaction_type END AS transaction_type,
  CASE WHEN s.transaction_id IS NOT NULL AND t.transaction_id IS NOT NULL THEN 'update'
       WHEN s.transaction_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM (SELECT * FROM stg_transactions WHERE transaction_timestamp < TIMESTAMP '1997-01-01') t
FULL JOIN (SELECT transaction_id, transaction_type, CAST(amount + 1 AS DECIMAL(12,2)) AS amount
           FROM stg_transactions WHERE transaction_timestamp >= TIMESTAMP '1996-01-01') s
  ON t.transaction_id = s.transaction_id""", "stg_transactions"))
def u01(spark, sf_dir):
    target, source = _split(spark, sf_dir)
    merged = merge_df(target.select("transaction_id", "amount", "transaction_type"),
                      source.select("transaction_id", "amount", "transaction_type"),
                      "transaction_id", inserted_at=None, updated_at=None)
    return merged.select("transaction_id", "amount", "transaction_type", ACTION)


@query("u08_delta", with_views(f"""
SELECT transaction_id, _loaded_at FROM raw_transactions WHERE _loaded_at > {MARK_SQL}""",
                               "raw_transactions"))
def u08(spark, sf_dir):
    return delta(DT.raw_transactions(spark, sf_dir), MARK).select("transaction_id", "_loaded_at")


@query("u10_advance", with_views(f"""
SELECT 'raw_transactions' AS source_table,
  coalesce(max(_loaded_at), {MARK_SQL}) AS last_loaded_at,
  CAST(count(*) AS BIGINT) AS rows_in_slice
FROM raw_transactions WHERE _loaded_at > {MARK_SQL}""", "raw_transactions"))
def u10(spark, sf_dir):
    """New mark = max load time of the merged slice; unchanged when the slice is empty."""
    control = _control(spark)
    control.reset({"raw_transactions": MARK})
    found = delta(DT.raw_transactions(spark, sf_dir), control.mark("raw_transactions")).agg(
        F.max("_loaded_at").alias("mark"), F.count(F.lit(1)).alias("n")).first()
    control.advance("raw_transactions", found["mark"])
    return control.table.read().select("source_table", "last_loaded_at", F.lit(found["n"]).cast("long").alias("rows_in_slice"))


def _control(spark):
    """A control table of its own below the shared folder."""
    import uuid

    from cardmart.plans.loads import Ledger
    from cardmart.session import checkpoint_root
    return Ledger(spark, f"{checkpoint_root(spark).rstrip('/')}/control/{uuid.uuid4().hex}").control


@query("s14_seed_anti", with_views("""
SELECT source_table, last_loaded_at FROM (
  SELECT 'raw_transactions' AS source_table, max(_loaded_at) AS last_loaded_at FROM raw_transactions) ctl
UNION ALL
SELECT s.source_table, TIMESTAMP '1970-01-01 00:00:00'
FROM (VALUES ('raw_transactions'), ('raw_gateway_log')) s(source_table)
WHERE NOT EXISTS (SELECT 1 FROM (SELECT 'raw_transactions' AS source_table) c
                  WHERE c.source_table = s.source_table)""", "raw_transactions"))
def s14(spark, sf_dir):
    """Seed-if-absent against the stored control table: it holds the mark of one source, and gets
    the seed rows whose key it does not hold (an equi anti join on the stored key)."""
    control = _control(spark)
    mark = DT.raw_transactions(spark, sf_dir).agg(F.max("_loaded_at")).first()[0]
    control.advance("raw_transactions", mark)
    control.seed()
    return control.table.read().select("source_table", "last_loaded_at")


# --- data tests --------------------------------------------------------------------------------

def _suite_sql(checks, tables=None) -> str:
    """``tables``: other tables to read in place of some models."""
    parts = []
    names = tables or {}
    for c in checks:
        model, parent = names.get(c.model, c.model), names.get(c.to_model, c.to_model)
        if c.kind == "unique":
            f = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {model} WHERE {c.column} IS NOT NULL "
                 f"GROUP BY {c.column} HAVING count(*) > 1))")
        elif c.kind == "not_null":
            f = f"(SELECT count(*) FROM {model} WHERE {c.column} IS NULL)"
        else:
            f = (f"(SELECT count(*) FROM {model} ch WHERE ch.{c.column} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {parent} p WHERE p.{c.to_column} = ch.{c.column}))")
        parts.append(f"SELECT '{c.name}' AS test_name, '{c.model}' AS model, '{c.column}' AS column_name, "
                     f"'{c.kind}' AS test_kind, CAST({f} AS BIGINT) AS failures")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM ({body}) x")


_ALL_MODELS = ["raw_transactions", "raw_gateway_log", "raw_card_master", "raw_merchant_master",
               "dispute_memos", "stg_transactions", "stg_gateway_log", "int_transactions_enriched",
               "int_settlements", "int_fees", "dim_merchant", "dim_card", "dim_mcc", "dim_currency",
               "fact_payment_ledger"]


@query("q04_suite", with_views(_suite_sql(Q.LEDGER_CHECKS), *_ALL_MODELS))
def q04(spark, sf_dir):
    return Q.run_suite(_models(spark, sf_dir))


_UNIQ = [c for c in Q.LEDGER_CHECKS if c.kind == "unique"]
_NN = [c for c in Q.LEDGER_CHECKS if c.kind == "not_null"]
_REL = [c for c in Q.LEDGER_CHECKS if c.kind == "relationships"]


@query("q01_unique", with_views(_suite_sql(_UNIQ), *_ALL_MODELS))
def q01(spark, sf_dir):
    return Q.run_suite(_models(spark, sf_dir), _UNIQ)


@query("q02_not_null", with_views(_suite_sql(_NN), *_ALL_MODELS))
def q02(spark, sf_dir):
    return Q.run_suite(_models(spark, sf_dir), _NN)


@query("q03_relationships", with_views(_suite_sql(_REL), *_ALL_MODELS))
def q03(spark, sf_dir):
    return Q.run_suite(_models(spark, sf_dir), _REL)


_BROKEN_CHECKS = [c for c in Q.LEDGER_CHECKS if c.model in (
    "raw_transactions", "dim_mcc", "dim_merchant", "fact_payment_ledger")]


@query("q04_suite_broken", with_views(f"""
SELECT * FROM (WITH broken_transactions AS (
  SELECT CASE WHEN CAST(transaction_id AS BIGINT) % 7 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN CAST(transaction_id AS BIGINT) % 10 = 0 THEN NULL ELSE card_id END AS card_id, merchant_id
  FROM raw_transactions),
broken_mcc AS (
  SELECT mcc_code FROM dim_mcc WHERE CAST(mcc_code AS INTEGER) % 2 = 0
  UNION ALL SELECT mcc_code FROM dim_mcc WHERE CAST(mcc_code AS INTEGER) % 4 = 0),
broken_merchant AS (SELECT merchant_id FROM dim_merchant WHERE CAST(merchant_id AS BIGINT) % 3 <> 0)
{_suite_sql(_BROKEN_CHECKS, {"raw_transactions": "broken_transactions", "dim_mcc": "broken_mcc",
                             "dim_merchant": "broken_merchant"})}) y""",
                                      "raw_transactions", "dim_mcc", "dim_merchant", "dim_card", "dim_currency",
                                      "fact_payment_ledger"))
def q04_broken(spark, sf_dir):
    """The suite over damaged models: NULL keys, parents left out, repeated codes."""
    m = _models(spark, sf_dir)
    key, mcc = F.col("transaction_id").cast("long"), F.col("mcc_code").cast("int")
    tx = m["raw_transactions"].select(F.when(key % 7 != 0, F.col("transaction_id")).alias("transaction_id"),
                                      F.when(key % 10 != 0, F.col("card_id")).alias("card_id"), "merchant_id")
    codes = m["dim_mcc"].select("mcc_code")
    return Q.run_suite({**m, "raw_transactions": tx,
                        "dim_mcc": codes.where(mcc % 2 == 0).unionByName(codes.where(mcc % 4 == 0)),
                        "dim_merchant": m["dim_merchant"].where(F.col("merchant_id").cast("long") % 3 != 0)},
                       _BROKEN_CHECKS)


@query("q05_counts_match", with_views("""
SELECT 'transactions' AS pair, (SELECT count(*) FROM raw_transactions) AS left_rows,
  (SELECT count(*) FROM stg_transactions) AS right_rows,
  (SELECT count(*) FROM raw_transactions) = (SELECT count(*) FROM stg_transactions) AS counts_equal
UNION ALL
SELECT 'gateway', (SELECT count(*) FROM raw_gateway_log), (SELECT count(*) FROM stg_gateway_log),
  (SELECT count(*) FROM raw_gateway_log) = (SELECT count(*) FROM stg_gateway_log)""",
                                      "stg_transactions", "stg_gateway_log"))
def q05(spark, sf_dir):
    m = _models(spark, sf_dir)
    return Q.counts_match({"transactions": (m["raw_transactions"], m["stg_transactions"]),
                           "gateway": (m["raw_gateway_log"], m["stg_gateway_log"])})


@query("q06_fact_checks", with_views("""
SELECT (SELECT count(*) FROM fact_payment_ledger) <= (SELECT count(*) FROM raw_transactions) AS rows_le_transactions,
  (SELECT sum(net_amount) FROM fact_payment_ledger) IS NOT NULL AS total_not_null,
  (SELECT count(*) FILTER (WHERE is_disputed) FROM fact_payment_ledger) > 0 AS has_disputed""",
                                     "fact_payment_ledger", "raw_transactions"))
def q06(spark, sf_dir):
    """Fact rows <= transactions, total not NULL, some disputed -- one folded aggregate."""
    f = fact(spark, sf_dir).select(F.lit("fact").alias("src"), "net_amount", "is_disputed")
    t = DT.raw_transactions(spark, sf_dir).select(
        F.lit("txn").alias("src"), F.lit(None).cast("decimal(16,4)").alias("net_amount"),
        F.lit(False).alias("is_disputed"))
    agg = f.unionByName(t).agg(
        F.count_if(F.col("src") == "fact").alias("n"), F.count_if(F.col("src") == "txn").alias("n_tx"),
        F.sum(F.when(F.col("src") == "fact", F.col("net_amount"))).alias("total"),
        F.count_if(F.col("is_disputed")).alias("disputed"))
    return agg.select((F.col("n") <= F.col("n_tx")).alias("rows_le_transactions"),
                      F.col("total").isNotNull().alias("total_not_null"),
                      (F.col("disputed") > 0).alias("has_disputed"))


@query("q07_grain", with_views("""
SELECT transaction_id, CAST(count(*) AS BIGINT) AS n FROM raw_gateway_log
GROUP BY transaction_id HAVING count(*) > 1""", "raw_gateway_log"))
def q07(spark, sf_dir):
    """Grain check: gateway events are NOT one per transaction (why the window is needed)."""
    from cardmart.operators.upsert import duplicate_keys
    return duplicate_keys(DT.raw_gateway_log(spark, sf_dir).select("transaction_id"),
                          "transaction_id").withColumnRenamed("count", "n")


@query("q08_profile", with_views("""
SELECT transaction_type, CAST(count(*) AS BIGINT) AS n, min(amount) AS min_amount,
  max(amount) AS max_amount, CAST(sum(amount) AS DECIMAL(22,2)) AS sum_amount,
  CAST(count(DISTINCT merchant_id) AS BIGINT) AS merchants,
  CAST(count(DISTINCT hour(_loaded_at)) AS BIGINT) AS load_hours
FROM raw_transactions GROUP BY transaction_type""", "raw_transactions"))
def q08(spark, sf_dir):
    t = DT.raw_transactions(spark, sf_dir)
    return t.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.sum("amount").cast("decimal(22,2)").alias("sum_amount"),
        F.countDistinct("merchant_id").alias("merchants"),
        F.countDistinct(F.hour("_loaded_at")).alias("load_hours"))


_RANK_SQL = "max(amount) FILTER (WHERE rk = greatest(1, CAST(ceil({q} * n) AS BIGINT)))"


@query("q08_profile_detail", with_views(f"""
WITH r AS (SELECT transaction_type, amount, merchant_id, _loaded_at, row_number() OVER (PARTITION BY transaction_type ORDER BY amount) AS rk,
  count(*) OVER (PARTITION BY transaction_type) AS n FROM raw_transactions WHERE amount IS NOT NULL),
m AS (SELECT merchant_id, count(*) AS n, sum(count(*)) OVER () AS total FROM raw_transactions WHERE merchant_id IS NOT NULL GROUP BY 1)
SELECT 'quartile' AS part, transaction_type || ' q' || q AS name, CAST(CASE q WHEN 1 THEN q1 WHEN 2 THEN q2 ELSE q3 END AS DOUBLE) AS value FROM (
  SELECT transaction_type, {', '.join(f"{_RANK_SQL.format(q=q)} AS q{i}" for i, q in ((1, 0.25), (2, 0.5), (3, 0.75)))} FROM r GROUP BY 1), (VALUES (1), (2), (3)) v(q)
UNION ALL SELECT 'hour', CAST(hour(_loaded_at) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM raw_transactions GROUP BY 2
UNION ALL SELECT 'merchant', merchant_id, round(100.0 * n / total, 4) FROM m WHERE n > total * {MERCHANT_SHARE}
UNION ALL SELECT 'mcc', mcc_code, CAST(count(*) AS DOUBLE) FROM raw_transactions GROUP BY 2 HAVING count(*) > (SELECT count(mcc_code) FROM raw_transactions) * 0.05""",
                                          "raw_transactions"))
def q08_detail(spark, sf_dir):
    """Exact quartiles of the amounts of each type, rows by hour, percent of the rows of merchants with more than
    ``MERCHANT_SHARE`` of them, and rows of merchant codes with more than 5%."""
    from cardmart.operators import profile as P
    t = DT.raw_transactions(spark, sf_dir)
    found = P.exact_quantiles(t, "amount", (0.25, 0.5, 0.75), "transaction_type")
    quartiles = spark.createDataFrame([("quartile", f"{g} q{i + 1}", float(x)) for g, xs in found.items() for i, x in enumerate(xs)],
                                      "part string, name string, value double")
    hour = P.hours(t, "_loaded_at").select(F.lit("hour").alias("part"), F.col("hour").cast("string").alias("name"), F.col("n").cast("double").alias("value"))
    merchants = P.heavy_values(t, "merchant_id", MERCHANT_SHARE).select(
        F.lit("merchant").alias("part"), F.col("merchant_id").alias("name"), F.round(F.lit(100.0) * F.col("n") / F.col("total"), 4).alias("value"))
    codes = P.heavy_values(t, "mcc_code", 0.05).select(F.lit("mcc").alias("part"), F.col("mcc_code").alias("name"), F.col("n").cast("double").alias("value"))
    return reduce(DataFrame.unionByName, [quartiles, hour, merchants, codes])


@query("x02_parity", with_views("""
SELECT 'none' AS side, transaction_id FROM fact_payment_ledger WHERE false""",
                                "fact_payment_ledger"))
def x02(spark, sf_dir):
    """Rebuild fact vs. the fact joined from stored-style intermediates: no row differs."""
    from cardmart.plans.loads import fact_of_stored
    raw = DT.raw_tables(spark, sf_dir)
    m = M.build_all(raw)
    a = m["fact_payment_ledger"].withColumn("net_amount", F.col("net_amount").cast("decimal(12,2)"))
    settled_fees = M.int_fees(m["stg_gateway_log"], settled_only=True)
    b = fact_of_stored(m["int_transactions_enriched"], m["int_settlements"], settled_fees, raw["dispute_memos"])
    only_a, only_b = Q.parity_by_bucket(a, b, ["transaction_id"])
    return (only_a.select(F.lit("rebuild").alias("side"), "transaction_id")
            .unionByName(only_b.select(F.lit("upsert").alias("side"), "transaction_id")))


@query("x02_parity_scale", with_views("""
SELECT s.side, f.transaction_id FROM fact_payment_ledger f, (VALUES ('rebuild'), ('upsert')) s(side)
WHERE f.net_amount <> CAST(f.net_amount AS DECIMAL(12,2))""", "fact_payment_ledger"))
def x02_scale(spark, sf_dir):
    """The rebuilt fact against the same fact at scale 2: rows with fractions of a cent differ, on both sides."""
    # Built once and stored: checksums and comparison read it again.
    path = f"{checkpoint_root(spark).rstrip('/')}/parity/{uuid.uuid4().hex}"
    built = fact(spark, sf_dir)
    built.write.option("compression", "zstd").parquet(path)
    a = spark.read.schema(built.schema).parquet(path)
    rounded = F.col("net_amount").cast("decimal(12,2)").cast(a.schema["net_amount"].dataType)
    only_a, only_b = Q.parity_by_bucket(a, a.withColumn("net_amount", rounded), ["transaction_id"], drop=["dw_load_timestamp"])
    return (only_a.select(F.lit("rebuild").alias("side"), "transaction_id")
            .unionByName(only_b.select(F.lit("upsert").alias("side"), "transaction_id")))


@query("x01_union_all", with_views("""
SELECT 'card' AS kind, card_id AS id FROM raw_card_master
UNION ALL SELECT 'merchant', merchant_id FROM raw_merchant_master""",
                                   "raw_card_master", "raw_merchant_master"))
def x01(spark, sf_dir):
    c = DT.card_master(spark, sf_dir).select(F.lit("card").alias("kind"), F.col("card_id").alias("id"))
    m = DT.merchant_master(spark, sf_dir).select(F.lit("merchant").alias("kind"),
                                                 F.col("merchant_id").alias("id"))
    return reduce(DataFrame.unionByName, [c, m])


# --- named models as views, SQL over them, temp tables (S09, S10, S12, L05) --------------------

@query("s10_view_sql", with_views("""
SELECT currency_code, CAST(count(*) AS BIGINT) AS settled, CAST(sum(net_amount) AS DECIMAL(22,4)) AS net
FROM fact_payment_ledger GROUP BY 1 ORDER BY 2 DESC, 1""", "fact_payment_ledger"))
def s10(spark, sf_dir):
    """Models resolved by name and published as temp views, queried with ordinals."""
    from cardmart.plans.registry import ledger_registry
    reg = ledger_registry(spark, DT.raw_tables(spark, sf_dir))
    reg.as_views(["fact_payment_ledger"])
    return spark.sql("""
        SELECT currency_code, count(*) AS settled, CAST(sum(net_amount) AS DECIMAL(22,4)) AS net
        FROM fact_payment_ledger GROUP BY 1 ORDER BY 2 DESC, 1""")


@query("s09_temp_table", with_views("""
SELECT p.dispute_category, CAST(count(*) AS BIGINT) AS n, CAST(sum(t.n_tokens) AS BIGINT) AS tokens
FROM dispute_memos p JOIN (
  SELECT dispute_id, len(regexp_extract_all(memo_text, '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r]')) AS n_tokens
  FROM dispute_memos) t ON p.dispute_id = t.dispute_id
GROUP BY 1""", "dispute_memos"))
def s09(spark, sf_dir):
    """A costly column computed once into a persisted temp table, then reused by SQL."""
    from cardmart.functions.text import token_count
    from cardmart.plans.registry import temp_table
    d = DT.dispute_memos(spark, sf_dir)
    temp_table(d.select("dispute_id", "dispute_category",
                        token_count("memo_text").alias("n_tokens")), "memo_tokens")
    return spark.sql("""SELECT dispute_category, count(*) AS n, CAST(sum(n_tokens) AS BIGINT) AS tokens
                        FROM memo_tokens GROUP BY 1""")


# --- watermark delta over events with late arrivals (U08, trap #8) ------------------------------

EVENTS_MARK = dt.datetime(2024, 1, 15, 2, 30, 0)


def _events_loaded(spark, sf_dir):
    """Events with a load time: the next day's 02:00 batch, or one or two days later for
    a third of them each (an md5 hash of the id picks the delay)."""
    e = DT.read(spark, sf_dir, "events")
    delay = F.pmod(F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 8), 16, 10)
                   .cast("long"), F.lit(3))
    loaded = F.timestamp_add("HOUR", (delay + 1) * 24 + 2, F.date_trunc("DAY", "ts"))
    return e.select("event_id", "ts", loaded.alias("_loaded_at"))


@query("u08_events_late", """
SELECT event_id, ts, _loaded_at, ts <= TIMESTAMP '2024-01-15 02:30:00' AS late_event FROM (
  SELECT event_id, ts, date_trunc('day', ts) + to_hours(
    (CAST(concat('0x', substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 3 + 1) * 24 + 2)
    AS _loaded_at FROM events)
WHERE _loaded_at > TIMESTAMP '2024-01-15 02:30:00'""")
def u08_events(spark, sf_dir):
    """Rows after the load-time mark; events older than the mark that landed late are
    still picked up, because the rule keys on load time, not event time."""
    d = delta(_events_loaded(spark, sf_dir), EVENTS_MARK)
    return d.withColumn("late_event", F.col("ts") <= F.lit(EVENTS_MARK).cast("timestamp_ntz"))
