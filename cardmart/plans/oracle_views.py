"""The raw-layer mapping of ``cardmart.sources.driver_tables`` written as DuckDB SQL.

Used only by the correctness oracle: every oracle query is prefixed with the
CTEs it needs, over the driver's pre-registered test-table views.  The Spark
side never runs this text; it builds the same tables with DataFrame code.
"""

from __future__ import annotations

from cardmart import constants as K


def _list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CUR = _list(K.CURRENCIES)
NET = _list(K.CARD_NETWORKS)
MCC_CODES = _list([c for c, _ in K.MCCS])
MCC_DESCS = _list([d for _, d in K.MCCS])
GWS = _list(K.GATEWAYS)
CATS = _list(K.DISPUTE_CATEGORIES)
REASONS = _list([r for _, r, _ in K.DISPUTE_TEMPLATES])
STATUSES = _list(K.DISPUTE_STATUSES)

N_SUP = "(SELECT count(*) FROM supplier)"
N_ORD = "(SELECT count(*) FROM orders)"


def _loaded(ts: str, key: str) -> str:
    return f"(date_trunc('day', {ts}) + INTERVAL 26 HOUR + to_seconds(({key}) % 3601))"


VIEWS: dict[str, str] = {
    "raw_card_master": f"""
SELECT CAST(c_custkey AS VARCHAR) AS card_id, c_name AS card_holder_name,
  CASE WHEN ({NET})[c_custkey % 4 + 1] = 'VISA' THEN CAST(c_custkey % 100000 + 400000 AS VARCHAR)
       ELSE CAST(c_custkey % 50000 + 510000 AS VARCHAR) END AS bin,
  lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS last_four,
  c_mktsegment AS card_type, ({NET})[c_custkey % 4 + 1] AS card_network,
  ({CUR})[c_nationkey % 7 + 1] AS currency_code,
  DATE '2021-01-01' + CAST(c_custkey % 900 AS INTEGER) AS issued_date,
  CASE WHEN c_acctbal < 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS card_status
FROM customer""",
    "raw_merchant_master": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
  ({MCC_CODES})[s_suppkey % 15 + 1] AS mcc_code, ({MCC_DESCS})[s_suppkey % 15 + 1] AS mcc_description,
  n_name AS merchant_country, 'CITY-' || CAST(s_suppkey % 97 AS VARCHAR) AS merchant_city,
  DATE '2019-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS onboarded_date,
  CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS merchant_status
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_transactions": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_custkey AS VARCHAR) AS card_id,
  CAST(o_orderkey % {N_SUP} AS VARCHAR) AS merchant_id,
  CASE WHEN o_orderkey % 100 < 80 THEN 'PURCHASE' WHEN o_orderkey % 100 < 88 THEN 'REFUND'
       WHEN o_orderkey % 100 < 95 THEN 'REVERSAL' ELSE 'TRANSFER' END AS transaction_type,
  CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
  ({CUR})[s.s_nationkey % 7 + 1] AS currency_code,
  o_orderdate AS transaction_timestamp,
  CASE WHEN o_orderstatus = 'F' THEN 'DECLINED' ELSE 'APPROVED' END AS auth_status,
  ({MCC_CODES})[(o_orderkey % {N_SUP}) % 15 + 1] AS mcc_code,
  o_orderpriority AS entry_mode,
  ({CUR})[c.c_nationkey % 7 + 1] <> ({CUR})[s.s_nationkey % 7 + 1] AS is_international,
  {_loaded('o_orderdate', 'o_orderkey')} AS _loaded_at
FROM orders o
LEFT JOIN supplier s ON o.o_orderkey % {N_SUP} = s.s_suppkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
    "raw_gateway_log": f"""
SELECT gateway_log_id, transaction_id, gateway_name, upper(substr(md5(gateway_log_id), 1, 6)) AS auth_code,
  response_code, response_message, gateway_timestamp, settlement_amount, interchange_fee, scheme_fee,
  _loaded_at
FROM (
  SELECT concat_ws('-', lpad(CAST(l_orderkey AS VARCHAR), 12, '0'), lpad(CAST(l_linenumber AS VARCHAR), 3, '0'),
           lpad(CAST(l_partkey AS VARCHAR), 10, '0'), lpad(CAST(l_suppkey AS VARCHAR), 10, '0'),
           lpad(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), 15, '0')) AS gateway_log_id,
    CAST(l_orderkey AS VARCHAR) AS transaction_id,
    ({GWS})[l_suppkey % 3 + 1] AS gateway_name,
    CASE WHEN l_returnflag = 'R' THEN '05' ELSE '00' END AS response_code,
    CASE WHEN l_returnflag = 'R' THEN 'Do Not Honor' ELSE 'Approved' END AS response_message,
    l_shipdate AS gateway_timestamp,
    CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS settlement_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(12,4)) AS interchange_fee,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(12,2)) AS DECIMAL(12,4)) AS scheme_fee,
    {_loaded('l_shipdate', 'l_orderkey + l_linenumber')} AS _loaded_at
  FROM lineitem) g""",
    "dispute_memos": f"""
SELECT CAST(doc_id AS VARCHAR) AS dispute_id,
  CAST((doc_id * 7) % {N_ORD} AS VARCHAR) AS transaction_id,
  CAST(((doc_id * 7) % {N_ORD}) % {N_SUP} AS VARCHAR) AS merchant_id,
  ({CATS})[doc_id % 8 + 1] AS dispute_category,
  ({REASONS})[doc_id % 8 + 1] AS dispute_reason_code,
  ({STATUSES})[doc_id % 4 + 1] AS dispute_status,
  text AS memo_text, lang, source
FROM documents""",
}

# Models over the raw views (the declarative-model rebuild), in dependency order.
VIEWS["stg_transactions"] = """
SELECT transaction_id, card_id, merchant_id, transaction_type, amount, currency_code,
  transaction_timestamp, auth_status, mcc_code, entry_mode, is_international, _loaded_at AS source_loaded_at
FROM raw_transactions"""
VIEWS["stg_gateway_log"] = """
SELECT gateway_log_id, transaction_id, gateway_name, auth_code, response_code, response_message,
  gateway_timestamp, settlement_amount, interchange_fee, scheme_fee, _loaded_at AS source_loaded_at
FROM raw_gateway_log"""
VIEWS["ranked_gateway"] = """
SELECT *, row_number() OVER (PARTITION BY transaction_id
                             ORDER BY gateway_timestamp DESC NULLS FIRST, gateway_log_id DESC) AS rn
FROM stg_gateway_log"""
VIEWS["int_settlements"] = """
SELECT transaction_id, settlement_amount, gateway_timestamp AS settled_at
FROM ranked_gateway WHERE rn = 1 AND settlement_amount IS NOT NULL"""
VIEWS["int_fees"] = """
SELECT transaction_id, interchange_fee, scheme_fee FROM ranked_gateway WHERE rn = 1"""
VIEWS["int_transactions_enriched"] = """
SELECT t.* EXCLUDE (source_loaded_at), m.merchant_name, m.mcc_description, m.merchant_country, m.merchant_city,
  c.card_holder_name, c.card_type, c.card_network
FROM raw_merchant_master m, raw_card_master c, stg_transactions t
WHERE t.merchant_id = m.merchant_id AND c.card_id = t.card_id"""
VIEWS["fact_payment_ledger"] = """
WITH settled AS (
  SELECT transaction_id, settlement_amount, interchange_fee, scheme_fee
  FROM ranked_gateway WHERE rn = 1 AND settlement_amount IS NOT NULL),
disputed AS (SELECT DISTINCT transaction_id AS disputed_id FROM dispute_memos)
SELECT CAST('0x' || left(md5(transaction_id), 15) AS BIGINT) AS payment_ledger_key, transaction_id,
  e.transaction_timestamp AS transaction_ts, card_id, merchant_id, mcc_code, currency_code, transaction_type,
  entry_mode, auth_status, is_international,
  abs(amount) * CASE WHEN upper(transaction_type) LIKE '%REFUND%' THEN -1 ELSE 1 END AS gross_amount,
  settlement_amount, interchange_fee, scheme_fee,
  settlement_amount - (interchange_fee + scheme_fee) AS net_amount, disputed_id IS NOT NULL AS is_disputed
FROM settled JOIN int_transactions_enriched e USING (transaction_id)
LEFT JOIN disputed ON disputed_id = transaction_id"""

VIEWS["dim_merchant"] = """
SELECT merchant_id, merchant_name, merchant_country, merchant_city, onboarded_date, merchant_status
FROM raw_merchant_master"""
VIEWS["dim_card"] = """
SELECT card_id, card_holder_name, bin, last_four, card_type, card_network, currency_code, issued_date,
  card_status FROM raw_card_master"""
VIEWS["dim_mcc"] = "SELECT DISTINCT mcc_code, mcc_description FROM raw_merchant_master"
VIEWS["dim_currency"] = "SELECT DISTINCT currency_code FROM raw_transactions"

# Dependencies of each view (so a query only carries the CTEs it needs).
DEPS: dict[str, list[str]] = {
    "raw_card_master": [], "raw_merchant_master": [], "raw_transactions": [],
    "raw_gateway_log": [], "dispute_memos": [],
    "stg_transactions": ["raw_transactions"],
    "stg_gateway_log": ["raw_gateway_log"],
    "ranked_gateway": ["stg_gateway_log"],
    "int_settlements": ["ranked_gateway"],
    "int_fees": ["ranked_gateway"],
    "int_transactions_enriched": ["stg_transactions", "raw_card_master", "raw_merchant_master"],
    "fact_payment_ledger": ["int_transactions_enriched", "int_settlements", "int_fees",
                            "dispute_memos"],
    "dim_merchant": ["raw_merchant_master"], "dim_card": ["raw_card_master"],
    "dim_mcc": ["raw_merchant_master"], "dim_currency": ["raw_transactions"],
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the CTEs for ``names`` and everything they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in order)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":  # the query's own CTEs follow ours
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
