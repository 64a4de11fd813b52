"""The six load procedures as checked queries: each is run twice, in two steps, with its audit columns.

The first load sees what had landed by ``MARK``.  Then the marks are set back to ``AGAIN`` and all
rows have landed: rows between are merged a second time (updates), later ones inserted.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from cardmart.plans.catalog import query
from cardmart.plans.loads import LOADS, Ledger
from cardmart.plans.oracle_views import DEPS, VIEWS, with_views
from cardmart.plans.queries_relational import MARK, MARK_SQL
from cardmart.schemas import TABLES
from cardmart.session import checkpoint_root
from cardmart.sources import driver_tables as DT

AGAIN = dt.datetime(1997, 3, 1, 2, 30, 0)
AGAIN_SQL = "TIMESTAMP '1997-03-01 02:30:00'"
FIRST, SECOND = "2024-01-01 03:00:00", "2024-01-02 03:00:00"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def loaded_twice(spark, sf_dir, name: str):
    ledger = Ledger(spark, f"{checkpoint_root(spark).rstrip('/')}/ledger/{uuid.uuid4().hex}", buckets=8)
    raw = DT.raw_tables(spark, sf_dir)
    landed = {n: df.where(F.col("_loaded_at") <= F.lit(MARK).cast("timestamp_ntz")) if n in ("raw_transactions", "raw_gateway_log") else df
              for n, df in raw.items()}
    ledger.run(landed, _at(FIRST), upto=name)
    ledger.control.reset({s: AGAIN for s in ("raw_transactions", "raw_gateway_log")}, _at(SECOND))
    ledger.run(raw, _at(SECOND), upto=name)
    return ledger.tables[name].read()


# ---------------------------------------------------------------- the same in SQL

#: Fees of settled transactions only, as the procedure loads them.
_FEES = "SELECT transaction_id, interchange_fee, scheme_fee FROM ranked_gateway WHERE rn = 1 AND settlement_amount IS NOT NULL"
_RAW = ("raw_transactions", "raw_gateway_log")
_BY_TIME = ("raw_transactions", "raw_gateway_log", "stg_transactions", "stg_gateway_log", "ranked_gateway", "int_settlements",
            "int_fees", "int_transactions_enriched")


def _before(name: str) -> str:
    """CTEs of ``name`` and what it needs, over rows landed by ``MARK``; their names end in ``_then``."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n in _BY_TIME and n not in order:
            order.append(n)

    visit(name)
    ctes = []
    for n in order:
        body = f"SELECT * FROM {n} WHERE _loaded_at <= {MARK_SQL}" if n in _RAW else re.sub(
            rf"\b({'|'.join(_BY_TIME)})\b", r"\1_then", _FEES if n == "int_fees" else VIEWS[n])
        ctes.append(f"{n}_then AS ({body})")
    return ",\n".join(ctes)


def _columns(name: str) -> list[str]:
    return [f.name for f in TABLES[name].schema.fields if f.name not in ("transaction_id", "dw_updated_at", "dw_load_timestamp")]


def _merged(name: str, now: str, then: str, stamp: str) -> str:
    """Rows of ``then`` merged with those of ``now`` by transaction, with the time of the last change."""
    cols = _columns(name)
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM t.{c}" for c in cols)
    values = ", ".join(f"CASE WHEN n.transaction_id IS NOT NULL THEN n.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"""SELECT coalesce(n.transaction_id, t.transaction_id) AS transaction_id, {values},
  CASE WHEN t.transaction_id IS NOT NULL AND (n.transaction_id IS NULL OR ({same})) THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS {stamp}
FROM {now} n FULL JOIN {then} t ON n.transaction_id = t.transaction_id"""


def _staging_sql(name: str, raw: str) -> str:
    cols = ", ".join(f.name for f in TABLES[name].schema.fields if f.name not in ("source_loaded_at", "dw_inserted_at", "dw_updated_at"))
    return with_views(f"""SELECT {cols}, _loaded_at AS source_loaded_at,
  CASE WHEN _loaded_at <= {MARK_SQL} THEN TIMESTAMP '{FIRST}' ELSE TIMESTAMP '{SECOND}' END AS dw_inserted_at,
  CASE WHEN _loaded_at > {AGAIN_SQL} THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS dw_updated_at FROM {raw}""", raw)


def _int_sql(name: str) -> str:
    now = f"({_FEES})" if name == "int_fees" else name
    return with_views(f"WITH {_before(name)} {_merged(name, now, name + '_then', 'dw_updated_at')}", name, "ranked_gateway")


def _fact_sql() -> str:
    parts = ("int_transactions_enriched", "int_settlements", "int_fees")
    # CTEs that several tables need come once.
    then = {c.split(" AS ", 1)[0]: c for p in parts for c in re.split(r",\n(?=\w+_then AS )", _before(p))}
    stored = ",\n".join(f"{p}_stored AS ({_merged(p, f'({_FEES})' if p == 'int_fees' else p, p + '_then', 'dw_updated_at')})" for p in parts)

    def fact(suffix: str) -> str:
        return f"""SELECT CAST('0x' || left(md5(transaction_id), 15) AS BIGINT) AS payment_ledger_key, transaction_id,
  transaction_timestamp AS transaction_ts, card_id, merchant_id, mcc_code, currency_code, transaction_type, entry_mode, auth_status,
  is_international, CAST(CASE WHEN upper(transaction_type) LIKE '%REFUND%' THEN -abs(amount) ELSE abs(amount) END AS DECIMAL(12,2)) AS gross_amount,
  settlement_amount, interchange_fee, scheme_fee, CAST(settlement_amount - interchange_fee - scheme_fee AS DECIMAL(12,2)) AS net_amount,
  transaction_id IN (SELECT transaction_id FROM dispute_memos WHERE transaction_id IS NOT NULL) AS is_disputed
FROM int_settlements{suffix} JOIN int_fees{suffix} USING (transaction_id) JOIN int_transactions_enriched{suffix} USING (transaction_id)"""

    return with_views(f"WITH {', '.join(then.values())}, {stored}, fact_now AS ({fact('_stored')}), fact_then AS ({fact('_then')})\n"
                      f"{_merged('fact_payment_ledger', 'fact_now', 'fact_then', 'dw_load_timestamp')}", *parts, "dispute_memos")


ORACLES = {"stg_transactions": _staging_sql("stg_transactions", "raw_transactions"),
           "stg_gateway_log": _staging_sql("stg_gateway_log", "raw_gateway_log"),
           **{n: _int_sql(n) for n in LOADS[2:5]}, "fact_payment_ledger": _fact_sql()}

for _n, _name in enumerate(LOADS):
    query(f"u0{_n + 2}_load_{_name}", ORACLES[_name])(lambda spark, sf_dir, name=_name: loaded_twice(spark, sf_dir, name))
