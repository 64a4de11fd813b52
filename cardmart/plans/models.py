"""Staging, intermediate, dimension and fact models as DataFrame functions.

Each model is a pure function of its input DataFrames, so the whole fact
build is one lazy logical plan over the raw tables (as a view chain would
be), and Catalyst prunes, pushes down and plans it as one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmart.functions.keys import load_time, net_amount, signed_gross, surrogate_key
from cardmart.operators.joins import existence_flag
from cardmart.operators.latest import latest_gateway_event

TXN_COLS = ["transaction_id", "card_id", "merchant_id", "transaction_type", "amount",
            "currency_code", "transaction_timestamp", "auth_status", "mcc_code", "entry_mode",
            "is_international"]
GW_COLS = ["gateway_log_id", "transaction_id", "gateway_name", "auth_code", "response_code",
           "response_message", "gateway_timestamp", "settlement_amount", "interchange_fee",
           "scheme_fee"]


def _stamp(df: DataFrame, with_load_time: bool, name: str = "dw_updated_at") -> DataFrame:
    return df.withColumn(name, load_time()) if with_load_time else df


# --- staging (D05, D06): projection + rename -------------------------------------------

def stg_transactions(raw_transactions: DataFrame) -> DataFrame:
    return raw_transactions.select(*TXN_COLS, F.col("_loaded_at").alias("source_loaded_at"))


def stg_gateway_log(raw_gateway_log: DataFrame) -> DataFrame:
    return raw_gateway_log.select(*GW_COLS, F.col("_loaded_at").alias("source_loaded_at"))


# --- intermediate (D07-D09) ---------------------------------------------------------------

def int_transactions_enriched(stg_tx: DataFrame, cards: DataFrame, merchants: DataFrame,
                              with_load_time: bool = False) -> DataFrame:
    """Transactions + card and merchant attributes (inner joins J01, J02).

    The transaction keeps its own ``mcc_code``; the description comes from
    the merchant (trap #20).  Masters are joined with plain equi-joins: AQE
    turns them into broadcast joins when the measured side is small and keeps
    sort-merge (with skew splitting) when it is not.
    """
    c = cards.select("card_id", "card_holder_name", "card_type", "card_network")
    m = merchants.select("merchant_id", "merchant_name", "mcc_description", "merchant_country",
                         "merchant_city")
    out = (stg_tx.join(c, "card_id", "inner").join(m, "merchant_id", "inner")
           .select("transaction_id", "transaction_timestamp", "card_id", "card_holder_name",
                   "card_type", "card_network", "merchant_id", "merchant_name", "mcc_code",
                   "mcc_description", "merchant_country", "merchant_city", "currency_code",
                   "transaction_type", "entry_mode", "auth_status", "is_international", "amount"))
    return _stamp(out, with_load_time)


def int_settlements(stg_gw: DataFrame, with_load_time: bool = False) -> DataFrame:
    """One row per transaction whose final gateway event settled."""
    out = (latest_gateway_event(stg_gw, ["transaction_id", "settlement_amount",
                                         "gateway_timestamp"], settled_only=True)
           .withColumnRenamed("gateway_timestamp", "settled_at"))
    return _stamp(out, with_load_time)


def int_fees(stg_gw: DataFrame, settled_only: bool = False,
             with_load_time: bool = False) -> DataFrame:
    """Fees of the final event (W02, D09).  ``settled_only`` is the procedure flavour (trap #4)."""
    out = latest_gateway_event(stg_gw, ["transaction_id", "interchange_fee", "scheme_fee"],
                               settled_only=settled_only)
    return _stamp(out, with_load_time)


# --- dimensions (D01-D04) -----------------------------------------------------------------

def dim_merchant(merchants: DataFrame, with_load_time: bool = False) -> DataFrame:
    return _stamp(merchants.select("merchant_id", "merchant_name", "merchant_country",
                                   "merchant_city", "onboarded_date", "merchant_status"),
                  with_load_time)


def dim_card(cards: DataFrame, with_load_time: bool = False) -> DataFrame:
    return _stamp(cards.select("card_id", "card_holder_name", "bin", "last_four", "card_type",
                               "card_network", "currency_code", "issued_date", "card_status"),
                  with_load_time)


def dim_mcc(merchants: DataFrame, with_load_time: bool = False) -> DataFrame:
    """DISTINCT over (code, description) -- tested unique on code only (trap #16)."""
    return _stamp(merchants.select("mcc_code", "mcc_description").distinct(), with_load_time)


def dim_currency(raw_transactions: DataFrame, with_load_time: bool = False) -> DataFrame:
    return _stamp(raw_transactions.select("currency_code").distinct(), with_load_time)


# --- fact (D10) -----------------------------------------------------------------------------

FACT_COLS = ["payment_ledger_key", "transaction_id", "transaction_ts", "card_id", "merchant_id",
             "mcc_code", "currency_code", "transaction_type", "entry_mode", "auth_status",
             "is_international", "gross_amount", "settlement_amount", "interchange_fee",
             "scheme_fee", "net_amount", "is_disputed"]


def fact_payment_ledger(enriched: DataFrame, stg_gw: DataFrame, disputes: DataFrame,
                        net_scale2: bool = False, with_load_time: bool = False) -> DataFrame:
    """One row per settled transaction (J03 + J04 + P06-P11).

    Settlement and fee columns come from ONE ranked pass over the gateway
    events (not two windows joined back together): one shuffle of the events
    by ``transaction_id``, whose output partitioning the join to the enriched
    transactions then reuses.  The inner join is the grain filter.  The
    dispute flag is an existence test against the *distinct* disputed ids, so
    a transaction with several memos is neither duplicated (trap #6) nor a
    hot key in the join.
    """
    final = latest_gateway_event(
        stg_gw, ["transaction_id", "settlement_amount", "interchange_fee", "scheme_fee"],
        settled_only=True)
    joined = enriched.join(final, "transaction_id", "inner")
    flagged = existence_flag(joined, disputes, "transaction_id", "is_disputed")
    return _stamp(ledger_rows(flagged, net_scale2), with_load_time, "dw_load_timestamp")


def ledger_rows(joined: DataFrame, net_scale2: bool = False) -> DataFrame:
    """The columns of the fact from transactions that carry their amounts, fees and dispute flag."""
    return joined.select(
        surrogate_key("transaction_id").alias("payment_ledger_key"),
        "transaction_id",
        F.col("transaction_timestamp").alias("transaction_ts"),
        "card_id", "merchant_id", "mcc_code", "currency_code", "transaction_type", "entry_mode",
        "auth_status", "is_international",
        signed_gross("transaction_type", "amount").alias("gross_amount"),
        "settlement_amount", "interchange_fee", "scheme_fee",
        net_amount("settlement_amount", "interchange_fee", "scheme_fee", scale2=net_scale2)
        .alias("net_amount"),
        "is_disputed",
    )


def build_all(raw: dict[str, DataFrame], with_load_time: bool = False) -> dict[str, DataFrame]:
    """Every model, rebuilt from the raw tables (full-refresh / declarative-model flavour)."""
    stg_tx = stg_transactions(raw["raw_transactions"])
    stg_gw = stg_gateway_log(raw["raw_gateway_log"])
    enriched = int_transactions_enriched(stg_tx, raw["raw_card_master"],
                                         raw["raw_merchant_master"])
    return {
        "stg_transactions": stg_tx,
        "stg_gateway_log": stg_gw,
        "int_transactions_enriched": _stamp(enriched, with_load_time),
        "int_settlements": int_settlements(stg_gw, with_load_time),
        "int_fees": int_fees(stg_gw, with_load_time=with_load_time),
        "dim_merchant": dim_merchant(raw["raw_merchant_master"], with_load_time),
        "dim_card": dim_card(raw["raw_card_master"], with_load_time),
        "dim_mcc": dim_mcc(raw["raw_merchant_master"], with_load_time),
        "dim_currency": dim_currency(raw["raw_transactions"], with_load_time),
        "fact_payment_ledger": fact_payment_ledger(enriched, stg_gw, raw["dispute_memos"],
                                                   with_load_time=with_load_time),
    }
