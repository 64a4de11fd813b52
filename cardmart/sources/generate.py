"""Seeded, scalable synthetic card-payment data as Spark jobs.

Every random draw is a pure function of (seed, field name, row id):
``u = pmod(xxhash64(seed, field, id), 2^53) / 2^53`` is uniform in [0, 1).
So the output does not depend on partitioning, task retries or executor
loss -- the same seed gives the same rows -- and generation is embarrassingly
parallel from ``spark.range``.  Dates are anchored on a fixed day, not on
"now", so a dataset is reproducible over time (trap #10).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardmart import constants as K
from cardmart.functions.keys import load_batch_time
from cardmart.sources.driver_tables import pick

TWO53 = float(2 ** 53)

# Seeded name parts (replacing a fake-name library; not domain reference data).
_FIRST = ["Ava", "Ben", "Chloe", "Dev", "Elena", "Farid", "Grace", "Hiro", "Ines", "Jonas",
          "Kira", "Liam", "Maya", "Noah", "Olga", "Priya", "Quinn", "Rosa", "Sam", "Tara"]
_LAST = ["Adams", "Brown", "Costa", "Dubois", "Evans", "Fischer", "Garcia", "Hughes", "Ito",
         "Jensen", "Kowalski", "Lopez", "Meyer", "Nakamura", "Okafor", "Patel", "Rossi",
         "Silva", "Tanaka", "Weber"]
_BRAND = ["Summit", "Harbor", "Maple", "Cedar", "Nova", "Atlas", "Beacon", "Copper", "Delta",
          "Ember", "Falcon", "Granite", "Horizon", "Iris", "Juniper", "Keystone"]
_KIND = ["Market", "Goods", "Supply", "Outfitters", "Kitchen", "Digital", "Travel", "Pharmacy",
         "Motors", "Studio"]
_CITY = ["Springfield", "Riverton", "Lakeside", "Fairview", "Georgetown", "Kingston", "Oakridge",
         "Milford", "Ashland", "Clayton", "Dayton", "Franklin"]


@dataclass(frozen=True)
class GenParams:
    """Size and seed parameters."""
    rows: int = K.DEFAULT_ROWS
    seed: int = K.DEFAULT_SEED
    merchants: int = K.N_MERCHANTS
    cards: int = K.N_CARDS
    disputes: int = K.N_DISPUTES
    history_days: int = K.HISTORY_DAYS
    anchor: dt.date = dt.date(2025, 1, 1)


def uniform(seed: int, field: str, row_id: Column) -> Column:
    """Deterministic U[0,1) per (seed, field, row)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(field), row_id), F.lit(2 ** 53)) / F.lit(TWO53)


def _pick_u(values: list[str], u: Column) -> Column:
    return pick(values, F.floor(u * len(values)))


def _weighted(pairs: list[tuple[str, int]], u: Column) -> Column:
    total = float(sum(w for _, w in pairs))
    acc, out = 0.0, None
    for value, w in pairs:
        acc += w / total
        out = F.when(u < acc, value) if out is None else out.when(u < acc, value)
    return out.otherwise(pairs[-1][0])


def _anchor_ts(p: GenParams) -> Column:
    return F.lit(dt.datetime.combine(p.anchor, dt.time())).cast("timestamp_ntz")


def merchants(spark: SparkSession, p: GenParams = GenParams()) -> DataFrame:
    """Id M%05d, random MCC and country, onboarding date, 90% active."""
    r = spark.range(1, p.merchants + 1)
    u = lambda f: uniform(p.seed, f"m.{f}", F.col("id"))
    mcc_i = F.floor(u("mcc") * len(K.MCCS))
    onboarded = F.date_add(F.lit(p.anchor), -(F.lit(100) + F.floor(u("onb") * (4 * 365 - 100)))
                           .cast("int"))
    return r.select(
        F.format_string("M%05d", F.col("id")).alias("merchant_id"),
        F.concat_ws(" ", _pick_u(_BRAND, u("n1")), _pick_u(_KIND, u("n2"))).alias("merchant_name"),
        pick([c for c, _ in K.MCCS], mcc_i).alias("mcc_code"),
        pick([d for _, d in K.MCCS], mcc_i).alias("mcc_description"),
        _pick_u([c for c, _ in K.COUNTRY_CURRENCY], u("country")).alias("merchant_country"),
        _pick_u(_CITY, u("city")).alias("merchant_city"),
        onboarded.alias("onboarded_date"),
        F.when(u("status") > 0.1, "ACTIVE").otherwise("INACTIVE").alias("merchant_status"),
        load_batch_time(onboarded.cast("timestamp_ntz"), F.concat(F.lit("m"), F.col("id")))
        .alias("_loaded_at"))


def cards(spark: SparkSession, p: GenParams = GenParams()) -> DataFrame:
    """Id C%06d, BIN by network, last four, type, weighted status."""
    r = spark.range(1, p.cards + 1)
    u = lambda f: uniform(p.seed, f"c.{f}", F.col("id"))
    network = _pick_u(K.CARD_NETWORKS, u("net"))
    issued = F.date_add(F.lit(p.anchor), -(F.lit(30) + F.floor(u("iss") * (3 * 365 - 30)))
                        .cast("int"))
    return r.select(
        F.format_string("C%06d", F.col("id")).alias("card_id"),
        F.concat_ws(" ", _pick_u(_FIRST, u("f")), _pick_u(_LAST, u("l"))).alias("card_holder_name"),
        F.when(network == "VISA", (F.floor(u("bin") * 100000) + 400000).cast("string"))
         .otherwise((F.floor(u("bin") * 50000) + 510000).cast("string")).alias("bin"),
        F.lpad(F.floor(u("last4") * 10000).cast("string"), 4, "0").alias("last_four"),
        _pick_u(K.CARD_TYPES, u("type")).alias("card_type"),
        network.alias("card_network"),
        _pick_u([c for _, c in K.COUNTRY_CURRENCY], u("cur")).alias("currency_code"),
        issued.alias("issued_date"),
        _weighted(K.CARD_STATUS_WEIGHTS, u("status")).alias("card_status"),
        load_batch_time(issued.cast("timestamp_ntz"), F.concat(F.lit("c"), F.col("id")))
        .alias("_loaded_at"))


def transactions(spark: SparkSession, p: GenParams = GenParams(),
                 merchant_df: DataFrame | None = None, card_df: DataFrame | None = None) -> DataFrame:
    """FK picks, weighted types, 92/8 amount mixture, 88% approved, history window."""
    m = (merchant_df if merchant_df is not None else merchants(spark, p)).select(
        "merchant_id", "mcc_code", F.col("merchant_country"))
    cur_map = F.create_map(*[F.lit(x) for kv in K.COUNTRY_CURRENCY for x in kv])
    m = m.select("merchant_id", "mcc_code", F.element_at(cur_map, F.col("merchant_country"))
                 .alias("currency_code"))
    c = (card_df if card_df is not None else cards(spark, p)).select(
        "card_id", F.col("currency_code").alias("card_currency"))
    r = spark.range(1, p.rows + 1)
    u = lambda f: uniform(p.seed, f"t.{f}", F.col("id"))
    start = F.timestamp_add("DAY", F.lit(-p.history_days), _anchor_ts(p))
    ts = F.timestamp_add("SECOND", F.floor(u("ts") * (p.history_days * 24 * 3600 + 1)), start)
    small = F.round(F.lit(1.0) + u("amt") * 499.0, 2)
    large = F.round(F.lit(500.0) + u("amt") * 3500.0, 2)
    base = r.select(
        F.col("id").alias("_n"),
        F.format_string("T%07d", F.col("id")).alias("transaction_id"),
        F.format_string("C%06d", F.floor(u("card") * p.cards) + 1).alias("card_id"),
        F.format_string("M%05d", F.floor(u("merchant") * p.merchants) + 1).alias("merchant_id"),
        _weighted(K.TXN_TYPE_WEIGHTS, u("type")).alias("transaction_type"),
        F.when(u("mix") < 0.92, small).otherwise(large).cast("decimal(12,2)").alias("amount"),
        ts.alias("transaction_timestamp"),
        F.when(u("auth") < 0.88, "APPROVED").otherwise("DECLINED").alias("auth_status"),
        _pick_u(K.ENTRY_MODES, u("entry")).alias("entry_mode"))
    j = base.join(m, "merchant_id", "left").join(c, "card_id", "left")
    return j.select(
        "_n", "transaction_id", "card_id", "merchant_id", "transaction_type", "amount",
        "currency_code", "transaction_timestamp", "auth_status", "mcc_code", "entry_mode",
        (F.col("card_currency") != F.col("currency_code")).alias("is_international"),
        load_batch_time("transaction_timestamp", "transaction_id").alias("_loaded_at"))


def gateway_log(txns: DataFrame, p: GenParams = GenParams()) -> DataFrame:
    """One event per transaction, plus an approved retry for 15% of declines."""
    u = lambda f, key: uniform(p.seed, f"g.{f}", key)
    tkey = F.col("transaction_id")
    declined = F.col("auth_status") == "DECLINED"
    n_events = F.when(declined & (u("retry", tkey) < K.RETRY_SHARE_OF_DECLINES), 2).otherwise(1)
    ev = txns.select("transaction_id", "transaction_type", "amount", "transaction_timestamp",
                     "auth_status", F.explode(F.sequence(F.lit(1), n_events)).alias("seq"))
    ekey = F.concat_ws("#", tkey, F.col("seq").cast("string"))
    approved = (F.col("seq") == 2) | (F.col("auth_status") == "APPROVED")
    codes = {c: (msg, ok) for c, msg, ok in K.RESPONSE_CODES}
    decline_code = _weighted(K.DECLINE_CODE_WEIGHTS, u("code", ekey))
    code = F.when(approved, "00").otherwise(decline_code)
    msg = None
    for c, (m, _) in codes.items():
        msg = F.when(code == c, m) if msg is None else msg.when(code == c, m)
    first_ts = F.timestamp_add("SECOND", F.floor(u("lag", tkey) * 8) + 1, "transaction_timestamp")
    gw_ts = F.when(F.col("seq") == 1, first_ts).otherwise(
        F.timestamp_add("SECOND", F.floor(u("retry_lag", tkey) * 101) + 20, first_ts))
    signed = F.when(F.col("transaction_type").isin("PURCHASE", "TRANSFER"), F.col("amount")) \
        .otherwise(-F.col("amount"))
    settlement = F.when(approved, signed).otherwise(F.lit(0)).cast("decimal(12,2)")
    abs_s = F.abs(settlement).cast("double")
    ic = F.round(abs_s * (F.lit(0.0015) + u("ic", ekey) * 0.0185), 4)
    sc = F.round(abs_s * (F.lit(0.0005) + u("sc", ekey) * 0.001), 4)
    auth = F.upper(F.substring(F.sha2(ekey, 256), 1, 6))
    return ev.select(
        F.concat(F.lit("G"), F.regexp_replace(tkey, "^T", ""), F.col("seq").cast("string"))
        .alias("gateway_log_id"),
        "transaction_id",
        _pick_u(K.GATEWAYS, u("gw", ekey)).alias("gateway_name"),
        auth.alias("auth_code"),
        code.alias("response_code"), msg.alias("response_message"),
        gw_ts.alias("gateway_timestamp"),
        settlement.alias("settlement_amount"),
        F.when(approved, ic).otherwise(0.0).cast("decimal(12,4)").alias("interchange_fee"),
        F.when(approved, sc).otherwise(0.0).cast("decimal(12,4)").alias("scheme_fee"),
        load_batch_time(gw_ts, ekey).alias("_loaded_at"))


def disputes(txns: DataFrame, merchant_df: DataFrame, p: GenParams = GenParams()) -> DataFrame:
    """Sample without replacement among approved purchases, template-filled memo."""
    eligible = txns.filter((F.col("auth_status") == "APPROVED")
                           & (F.col("transaction_type") == "PURCHASE"))
    # the sampling operator: the n eligible rows with the smallest seeded hash
    sample = (eligible.withColumn("_h", F.xxhash64(F.lit(p.seed), F.lit("d.pick"),
                                                   F.col("transaction_id")))
              .orderBy("_h", "transaction_id").limit(p.disputes))
    names = merchant_df.select("merchant_id", "merchant_name")
    s = sample.join(names, "merchant_id", "left")
    u = lambda f: uniform(p.seed, f"d.{f}", F.col("transaction_id"))
    cat_i = F.floor(u("cat") * len(K.DISPUTE_TEMPLATES))
    cat = pick(K.DISPUTE_CATEGORIES, cat_i)
    tpl = pick([t for _, _, t in K.DISPUTE_TEMPLATES], cat_i)
    memo = tpl
    for slot, val in (("{amount}", F.col("amount").cast("string")),
                      ("{currency}", F.col("currency_code")),
                      ("{merchant}", F.col("merchant_name")),
                      ("{date}", F.to_date("transaction_timestamp").cast("string"))):
        memo = F.replace(memo, F.lit(slot), F.coalesce(val, F.lit("")))
    # numbering the n sampled rows: a window over the (bounded) sample only
    w = F.row_number().over(Window.orderBy("_h", "transaction_id"))
    return s.select(
        F.format_string("D%05d", w).alias("dispute_id"), "transaction_id", "merchant_id",
        "card_id", cat.alias("dispute_category"),
        pick([r for _, r, _ in K.DISPUTE_TEMPLATES], cat_i).alias("dispute_reason_code"),
        _pick_u(K.DISPUTE_STATUSES, u("status")).alias("dispute_status"),
        F.date_add(F.to_date("transaction_timestamp"), (F.floor(u("created") * 24) + 2).cast("int"))
        .alias("created_date"),
        memo.alias("memo_text"))


def generate(spark: SparkSession, p: GenParams = GenParams()) -> dict[str, DataFrame]:
    """All five raw tables (lazy), column order = landing file header order."""
    m, c = merchants(spark, p), cards(spark, p)
    t = transactions(spark, p, m, c)
    return {
        "raw_merchant_master": m,
        "raw_card_master": c,
        "raw_transactions": t.drop("_n"),
        "raw_gateway_log": gateway_log(t, p),
        "dispute_memos": disputes(t, m, p),
    }


def write_landing_files(tables: dict[str, DataFrame], out_dir: str) -> None:
    """S15 for every table: ``<out_dir>/<table>/part-*.csv`` with a header."""
    from cardmart.schemas import RAW_SCHEMAS
    from cardmart.sources.csv_landing import write_csv
    for name, df in tables.items():
        write_csv(df, f"{out_dir.rstrip('/')}/{name}", [f.name for f in RAW_SCHEMAS[name].fields])


def facts(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Row count per table and the max load time of the transactions."""
    from cardmart.operators.quality import row_counts
    counts = row_counts(tables)
    wm = tables["raw_transactions"].agg(F.max("_loaded_at").alias("max_loaded_at"))
    return counts, wm
