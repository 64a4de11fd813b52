"""CSV landing, validation report, header diff, generator."""

from __future__ import annotations

import gzip
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardmart.schemas import RAW_SCHEMAS, RAW_TRANSACTIONS
from cardmart.sources import csv_landing as L
from cardmart.sources import generate as G

HEADER = ",".join(f.name for f in RAW_TRANSACTIONS.fields)


def _write(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = ("\n".join(lines) + "\n").encode()
    if gz:
        with gzip.open(path, "wb") as fh:
            fh.write(data)
    else:
        with open(path, "wb") as fh:
            fh.write(data)


GOOD = [
    HEADER,
    'T1,C1,M1,PURCHASE,12.50,USD,2024-01-01 10:00:00,APPROVED,5411,CHIP,TRUE,2024-01-02 02:00:00',
    # quoted comma + doubled quote in a string, padded value, NULL token, empty field
    'T2,"C,2",M1,"RE""FUND", 7.25 ,USD,2024-01-01 10:00:00.123456,APPROVED,NULL,,FALSE,'
    '2024-01-02 02:10:00',
]


def test_load_handles_quotes_nulls_padding_and_gzip(spark, scratch):
    _write(f"{scratch}/in/a.csv", GOOD)
    _write(f"{scratch}/in/b.csv.gz", [HEADER, GOOD[1].replace("T1", "T3")], gz=True)
    rows = {r.transaction_id: r for r in L.load_csv(spark, f"{scratch}/in", RAW_TRANSACTIONS).collect()}
    assert set(rows) == {"T1", "T2", "T3"}
    assert rows["T2"].card_id == "C,2" and rows["T2"].transaction_type == 'RE"FUND'
    assert rows["T2"].amount == Decimal("7.25")
    assert rows["T2"].mcc_code is None and rows["T2"].entry_mode is None
    assert rows["T1"].is_international is True and rows["T2"].is_international is False
    assert rows["T2"].transaction_timestamp.microsecond == 123456


def test_quoted_line_break_needs_multi_line(spark, scratch):
    lines = [HEADER, 'T1,C1,M1,"PUR\nCHASE",1.00,USD,2024-01-01 10:00:00,APPROVED,5411,CHIP,TRUE,'
             '2024-01-02 02:00:00']
    _write(f"{scratch}/ml/a.csv", lines)
    with pytest.raises(Exception):
        L.load_csv(spark, f"{scratch}/ml", RAW_TRANSACTIONS).collect()
    row = L.load_csv(spark, f"{scratch}/ml", RAW_TRANSACTIONS, multi_line=True).first()
    assert row.transaction_type == "PUR\nCHASE"


def test_bad_date_aborts_load_and_is_reported(spark, scratch):
    bad = GOOD[:2] + ['T9,C1,M1,PURCHASE,1.00,USD,not-a-date,APPROVED,5411,CHIP,TRUE,'
                      '2024-01-02 02:00:00']
    _write(f"{scratch}/bad/a.csv", bad)
    with pytest.raises(Exception):
        L.load_csv(spark, f"{scratch}/bad", RAW_TRANSACTIONS).collect()
    rep = L.validation_report(spark, f"{scratch}/bad", RAW_TRANSACTIONS).collect()
    assert [(r.column_name, r.value) for r in rep] == [("transaction_timestamp", "not-a-date")]


def test_swapped_header_is_rejected_and_diffed(spark, scratch):
    cols = HEADER.split(",")
    cols[1], cols[2] = cols[2], cols[1]
    _write(f"{scratch}/swap/a.csv", [",".join(cols)] + GOOD[1:2])
    with pytest.raises(Exception):
        L.load_csv(spark, f"{scratch}/swap", RAW_TRANSACTIONS).collect()
    diff = {r.position: r.status for r in L.header_diff(spark, f"{scratch}/swap", RAW_TRANSACTIONS).collect()}
    assert diff[1] == "out_of_order" and diff[2] == "out_of_order" and diff[0] == "match"


def test_every_file_is_diffed_and_listed(spark, scratch):
    cols = HEADER.split(",")
    swapped = [cols[0], cols[2], cols[1], *cols[3:]]
    _write(f"{scratch}/many/a.csv", GOOD)
    _write(f"{scratch}/many/b.csv", [",".join(swapped)])
    diff = {(r.file_path[-5:], r.position): r.status
            for r in L.header_diff(spark, f"{scratch}/many", RAW_TRANSACTIONS).collect()}
    assert len(diff) == 2 * len(cols)
    assert diff["a.csv", 1] == diff["b.csv", 0] == "match"
    assert diff["b.csv", 1] == diff["b.csv", 2] == "out_of_order"
    _write(f"{scratch}/empty/a.csv", GOOD)
    _write(f"{scratch}/empty/b.csv", GOOD[:1])
    files = L.list_files(spark, f"{scratch}/empty", RAW_TRANSACTIONS).collect()
    assert [(f.file_path[-5:], f.rows) for f in files] == [("a.csv", 2), ("b.csv", 0)]


def test_listing_and_land(spark, scratch):
    _write(f"{scratch}/ls/a.csv", GOOD)
    files = L.list_files(spark, f"{scratch}/ls", RAW_TRANSACTIONS).collect()
    assert len(files) == 1 and files[0].rows == 2 and files[0].file_size > 0
    assert L.land(spark, f"{scratch}/ls", RAW_TRANSACTIONS, f"{scratch}/raw") == 2
    assert spark.read.parquet(f"{scratch}/raw").count() == 2


def test_generator_deterministic_and_shaped(spark, scratch):
    p = G.GenParams(rows=2000, merchants=20, cards=100, disputes=30)
    a = G.generate(spark, p)
    b = G.generate(spark, p)
    for name in a:
        assert a[name].exceptAll(b[name]).count() == 0
    t = a["raw_transactions"]
    assert t.count() == 2000
    gw = a["raw_gateway_log"]
    declined = t.filter("auth_status = 'DECLINED'").count()
    retries = gw.count() - 2000
    assert 0 <= retries <= declined
    assert gw.select("gateway_log_id").distinct().count() == gw.count()
    d = a["dispute_memos"].collect()
    assert len(d) == 30 and all("{" not in r.memo_text for r in d)
    counts, wm = G.facts(a)
    assert {r.tbl: r.row_count for r in counts.collect()}["raw_transactions"] == 2000
    assert wm.first().max_loaded_at is not None


def test_generated_files_round_trip_through_pipeline(spark, scratch):
    from cardmart.plans.pipeline import Pipeline
    p = G.GenParams(rows=500, merchants=10, cards=50, disputes=10)
    G.write_landing_files(G.generate(spark, p), f"{scratch}/landing")
    raw = {n: L.load_csv(spark, f"{scratch}/landing/{n}", RAW_SCHEMAS[n]) for n in RAW_SCHEMAS}
    assert raw["raw_transactions"].count() == 500
    results = {r.step: r for r in Pipeline(spark, f"{scratch}/wh", raw).run()}
    assert all(r.state == "SUCCEEDED" for r in results.values()), results
    assert results["fact_payment_ledger"].rows_merged > 0


def test_generator_distributions_and_fk_integrity(spark):
    from cardmart.operators.joins import orphans
    p = G.GenParams(rows=20000, merchants=60, cards=800, disputes=200)
    t = G.generate(spark, p)
    tx = t["raw_transactions"]
    stats = tx.groupBy().agg(
        *[(F.avg((F.col("transaction_type") == k).cast("double"))).alias(k)
          for k in ("PURCHASE", "REFUND", "REVERSAL", "TRANSFER")],
        F.avg((F.col("auth_status") == "APPROVED").cast("double")).alias("approved"),
        F.avg((F.col("amount") >= 500).cast("double")).alias("large")).first()
    assert abs(stats.PURCHASE - 0.80) < 0.015 and abs(stats.REFUND - 0.08) < 0.01
    assert abs(stats.REVERSAL - 0.07) < 0.01 and abs(stats.TRANSFER - 0.05) < 0.01
    assert abs(stats.approved - 0.88) < 0.015 and abs(stats.large - 0.08) < 0.015
    declined = tx.filter("auth_status = 'DECLINED'").count()
    retries = t["raw_gateway_log"].count() - 20000
    assert abs(retries / declined - 0.15) < 0.03
    assert orphans(tx, "card_id", t["raw_card_master"], "card_id").count() == 0
    assert orphans(tx, "merchant_id", t["raw_merchant_master"], "merchant_id").count() == 0
    d = t["dispute_memos"]
    eligible = tx.filter("auth_status = 'APPROVED' AND transaction_type = 'PURCHASE'")
    assert orphans(d, "transaction_id", eligible, "transaction_id").count() == 0
    assert d.select("transaction_id").distinct().count() == 200


def test_csv_round_trip_is_exact(spark, scratch):
    p = G.GenParams(rows=1000, merchants=10, cards=50, disputes=20)
    tables = G.generate(spark, p)
    G.write_landing_files(tables, f"{scratch}/rt")
    for name, schema in RAW_SCHEMAS.items():
        back = L.load_csv(spark, f"{scratch}/rt/{name}", schema)
        orig = tables[name].select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0, name
