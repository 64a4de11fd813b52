"""Bucketed tables, the load procedures and the streams: what is written, and what is not."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardmart.plans.loads import LOADS, Ledger
from cardmart.plans.queries_streaming import LATEST
from cardmart.schemas import TABLES
from cardmart.sources import driver_tables as DT
from cardmart.sources.bucketed import BUCKET, BucketTable, DuplicateKeyError
from cardmart.streaming.ingest import maintain_latest

SF = "/root/testdata/sf0.001"
FEES = "transaction_id string, interchange_fee decimal(12,4), scheme_fee decimal(12,4)"


def files(table):
    return {os.path.join(d, f) for d, _, names in os.walk(table.path) for f in names if f.endswith(".parquet")}


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, scratch):
    table = BucketTable(spark, f"{scratch}/fees", TABLES["int_fees"], buckets=16)
    table.create_if_absent()
    assert table.read().count() == 0
    rows = spark.createDataFrame([(str(i), Decimal(i), Decimal(1)) for i in range(400)], FEES)
    done = table.upsert(rows, at("2024-01-01"))
    assert (done.inserted, done.updated, len(done.buckets)) == (400, 0, 16)
    before = files(table)
    done = table.upsert(spark.createDataFrame([("7", Decimal(70), Decimal(1)), ("new", Decimal(5), Decimal(5))], FEES), at("2024-01-02"))
    assert (done.inserted, done.updated) == (1, 1) and 1 <= len(done.buckets) <= 2
    kept = before & files(table)
    touched = {f for f in before if any(f"{BUCKET}={b}/" in f for b in done.buckets)}
    assert kept == before - touched and files(table) != before
    got = {r["transaction_id"]: r for r in table.read().collect()}
    assert len(got) == 401 and got["7"]["interchange_fee"] == 70 and got["8"]["interchange_fee"] == 8
    assert got["7"]["dw_updated_at"] == dt.datetime(2024, 1, 2) and got["8"]["dw_updated_at"] == dt.datetime(2024, 1, 1)
    with pytest.raises(DuplicateKeyError):
        table.upsert(spark.createDataFrame([("7", Decimal(1), Decimal(1))] * 2, FEES))
    before = files(table)
    assert table.upsert(rows.limit(0)).rows == 0 and table.upsert_changes(table.read().drop("dw_updated_at")).rows == 0
    assert files(table) == before  # nothing to merge: nothing written
    table.truncate()
    assert table.read().count() == 0


def test_second_load_writes_nothing_and_rewound_marks_merge_again(spark, scratch):
    ledger = Ledger(spark, scratch, buckets=4)
    raw = DT.raw_tables(spark, SF)
    first = {m.table: m for m in ledger.run(raw, at("2024-01-01"))}
    assert set(first) == set(LOADS) and all(m.inserted and not m.updated for m in first.values())
    before = {n: files(t) for n, t in ledger.tables.items()}
    again = ledger.run(raw, at("2024-01-02"))
    assert all(m.rows == 0 and m.buckets == () for m in again)
    assert before == {n: files(t) for n, t in ledger.tables.items()}
    assert ledger.control.seed().rows == 0
    assert ledger.control.mark("raw_transactions") == raw["raw_transactions"].agg(F.max("_loaded_at")).first()[0]
    assert again[0].status(ledger.control.mark("raw_transactions")).startswith("stg_transactions: merged 0 row(s), watermark was ")
    ledger.control.reset()
    done = ledger.load("stg_transactions", raw, at("2024-01-03"))
    assert (done.inserted, done.updated) == (0, raw["raw_transactions"].count())
    one = ledger.tables["stg_transactions"].read().select("dw_inserted_at", "dw_updated_at").distinct().collect()
    assert [tuple(r) for r in one] == [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))]


def test_a_settlement_that_is_withdrawn_stays(spark, scratch):
    ledger = Ledger(spark, scratch, buckets=2)
    raw = DT.raw_tables(spark, SF)
    gw = raw["raw_gateway_log"].where("transaction_id in ('1', '2', '3', '4', '5')")
    raw = raw | {"raw_gateway_log": gw}
    ledger.run(raw, upto="int_settlements")
    settled = {r["transaction_id"]: r["settlement_amount"] for r in ledger.tables["int_settlements"].read().collect()}
    some = min(settled)
    late = (gw.where(F.col("transaction_id") == some).limit(1)
            .withColumns({"gateway_log_id": F.lit("z"), "settlement_amount": F.lit(None).cast("decimal(12,2)"),
                          "gateway_timestamp": at("2050-01-01"), "_loaded_at": at("2050-01-02")}))
    done = ledger.run(raw | {"raw_gateway_log": gw.unionByName(late)}, upto="int_settlements")
    assert [m.rows for m in done] == [1, 0]
    assert {r["transaction_id"]: r["settlement_amount"] for r in ledger.tables["int_settlements"].read().collect()} == settled


def test_latest_event_survives_a_restart(spark, scratch):
    gw = DT.raw_gateway_log(spark, SF).select("transaction_id", "gateway_log_id", "settlement_amount", "gateway_timestamp")
    schema, landing = gw.schema, f"{scratch}/landing"
    table = BucketTable(spark, f"{scratch}/latest", LATEST, buckets=4)

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def drain():
        maintain_latest(spark, landing, schema, table, "transaction_id", "gateway_timestamp", "gateway_log_id", name=f"t{os.path.basename(scratch)}")
        return {r["transaction_id"]: r["gateway_log_id"] for r in table.read().collect()}

    day = lambda n: dt.datetime(2024, 1, n)
    land([("a", "1", Decimal(1), day(5)), ("a", "2", Decimal(2), day(3)), ("b", "3", None, day(1)), ("c", "4", Decimal(1), day(2))])
    assert drain() == {"a": "1", "b": "3", "c": "4"}
    before = files(table)
    assert drain() == {"a": "1", "b": "3", "c": "4"} and files(table) == before  # nothing new landed
    # The engine's state knows the event of the run before: an older one does not replace it, a tie goes to the larger id.
    land([("a", "5", Decimal(5), day(4)), ("b", "6", Decimal(6), day(1)), ("c", "7", Decimal(7), None), ("d", "8", None, None)])
    land([("c", "9", Decimal(9), day(30)), ("b", "10", Decimal(6), day(1))])
    assert drain() == {"a": "1", "b": "6", "c": "7", "d": "8"}


def test_a_merge_shuffles_each_side_once(spark, scratch):
    table = BucketTable(spark, f"{scratch}/once", TABLES["int_fees"], buckets=4)
    table.create_if_absent()
    table.upsert(spark.createDataFrame([(str(i), Decimal(i), Decimal(1)) for i in range(50)], FEES), at("2024-01-01"))
    delta = spark.createDataFrame([("3", Decimal(30), Decimal(1)), ("new", Decimal(5), Decimal(5))], FEES)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = table._merged(table._stored(), delta.withColumn(BUCKET, table._bucket()), at("2024-01-02"), False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_null_keys_and_repeated_keys_in_a_merge(spark, scratch):
    table = BucketTable(spark, f"{scratch}/odd", TABLES["int_fees"], buckets=4)
    table.create_if_absent()
    one = lambda key, fee: (key, Decimal(fee), Decimal(1))
    frame = lambda rows: spark.createDataFrame(rows, FEES)
    with pytest.raises(DuplicateKeyError):
        table.upsert(frame([one("a", 1), one("a", 2)]), at("2024-01-01"))
    assert table.read().count() == 0
    table.upsert(frame([one("a", 1), one(None, 1)]), at("2024-01-01"))
    done = table.upsert(frame([one("a", 2), one(None, 2)]), at("2024-01-02"))  # a null key matches nothing
    assert (done.inserted, done.updated) == (1, 1)
    with pytest.raises(DuplicateKeyError):
        table.upsert(frame([one(None, 3), one(None, 4)]), at("2024-01-03"))
    got = sorted((r["transaction_id"] or "", int(r["interchange_fee"]), r["dw_updated_at"].day) for r in table.read().collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 2, 2)]


STG = "transaction_id string, amount decimal(12,2), source_loaded_at timestamp_ntz"


def test_only_rows_loaded_on_days_of_a_repeated_key_are_shuffled_wide(spark, scratch, monkeypatch):
    table = BucketTable(spark, f"{scratch}/days", TABLES["stg_transactions"], buckets=4)
    table.create_if_absent()
    day = lambda n: None if n is None else dt.datetime(2023, 1, 1, 2) + dt.timedelta(days=n)
    frame = lambda rows: spark.createDataFrame([(k, Decimal(a), day(d)) for k, a, d in rows], STG)
    met = []
    merged = BucketTable._merged
    monkeypatch.setattr(BucketTable, "_merged", lambda self, held, delta, now, unique: (
        met.append((0 if held is None else held.count(), delta.count())), merged(self, held, delta, now, unique))[1])
    done = table.upsert(frame([(str(i), i, i) for i in range(100)] + [("odd", 1, None), (None, 1, 3)]), at("2024-01-01"))
    assert (done.inserted, done.updated) == (102, 0)
    # "5" comes again, "new" and later days do not; rows without a day or a key may always meet.
    done = table.upsert(frame([(str(i), i, i) for i in range(100, 200)] + [("5", 50, 150), ("odd", 2, 160), ("late", 3, None), (None, 2, 170)]), at("2024-01-02"))
    assert (done.inserted, done.updated) == (102, 2)
    assert met[0] == (0, 2) and met[1][0] <= 3 and 4 <= met[1][1] <= 16
    rows = [tuple(r) for r in table.read().select("transaction_id", F.col("amount").cast("int"), F.dayofmonth("dw_inserted_at"), F.dayofmonth("dw_updated_at")).collect()]
    assert sorted(rows, key=str) == sorted(
        [(str(i), i, *((1, 1) if i < 100 else (2, 2))) for i in range(200) if i != 5]
        + [("5", 50, 1, 2), ("odd", 2, 1, 2), ("late", 3, 2, 2), (None, 1, 1, 1), (None, 2, 2, 2)], key=str)
    before = files(table)
    for twice in ([("x", 1, 300), ("x", 2, 500)], [(None, 1, 300), (None, 2, 500)], [("x", 1, None), ("x", 2, 500)]):
        with pytest.raises(DuplicateKeyError):
            table.upsert(frame([*twice, ("y", 1, 400)]), at("2024-01-03"))
    assert files(table) == before


def test_changes_are_merged_without_a_window(spark, scratch, monkeypatch):
    table = BucketTable(spark, f"{scratch}/changes", TABLES["int_fees"], buckets=4)
    table.create_if_absent()
    frame = lambda rows: spark.createDataFrame([(k, Decimal(f), Decimal(1)) for k, f in rows], FEES)
    monkeypatch.setattr(BucketTable, "_merged", None)  # compared rows need no second merge
    assert table.upsert_changes(frame([("a", 1), ("b", 1), (None, 1)]), at("2024-01-01")).inserted == 3
    done = table.upsert_changes(frame([("a", 2), ("c", 1), (None, 2)]), at("2024-01-02"))  # b stays, a null key matches nothing
    assert (done.inserted, done.updated) == (2, 1)
    got = sorted((r[0] or "", int(r[1]), r[3].day) for r in table.read().collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 2, 2), ("b", 1, 1), ("c", 1, 2)]
    before = files(table)
    assert table.upsert_changes(frame([("a", 2), ("b", 1), ("c", 1)])).rows == 0 and files(table) == before


def test_settlements_and_fees_of_the_fact_share_one_ranking(spark, scratch, monkeypatch):
    from cardmart.plans import loads, models

    n, ranked = [], models.latest_gateway_event
    for module in (loads, models):
        monkeypatch.setattr(module, "latest_gateway_event", lambda *a, **k: (n.append(1), ranked(*a, **k))[1], raising=False)
    ledger = Ledger(spark, scratch, buckets=2)
    raw = DT.raw_tables(spark, SF)
    assert all(m.inserted for m in ledger.run(raw, at("2024-01-01"))) and len(n) == 1
    for name, rows in (("int_settlements", models.int_settlements(DT.raw_gateway_log(spark, SF))),
                       ("int_fees", models.int_fees(DT.raw_gateway_log(spark, SF), settled_only=True))):
        stored = ledger.tables[name].read().drop("dw_updated_at")
        assert stored.count() == rows.count() and not stored.exceptAll(rows).count()
