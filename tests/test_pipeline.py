"""Upsert / watermark / pipeline properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardmart.operators import upsert as U
from cardmart.plans.pipeline import Pipeline
from cardmart.operators.quality import parity
from cardmart.plans import models as M
from cardmart.schemas import TABLES
from cardmart.sources import driver_tables as DT
from cardmart.sources.snapshot import SnapshotTable
from tests.conftest import SF_SMOKE


def _tx(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, dw_inserted_at timestamp_ntz, "
                                       "dw_updated_at timestamp_ntz")


@pytest.mark.parametrize("strategy", ["shuffle", "auto"])
def test_merge_df_updates_inserts_keeps(spark, strategy):
    t0 = dt.datetime(2020, 1, 1)
    target = _tx(spark, [("a", 1, t0, t0), ("b", 2, t0, t0)])
    source = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    out = {r.k: r for r in U.merge_df(target, source, "k", strategy=strategy).collect()}
    assert len(out) == 3
    assert out["a"].v == 1 and out["a"]._merge_action == "keep"
    assert out["a"].dw_updated_at == t0
    assert out["b"].v == 20 and out["b"]._merge_action == "update"
    assert out["b"].dw_inserted_at == t0 and out["b"].dw_updated_at > t0   # U13
    assert out["c"].v == 30 and out["c"]._merge_action == "insert"
    assert out["c"].dw_inserted_at == out["c"].dw_updated_at


def test_merge_strategies_agree_on_real_tables(spark):
    stg = M.stg_transactions(DT.raw_transactions(spark, SF_SMOKE))
    src = (stg.filter(F.col("transaction_id").cast("long") % 3 == 0)
           .withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))
           .unionByName(stg.limit(0)))
    target = stg.filter(F.col("transaction_id").cast("long") % 2 == 0)
    a = U.merge_df(target, src, "transaction_id", inserted_at=None, updated_at=None,
                   strategy="auto")
    b = U.merge_df(target, src, "transaction_id", inserted_at=None, updated_at=None,
                   strategy="shuffle")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_duplicate_source_key_raises(spark):
    src = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(U.DuplicateKeyError):
        U.check_unique_keys(src, "k")


def test_watermark_strict_and_inclusive(spark):
    mark = dt.datetime(2024, 1, 2, 2, 0)
    raw = spark.createDataFrame([(1, mark), (2, mark + dt.timedelta(seconds=1))],
                                "id int, _loaded_at timestamp_ntz")
    assert [r.id for r in U.delta(raw, mark).collect()] == [2]
    assert sorted(r.id for r in U.delta(raw, mark, inclusive=True).collect()) == [1, 2]


def test_snapshot_versions(spark, scratch):
    t = SnapshotTable(spark, scratch, TABLES["int_fees"])
    assert t.current_version() is None and t.read().count() == 0
    assert t.create_if_absent() == 1
    v = t.write(spark.createDataFrame([("x", None, None, None)], TABLES["int_fees"].schema))
    assert v == 2 and t.read().count() == 1 and t.read(1).count() == 0
    assert t.truncate() == 3 and t.read().count() == 0


def test_pipeline_idempotent_and_parity(spark, scratch):
    raw = DT.raw_tables(spark, SF_SMOKE)
    p = Pipeline(spark, scratch, raw)
    first = {r.step: r for r in p.run()}
    assert all(r.state == "SUCCEEDED" for r in first.values()), first
    n_tx = raw["raw_transactions"].count()
    assert first["stg_transactions"].rows_merged == n_tx
    # A re-run with no new data merges 0 staging rows
    second = {r.step: r for r in p.run()}
    assert second["stg_transactions"].rows_merged == 0
    assert second["stg_gateway_log"].rows_merged == 0
    # trap #18: int / fact merges touch every row each run
    assert second["fact_payment_ledger"].rows_merged == first["fact_payment_ledger"].rows_merged
    # Q05: staging rows == raw rows
    assert p.tables["stg_transactions"].read().count() == n_tx
    # Upsert fact == rebuild fact after the scale-2 cast and dropping load times
    upsert_fact = p.tables["fact_payment_ledger"].read().drop("dw_load_timestamp")
    from cardmart.plans import models as M
    rebuilt = M.build_all(raw)["fact_payment_ledger"].withColumn(
        "net_amount", F.col("net_amount").cast("decimal(12,2)"))
    only_a, only_b = parity(upsert_fact, rebuilt)
    assert only_a.count() == 0 and only_b.count() == 0
    # Run history has both runs' steps
    assert p.run_history(minutes=60, limit=100).count() == 14
    counts = {r.tbl: r.rows for r in p.row_counts().collect()}
    assert counts["stg_transactions"] == n_tx


def test_duplicate_key_in_delta_fails_the_load(spark, scratch):
    raw = DT.raw_transactions(spark, SF_SMOKE).limit(5)
    dup = raw.unionByName(raw.limit(1))
    stg = SnapshotTable(spark, scratch, TABLES["stg_transactions"])
    wm = SnapshotTable(spark, scratch, TABLES["etl_watermark"])
    stg.create_if_absent()
    U.seed_watermarks(wm, ["raw_transactions"])
    with pytest.raises(U.DuplicateKeyError):
        U.load_incremental(dup, stg, wm, "raw_transactions", M.stg_transactions)
    # nothing merged, mark unchanged
    assert stg.read().count() == 0
    assert U.read_watermark(wm, "raw_transactions") == dt.datetime(1970, 1, 1)


def test_empty_delta_leaves_mark_unchanged(spark, scratch):
    raw = DT.raw_transactions(spark, SF_SMOKE)
    stg = SnapshotTable(spark, scratch, TABLES["stg_transactions"])
    wm = SnapshotTable(spark, scratch, TABLES["etl_watermark"])
    stg.create_if_absent()
    U.seed_watermarks(wm, ["raw_transactions"])
    first = U.load_incremental(raw, stg, wm, "raw_transactions", M.stg_transactions)
    again = U.load_incremental(raw, stg, wm, "raw_transactions", M.stg_transactions)
    assert first.inserted == raw.count() and again.merged == 0
    assert again.watermark_after == first.watermark_after


def test_small_delta_merge_does_not_shuffle_the_target(spark):
    stg = M.stg_transactions(DT.raw_transactions(spark, SF_SMOKE))
    src = stg.limit(10).withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))
    merged = U.merge_df(stg, src, "transaction_id", inserted_at=None, updated_at=None)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    assert "FullOuter" not in plan and "ResolvedHint" not in merged._jdf.queryExecution().analyzed().toString()
    big = U.merge_df(stg, src, "transaction_id", inserted_at=None, updated_at=None, strategy="shuffle")
    assert "FullOuter" in big._jdf.queryExecution().executedPlan().toString()


def test_stored_rebuild_keeps_four_decimals(spark, scratch):
    raw = DT.raw_tables(spark, SF_SMOKE)
    p = Pipeline(spark, scratch, raw)
    p.rebuild()
    stored, built = p.mart("fact_payment_ledger"), M.build_all(raw)["fact_payment_ledger"]
    assert stored.schema["net_amount"].dataType.scale == 4
    assert stored.where("net_amount <> round(net_amount, 2)").count() > 0
    assert all(x.count() == 0 for x in parity(stored.drop("dw_load_timestamp"), built))
    assert p.mart("stg_transactions").count() == raw["raw_transactions"].count()


def test_parity_differs_exactly_by_a_transaction_turning_unsettled(spark, scratch):
    raw = DT.raw_tables(spark, SF_SMOKE)
    p = Pipeline(spark, scratch, raw)
    p.run()
    fact1 = p.tables["fact_payment_ledger"].read()
    tid = fact1.orderBy("transaction_id").first().transaction_id
    gw = raw["raw_gateway_log"]
    last = gw.agg(F.max("_loaded_at"), F.max("gateway_timestamp")).first()
    extra = (gw.filter(F.col("transaction_id") == tid).limit(1)
             .withColumn("gateway_log_id", F.lit("zzzz-late-unsettled"))
             .withColumn("gateway_timestamp", F.lit(last[1]).cast("timestamp_ntz")
                         + F.expr("INTERVAL 1 DAY"))
             .withColumn("settlement_amount", F.lit(None).cast("decimal(12,2)"))
             .withColumn("_loaded_at", F.lit(last[0]).cast("timestamp_ntz")
                         + F.expr("INTERVAL 1 DAY")))
    raw2 = dict(raw, raw_gateway_log=gw.unionByName(extra))
    p2 = Pipeline(spark, scratch, raw2)
    steps = {r.step: r for r in p2.run()}
    assert steps["stg_gateway_log"].rows_merged == 1           # only the late event
    upserted = p2.tables["fact_payment_ledger"].read().drop("dw_load_timestamp")
    rebuilt = M.build_all(raw2)["fact_payment_ledger"].withColumn(
        "net_amount", F.col("net_amount").cast("decimal(12,2)"))
    only_upsert, only_rebuild = parity(upserted, rebuilt)
    assert [r.transaction_id for r in only_upsert.collect()] == [tid]
    assert only_rebuild.count() == 0
