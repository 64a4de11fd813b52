"""Vector pairs vs. brute force, lexicon frame vs. column functions, streaming replay,
plan shapes, and the driver contract."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmart.functions import text as TX
from cardmart.operators import vectors as V
from cardmart.operators.lexicon import classify_frame, hit_counts
from tests.conftest import SF_ORACLE, SF_SMOKE


def _brute(vecs, t):
    out = {}
    for (i, a), (j, b) in itertools.combinations(sorted(vecs.items()), 2):
        na, nb = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        if na == 0 or nb == 0:
            continue
        c = sum(x * y for x, y in zip(a, b)) / (na * nb)
        if c > t:
            out[(i, j)] = round(c, 3)
    return out


@pytest.mark.parametrize("pivots,chunk", [(1, 1024), (7, 16), (3, 5)])
def test_near_duplicate_pairs_exact(spark, pivots, chunk):
    rnd = random.Random(7)
    vecs = {i: [rnd.gauss(0, 1) for _ in range(8)] for i in range(120)}
    # a hot cluster: 40 near-copies of one vector (one cell holds a third of the rows)
    base = vecs[0]
    for i in range(120, 160):
        vecs[i] = [x + rnd.gauss(0, 0.01) for x in base]
    vecs[160] = [0.0] * 8  # zero vector: never paired
    df = spark.createDataFrame([(k, v) for k, v in vecs.items()], "id long, v array<double>")
    got = {(r.id_a, r.id_b): r.sim for r in
           V.near_duplicate_pairs(df, "id", "v", 0.5, n_pivots=pivots, chunk=chunk).collect()}
    want = _brute(vecs, 0.5)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.001 for k in want)


def test_top_k_and_embed(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])],
                               "id long, v array<double>")
    top = [r.id for r in V.top_k(df, "id", "v", [1.0, 0.1], 2).collect()]
    assert top == [1, 3]
    t = spark.createDataFrame([("the card was stolen",), ("the card was stolen",), ("zzz qqq",)],
                              "t string")
    rows = t.select(V.embed("t", dim=64).alias("e")).collect()
    assert len(rows[0].e) == 64 and rows[0].e == rows[1].e
    assert abs(sum(x * x for x in rows[0].e) - 1.0) < 1e-5
    sim = t.select(V.similarity(F.col("t"), F.lit("the card was stolen")).alias("s")).collect()
    assert abs(sim[0].s - 1.0) < 1e-6 and sim[2].s < 0.5


def test_lexicon_frame_equals_column_functions(spark):
    d = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    labels = [{"label": lang, "description": " ".join(TX.STOPWORDS[lang])} for lang in TX.LANGS]
    col = {r.doc_id: r.p for r in d.select(
        "doc_id", F.get(TX.classify("text", labels).getField("labels"), 0).alias("p")).collect()}
    frame = {r.doc_id: r.predicted for r in classify_frame(d, ["doc_id"], "text", labels).collect()}
    assert col == frame
    h = {r.doc_id: (r.pos, r.neg) for r in hit_counts(
        d, ["doc_id"], "text", {"pos": TX.POSITIVE, "neg": TX.NEGATIVE}).collect()}
    c = {r.doc_id: (r.p, r.n) for r in d.select(
        "doc_id", TX.lexicon_hits(TX.words("text"), TX.POSITIVE).alias("p"),
        TX.lexicon_hits(TX.words("text"), TX.NEGATIVE).alias("n")).collect()}
    assert h == c


def test_text_functions_small_cases(spark):
    df = spark.createDataFrame([("Two identical 12.50 USD charges, reason 12.6. Great!",),
                                ("nothing here",)], "t string")
    r = df.select(TX.token_count("t").alias("n"),
                  TX.top_answer("t", "What is the disputed amount?").alias("amt"),
                  TX.top_answer("t", "Why?").alias("why"),
                  TX.sentiment_label("t").alias("s"),
                  TX.truncate_tokens("t", 3).alias("tr"),
                  TX.prompt("Memo: {0}!", F.col("t")).alias("p")).collect()
    assert r[0].amt == "12.50" and r[0].why == "12.6" and r[1].amt is None
    assert r[0].s == "positive" and r[1].s == "neutral"
    assert r[0].tr == "Two identical 12" and r[0].p.startswith("Memo: Two")
    assert r[0].n == 15  # "12.50" is three tokens: 12 . 50


def test_ai_map_safe_failure(spark):
    from cardmart.functions.ai_map import BudgetExceeded, ai_map, keyword_triage_json
    df = spark.createDataFrame([(1, "card stolen fraud never"), (2, "   "), (3, "card stolen fraud never")],
                               "id int, t string")
    out = {r.id: r for r in ai_map(df, keyword_triage_json, "t", TX.TRIAGE_SCHEMA).collect()}
    assert out[1].ai_result.ok and out[1].ai_result.value.severity == "HIGH"
    assert out[2].ai_result.ok is False and "empty" in out[2].ai_result.error
    assert out[3].ai_result == out[1].ai_result
    with pytest.raises(BudgetExceeded):
        ai_map(df, keyword_triage_json, "t", TX.TRIAGE_SCHEMA, max_input_tokens=2)


def test_streaming_latest_replay_is_idempotent(spark, scratch):
    from cardmart.sources import driver_tables as DT
    from cardmart.streaming.ingest import current_state, maintain_latest
    gw = DT.raw_gateway_log(spark, SF_SMOKE)
    gw.repartitionByRange(4, "_loaded_at").write.parquet(f"{scratch}/src")
    for _ in range(2):  # second run: nothing new, state unchanged
        maintain_latest(spark, f"{scratch}/src", gw.schema, f"{scratch}/state", "transaction_id",
                        "gateway_timestamp", "gateway_log_id", name="t-replay",
                        max_files_per_trigger=1)
    state = current_state(spark, f"{scratch}/state")
    from cardmart.plans import models as M
    batch = M.int_fees(M.stg_gateway_log(gw)).select("transaction_id")
    assert state.count() == batch.count()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shapes(spark):
    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    d08 = QUERIES["d08_settlements"](spark, SF_ORACLE)
    p = _plan(d08)
    assert "WindowGroupLimit" in p
    l02 = QUERIES["l02_topk"](spark, SF_ORACLE)
    assert "TakeOrderedAndProject" in _plan(l02)
    u08 = QUERIES["u08_delta"](spark, SF_ORACLE)
    assert "PushedFilters: [IsNotNull(o_orderdate)" in _plan(u08) or "PushedFilters" in _plan(u08)
    for name in ("d10_fact", "t07_classify", "v04_topk", "q04_suite"):
        plan = _plan(QUERIES[name](spark, SF_ORACLE))
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
    t07 = _plan(QUERIES["t07_classify"](spark, SF_ORACLE))
    assert "BroadcastHashJoin" in t07 or "BroadcastExchange" in t07
    v04 = _plan(QUERIES["v04_topk"](spark, SF_ORACLE))
    assert "CartesianProduct" not in v04 and "BroadcastNestedLoopJoin" not in v04


def test_driver_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "transaction_id" in df.columns
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs) and len(oracle) >= 70


def test_mllib_classifier_after_an_observation(spark):
    """A session that has used an Observation cannot serialize a model that still holds
    its training summary; the classifier is saved and reloaded, so scoring works."""
    from pyspark.sql import Observation

    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    obs = Observation("warm")
    spark.range(3).observe(obs, F.count(F.lit(1)).alias("n")).collect()
    rows = {r.task: r for r in QUERIES["t08_mllib_toxic"](spark, SF_ORACLE).collect()}
    assert set(rows) == {"mllib_logreg", "lexicon_rule"}
    assert rows["mllib_logreg"].n == rows["lexicon_rule"].n > 0


def test_native_embedding_equals_the_column_and_takes_string_ids(spark):
    t = spark.createDataFrame([("D1", "the card was stolen"), ("D2", None), ("D3", "123 !"),
                               ("D4", "Card the STOLEN was"), ("D5", "weekly invoice for water")], "id string, t string")
    native = {r.id: r.vec for r in V.embed_frame(t, "id", "t", dim=64).collect()}
    column = {r.id: r.e for r in t.select("id", V.embed("t", dim=64).alias("e")).collect()}
    assert native == column and native["D2"] is None and set(native["D3"]) == {0.0}
    assert native["D1"] == V.embed_text("the card was stolen", 64)
    pairs = V.near_duplicate_pairs(V.embed_frame(t, "id", "t", dim=64), "id", "vec", 0.9).collect()
    assert [(p.id_a, p.id_b, p.sim) for p in pairs] == [("D1", "D4", 1.0)]


def test_benchmark_search_covers_every_item(spark):
    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    got = QUERIES["v04_benchmark_search_all"](spark, SF_SMOKE).collect()
    read = lambda name, key: {r[key]: np.array(V.embed_text(r["text"]), dtype=np.float64)
                              for r in spark.read.parquet(f"{SF_SMOKE}/{name}.parquet").collect()}
    docs, items = read("documents", "doc_id"), read("benchmark", "item_id")
    assert {r.item_id for r in got} == set(items) and len(got) == 10 * len(items)
    for i, q in items.items():
        sims = {d: q @ v / np.linalg.norm(q) / np.linalg.norm(v) for d, v in docs.items()}
        found = {r.doc_id: r.cosine_sim for r in got if r.item_id == i}
        assert all(abs(sims[d] - s) < 0.0006 for d, s in found.items())
        assert min(found.values()) >= max(s for d, s in sims.items() if d not in found) - 0.0006


def test_top_k_of_each_query_breaks_ties_by_id_and_puts_nulls_last(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(30)] + [(40, [0.0, 1.0]), (41, [0.0, 0.0]), (42, None)],
                                 "id long, v array<float>").repartition(4)
    queries = spark.createDataFrame([("x", [2.0, 0.0]), ("y", [0.0, 3.0]), ("none", None)], "q string, v array<float>")
    for block in (1, 1000):
        got = {}
        for r in V.top_k_each(rows, "id", "v", queries, "q", "v", 3, block=block).collect():
            got.setdefault(r.q, []).append((r.id, r.cosine_sim))
        assert {q: sorted(x) for q, x in got.items()} == {
            "x": [(0, 1.0), (1, 1.0), (2, 1.0)], "y": [(0, 0.0), (1, 0.0), (40, 1.0)], "none": [(0, None), (1, None), (2, None)]}
