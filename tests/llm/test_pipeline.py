"""The pipeline on a small table, stage by stage against brute force."""

import corpus_pipeline
from pyspark.sql import functions as F

from cardmart.llm.common import Scratch
from tests.llm.test_operators import check_packing, components_by_hand

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"kept": F.lit("x"), "epochs": F.lit(None).cast("int")})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = scratch.cut(stage(spark, docs, SF), name)
        if name == "packing":
            check_packing([r.asDict() for r in docs.collect()], before)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert after.items() <= before.items() and docs.count() == len(after)
        if name == "near_dedup":
            assert set(after) == {i for i, (_, c) in components_by_hand(before).items() if i == c}
        if name == "mixing":
            assert 0.7 * sum(len(t.split()) for t in before.values()) <= sum(len(t.split()) for t in after.values())


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_near_dedup_keeps_one_row_of_exact_copies(spark):
    words = [f"w{i}" for i in range(300)]
    close = [f"y{i}" if i in (100, 200) else w for i, w in enumerate(words)]
    other, lone = (" ".join(f"{p}{i}" for i in range(50)) for p in "pq")
    rows = [(1, " ".join(words)), (3, " ".join(close)), (4, other), (4, other), (4, other),
            (None, other), (None, lone), (None, lone), (None, " ".join(close)), (None, None), (None, None)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup_stage(spark, docs, SF).collect()), key=str)
    assert got == sorted([rows[0], rows[2], (None, lone), (None, None), (None, None)], key=str)


CLASHING = ("r_lang", "r_words", "r_classes", "r_common", "__cm_quality", "__cm_toxicity", "__cm_id", "__cm_dropped", "__cm_md5",
            "gone_id", "gone_text", "a.b", "a b`c", "extra_0", "kept", "score")


def test_odd_rows_and_clashing_columns_in_every_stage(spark, odd_rows):
    words = " ".join(f"some{i % 97} words" for i in range(90))
    rows = [(i, t, ("en", "ja", None)[k % 3], None if k % 4 == 0 else "src0", 5) for k, (i, t) in enumerate(odd_rows)]
    rows += [(100 + i, f"{words} {i}", "en", "src1", 7) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn("new", F.lit(f"{k}")).withColumnRenamed("new", name)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        if name == "packing":
            assert {r["doc_id"] for r in got} == {r[0] for r in rows}
            continue
        assert out.columns == docs.columns
        extra = {tuple(r)[5:] for r in got}
        assert extra <= {tuple(str(k) for k in range(len(CLASHING)))}
        assert {(r["doc_id"], r["text"]) for r in got} <= {r[:2] for r in rows}
        if name == "quality":
            assert all(len(r["text"].split()) >= 50 for r in got) and got
        if name == "near_dedup":
            left = {(r["doc_id"], r["text"]) for r in got}
            assert len(got) == len(set(map(tuple, got))) and (None, None) in left
            assert {i for i, t in left if t and t.startswith("some")} == {100}
