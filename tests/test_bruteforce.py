"""Rows-only queries checked against plain-Python brute force on the sf0.001 tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np

from cardmart.operators import text_agg as TA
from cardmart.operators import vectors as V
from cardmart.sources import driver_tables as DT
from tests.conftest import SF_SMOKE

SPLIT = re.compile(r"(?<=[.!?])[ \t\n\x0b\f\r]+")
WORD = re.compile(r"[a-z]+")


def _memos(spark):
    return DT.dispute_memos(spark, SF_SMOKE).select("dispute_id", "dispute_category",
                                                    "merchant_id", "memo_text")


def _idf(texts: dict) -> dict:
    df = Counter()
    for t in texts.values():
        df.update(set(WORD.findall(t.lower())))
    n = len(texts)
    return {w: math.log(n / c) for w, c in df.items()}


def _sentences(text):
    return [(i, s) for i, s in enumerate(SPLIT.split(text)) if s.strip(" ")]


def _score(sentence, idf):
    ws = WORD.findall(sentence.lower())
    return round(sum(idf[w] for w in ws) / len(ws), 9) if ws else 0.0


def test_summary_matches_brute_force(spark):
    rows = _memos(spark).collect()
    texts = {r.dispute_id: r.memo_text for r in rows}
    idf = _idf(texts)
    want = {}
    for k, t in texts.items():
        sc = [(-_score(s, idf), i, s) for i, s in _sentences(t)]
        top = sorted(sc)[:2]
        want[k] = " ".join(s for _, i, s in sorted(top, key=lambda x: x[1])) if top else None
    got = {r.dispute_id: r.summary for r in
           TA.summarize(_memos(spark), "dispute_id", "memo_text", 2).collect()}
    assert got == want


def test_group_summary_matches_brute_force(spark):
    rows = _memos(spark).collect()
    texts = {r.dispute_id: r.memo_text for r in rows}
    idf = _idf(texts)
    groups = defaultdict(list)
    for r in rows:
        for i, s in _sentences(r.memo_text):
            groups[r.dispute_category].append((-_score(s, idf), r.dispute_id, i, s))
    want = {g: " ".join(x[3] for x in sorted(v)[:3]) for g, v in groups.items()}
    got = {r.dispute_category: r.category_summary for r in TA.summarize_groups(
        _memos(spark), "dispute_category", "dispute_id", "memo_text", 3).collect()}
    assert got == want
    counts = Counter(r.dispute_category for r in rows)
    assert {r.dispute_category: r.n for r in TA.summarize_groups(
        _memos(spark), "dispute_category", "dispute_id", "memo_text", 3).collect()} == counts


def test_group_insight_counts_category_and_terms(spark):
    from cardmart.functions.text import STOPWORDS
    stop = {w for ws in STOPWORDS.values() for w in ws}
    rows = _memos(spark).collect()
    by_group = defaultdict(list)
    for r in rows:
        by_group[r.merchant_id].append(r)
    out = {r.merchant_id: r for r in TA.group_insight(
        _memos(spark), "merchant_id", "memo_text", "dispute_category", "dispute_id",
        min_rows=1, top=10_000).collect()}
    assert set(out) == set(by_group)
    for g, rs in by_group.items():
        assert out[g].dispute_count == len(rs)
        tf = Counter(w for r in rs for w in WORD.findall(r.memo_text.lower())
                     if len(w) >= 3 and w not in stop)
        terms = [w for w, _ in sorted(tf.items(), key=lambda x: (-x[1], x[0]))[:3]]
        assert f"recurring terms: {', '.join(terms) if terms else '-'}." in \
            out[g].merchant_dispute_insight
        cats = Counter(r.dispute_category for r in rs)
        top_cat = sorted(cats.items(), key=lambda x: (-x[1], x[0]))[0][0]
        assert f"most common problem: {top_cat};" in out[g].merchant_dispute_insight


def test_document_near_duplicates_match_brute_force(spark):
    d = DT.read(spark, SF_SMOKE, "documents")
    vec = d.select("doc_id", V.embed("text").alias("vec"))
    rows = vec.collect()
    ids = np.array([r.doc_id for r in rows])
    x = np.array([r.vec for r in rows], dtype=np.float64)
    n = np.linalg.norm(x, axis=1)
    keep = n > 0
    ids, x, n = ids[keep], x[keep], n[keep]
    sims = (x @ x.T) / np.outer(n, n)
    want = {(int(ids[i]), int(ids[j])) if ids[i] < ids[j] else (int(ids[j]), int(ids[i]))
            for i, j in zip(*np.nonzero(np.triu(sims > 0.95, k=1)))}
    got = {(r.doc_id_a, r.doc_id_b) for r in
           V.near_duplicate_pairs(vec, "doc_id", "vec", 0.95, n_pivots=4, chunk=32).collect()}
    assert got == want and len(want) > 0


def test_similarity_search_matches_brute_force(spark):
    d = _memos(spark)
    from cardmart.plans.queries_vectors import PHRASE as q
    emb = d.select("dispute_id", V.embed("memo_text").alias("e"),
                   V.embed(V.F.lit(q)).alias("qe")).collect()

    def cos(a, b):
        a, b = np.array(a, dtype=np.float64), np.array(b, dtype=np.float64)
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        return None if na == 0 or nb == 0 else float(a @ b / (na * nb))

    scored = [(r.dispute_id, cos(r.e, r.qe)) for r in emb]
    want = [k for k, s in sorted(((k, round(s, 3)) for k, s in scored if s is not None),
                                 key=lambda x: (-x[1], x[0]))[:10]]
    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    got = [r.dispute_id for r in QUERIES["v03_similarity"](spark, SF_SMOKE).collect()]
    assert got == want


def test_nearest_centroid_matches_numpy(spark):
    from cardmart.operators.classify_ml import centroids, nearest_centroid
    e = DT.read(spark, SF_SMOKE, "embeddings")
    rows = e.collect()
    cents = centroids(e, "label", "embedding")
    by = defaultdict(list)
    for r in rows:
        by[r.label].append(np.array(r.embedding, dtype=np.float64))
    for lab, vs in by.items():
        assert np.allclose(np.mean(vs, axis=0), cents[lab], atol=1e-9)
    labels = sorted(cents)
    cm = np.array([cents[lab] for lab in labels])
    got = {r.vec_id: r.p for r in e.select(
        "vec_id", nearest_centroid("embedding", cents).alias("p")).collect()}
    for r in rows:
        x = np.array(r.embedding, dtype=np.float64)
        sims = cm @ x / (np.linalg.norm(cm, axis=1) * np.linalg.norm(x))
        assert got[r.vec_id] == labels[int(np.argmax(sims))]
