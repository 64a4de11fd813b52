"""Near-duplicate vectors: bands against the exact join, counts, hot buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardmart.operators import bands, vectors


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows],
                                 "vec_id long, embedding array<double>").repartition(4)


def clustered(rng, n, dim=32, centre=3.0):
    """Unit vectors around a common direction, half of them close to another one."""
    base = rng.normal(0, 1, (n // 2, dim)) + centre * rng.normal(0, 1, dim) / 3
    near = base + rng.normal(0, 1, base.shape) * rng.choice([0.02, 0.1, 0.2], (len(base), 1))
    return np.vstack([base, near])


def exact_pairs(x, t):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(u @ u.T > t, 1))
    return set(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("threshold", [0.9, 0.95, 0.99])
def test_recall_with_split_buckets(spark, threshold):
    rng = np.random.default_rng(11)
    x = clustered(rng, 2400)
    want = exact_pairs(x, threshold)
    found = bands.linked_classes(vectors_frame(spark, list(enumerate(x))), "vec_id", "embedding", threshold, chunk=64)
    got = {(r["a"], r["b"]) for r in found.links.collect()}
    assert found.tables > 1 and got <= want
    assert len(got) >= 0.97 * len(want), (len(got), len(want), found.tables)


def test_candidates_grow_with_the_rows(spark):
    rng = np.random.default_rng(12)
    made = []
    for n in (1000, 4000):
        found = bands.linked_classes(vectors_frame(spark, list(enumerate(clustered(rng, n)))), "vec_id", "embedding", 0.95,
                                     chunk=64, tables=12)
        made.append(found.candidates)
    assert made[1] < 8 * made[0]  # all pairs would be 16 times as many


def test_copies_hot_buckets_and_odd_vectors(spark):
    rng = np.random.default_rng(13)
    one = rng.normal(0, 1, 16)
    rows = [(i, one + rng.normal(0, 1e-5, 16)) for i in range(300)]  # share every sign: compared in blocks
    rows += [(1000 + i, one) for i in range(200)] + [(2000, None), (2001, np.zeros(16)), (2002, -one), (2003, 2 * one)]
    rows += [(3000 + i, rng.normal(0, 1, 16)) for i in range(100)]
    df = vectors_frame(spark, rows)
    got = {(r["vec_id_a"], r["vec_id_b"]) for r in bands.banded_pairs(df, "vec_id", "embedding", 0.999, chunk=50).collect()}
    kept = [(i, v) for i, v in rows if v is not None and np.any(v)]
    ids = [i for i, _ in kept]
    want = {(ids[a], ids[b]) for a, b in exact_pairs(np.array([v for _, v in kept]), 0.999)}
    assert got == want
    classes = {r["vec_id"]: r for r in bands.duplicate_classes(df, "vec_id", "embedding", 0.999, chunk=50).collect()}
    assert len(classes) == len(kept) and classes[1100]["class_id"] == 1000 and classes[1100]["copies"] == 200
    assert classes[1100]["links"] == 301  # the near ones and the scaled one, each once
    assert bands.banded_pairs(vectors_frame(spark, []), "vec_id", "embedding", 0.9).count() == 0


def test_pairs_can_be_counted(spark):
    x = clustered(np.random.default_rng(14), 300)
    df = vectors_frame(spark, list(enumerate(x)))
    want = exact_pairs(x, 0.9)
    for pairs in (vectors.near_duplicate_pairs(df, "vec_id", "embedding", 0.9), bands.banded_pairs(df, "vec_id", "embedding", 0.9)):
        assert pairs.count() == len(want)
        assert pairs.select("vec_id_a").count() == len(want)
        assert pairs.agg(F.countDistinct("vec_id_b")).first()[0] == len({b for _, b in want})
