"""Bit-plane clustering against plain integer k-means."""

import hashlib
import math

import numpy as np
import pytest

from cardmart.llm import bitplanes


def by_hand(rows, dim, k, rounds, scale=256, seed="2"):
    """rows: (id, components); returns {(id, vector): (cluster, distance)}, inertia by cluster, centroids."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    place = lambda r: hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=place)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        centroids = [[sum(x) // len(x) for x in zip(*own)] if (own := [v for (_, v), a in zip(kept, at) if a == c]) else centroids[c]
                     for c in range(len(centroids))]
    return [(i, nearest(v), far(v, centroids[nearest(v)])) for i, v in kept], centroids


def frame(spark, rows):
    data = [(i, v, "x", 1.5, "y") for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, cluster string, distance double, `a.b` string").repartition(3)


def check(spark, rows, dim, k, rounds):
    want, centroids = by_hand([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], dim, k, rounds)
    got = bitplanes.cluster_vectors(frame(spark, rows), dim=dim, k=k, rounds=rounds).collect()
    order = lambda rows: sorted(rows, key=repr)
    assert order((r["vec_id"], r["cluster"], r["distance"]) for r in got) == order(want)
    for r in got:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_products_and_distances_are_exact():
    rng = np.random.default_rng(5)
    for planes, dim in ((1, 64), (5, 64), (9, 70), (20, 3)):
        x = rng.integers(-2 ** (planes - 1), 2 ** (planes - 1), (50, dim))
        c = rng.integers(-2 ** (planes - 1), 2 ** (planes - 1), (7, dim))
        px, pc = bitplanes.pack(x, planes), bitplanes.pack(c, planes)
        assert (bitplanes.dots(px, pc) == x @ c.T).all() and (bitplanes.squares(px) == (x * x).sum(axis=1)).all()
        counts, sums = bitplanes.bit_sums(px, np.arange(50) % 5, 7, dim)
        assert counts.tolist() == [10] * 5 + [0, 0] and all((sums[i] == x[i::5].sum(axis=0)).all() for i in range(5))


def test_against_plain_k_means(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 0.2, 64).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(150)] + [(2000 + i, rows[7][1]) for i in range(200)]  # ties, a hot vector
    check(spark, rows, 64, 40, 5)


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    some = [(i, rng.integers(-3, 3, 70).astype(float).tolist()) for i in range(12)]
    odd = [(20, None), (21, []), (22, [1.0] * 69), (23, [1.0] * 71), (24, [1.0] * 69 + [None]), (25, [1.0] * 69 + [float("nan")]),
           (26, [float("inf")] + [1.0] * 69), (None, [0.5] * 70), (30, [0.25] * 70), (30, [0.25] * 70), (31, [0.0] * 70)]
    check(spark, some + odd, 70, 4, 3)
    check(spark, some[:3], 70, 40, 5)  # fewer vectors than centroids
    assert bitplanes.cluster_vectors(frame(spark, []), dim=70).collect() == []
    assert bitplanes.cluster_vectors(frame(spark, odd[:7]), dim=70).count() == 0
    with pytest.raises(ValueError):
        bitplanes.cluster_vectors(frame(spark, [(1, [1e30] * 70)]), dim=70)
