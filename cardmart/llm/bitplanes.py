"""Centroid clustering of integer vectors by bit-plane popcounts.

A component x becomes the integer floor(scale * x).  The integers are written in
two's complement on ``planes`` bits, and bit ``i`` of 64 components is packed into
one 64-bit word: the bit plane ``i``.  Plane ``i`` weighs 2**i, the top plane
-2**(planes - 1).  With X_i and C_j the planes of a vector and a centroid

    x . c = sum over i, j of weight_i * weight_j * popcount(X_i AND C_j)

so dot products and squared distances are exact integers, and the assignment never
leaves words and popcounts.  Sums of a cluster are weighted counts of set bits.
The planes are written once to the shared folder; each round reads them, sends at
most ``k`` rows of sums a task to one aggregate, and gathers ``k`` x ``dim`` sums on the
driver (its bound).  The number of planes follows from the least and the largest
integer of the table; centroids are floors of means and stay between them.

* Kept are vectors of exactly ``dim`` components, none null, NaN or infinite.  A null
  vector is not kept; a null id is, and hashes as an empty one.
* Start: the ``k`` kept vectors with the smallest SHA-256 of ``<seed>:<id>``; rows that
  share an id are ordered by their planes.  Fewer vectors than ``k``: as many centroids.
* Ties of distance go to the smaller number; an empty cluster keeps its centroid.
* Repeated rows count as often as they occur.  An empty table gives an empty result.
* Extra columns stay unread, whatever their names.
* Components so large that a squared distance might pass 63 bits raise ``ValueError``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardmart.llm.common import Scratch

DIM, K, ROUNDS, SCALE, SEED = 64, 40, 5, 256, "2"
WORD = 64
#: Vectors that are compared with all centroids at a time.
BLOCK = 1024


def weights(planes: int) -> np.ndarray:
    """Weight of each plane in two's complement."""
    w = np.int64(1) << np.arange(planes, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """[n, dim] integers as [n, planes, words] of 64 components a word."""
    n, dim = values.shape
    words = -(-dim // WORD)
    bits = np.zeros((n, planes, words * WORD), np.uint8)
    for i in range(planes):
        bits[:, i, :dim] = (values >> i) & 1
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64).reshape(n, planes, words)


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """[n, k] exact dot products of packed vectors and packed centroids."""
    w = weights(x.shape[1])
    out = np.zeros((len(x), len(c)), np.int64)
    for i in range(x.shape[1]):
        for j in range(c.shape[1]):
            for word in range(x.shape[2]):
                both = np.bitwise_count(x[:, i, word, None] & c[None, :, j, word])
                out += both * (w[i] * w[j])
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """[n] exact squared lengths of packed vectors."""
    w = weights(x.shape[1])
    out = np.zeros(len(x), np.int64)
    for i in range(x.shape[1]):
        for j in range(x.shape[1]):
            out += np.bitwise_count(x[:, i] & x[:, j]).sum(axis=1, dtype=np.int64) * (w[i] * w[j])
    return out


def bit_sums(x: np.ndarray, cluster: np.ndarray, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Count of members and sum of components of every cluster, from the planes."""
    counts = np.bincount(cluster, minlength=k)
    sums = np.zeros((k, dim), np.int64)
    order = np.argsort(cluster, kind="stable")
    found, starts = np.unique(cluster[order], return_index=True)
    bits = np.unpackbits(x[order].view(np.uint8), axis=2, bitorder="little")[:, :, :dim]
    if len(found):
        per_plane = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        sums[found] = np.tensordot(per_plane, weights(x.shape[1]), axes=(1, 0))
    return counts, sums


@dataclass
class Clustering:
    """Packed vectors in the shared folder and the centroids that were fitted to them."""

    packed: DataFrame
    scratch: Scratch
    planes: int
    dim: int
    centroids: np.ndarray

    def centroid_sha256(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in self.centroids]


def _kept(vectors: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    v = F.col("v")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    return rows.where((F.size(v) == dim) & ~odd)


def _packed(batches: Iterator[pa.RecordBatch], planes: int, dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = b["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        p = pack(np.floor(scale * x).astype(np.int64), planes).reshape(len(x), -1).view(np.int64)
        flat = pa.array(np.ascontiguousarray(p).ravel())
        offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * p.shape[1])
        yield pa.RecordBatch.from_arrays([b["vec_id"], pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "planes"])


def _blocks(batches: Iterator[pa.RecordBatch], planes: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        x = b["planes"].flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(b.num_rows, planes, -1)
        for at in range(0, len(x), BLOCK):
            yield b["vec_id"].slice(at, BLOCK), x[at:at + BLOCK]


def _nearest(x: np.ndarray, centroids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    far = squares(x)[:, None] + lengths[None, :] - 2 * dots(x, centroids)
    at = far.argmin(axis=1)  # the first of equal ones
    return at, far[np.arange(len(x)), at]


def fit(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, k: int = K,
        rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> Clustering:
    """``rounds`` rounds of assignment and floored means from the seeded start."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "bitplanes")
    kept = _kept(vectors, id_col, vec_col, dim)
    low, high = kept.agg(F.floor(F.min(F.array_min("v")) * scale).cast("double"),
                         F.floor(F.max(F.array_max("v")) * scale).cast("double")).first()
    if low is None:
        return Clustering(spark.createDataFrame([], "vec_id long, planes array<long>"), scratch, 1, dim,
                          np.empty((0, dim), np.int64))
    planes = max(int(high), -int(low) - 1, 0).bit_length() + 1
    if dim * 4 ** planes >= 2 ** 63:
        raise ValueError(f"components up to {max(high, -low):g} need {planes} planes; squared distances would not fit a long")
    packed = scratch.cut(kept.mapInArrow(lambda b: _packed(b, planes, dim, scale), "vec_id long, planes array<long>"), "packed")

    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    start = packed.orderBy(place, "planes").limit(k).collect()
    x = np.array([r["planes"] for r in start], np.int64).view(np.uint64).reshape(len(start), planes, -1)
    bits = np.unpackbits(x.view(np.uint8), axis=2, bitorder="little")[:, :, :dim].astype(np.int64)
    centroids = np.tensordot(bits, weights(planes), axes=(1, 0))
    fitted = Clustering(packed, scratch, planes, dim, centroids)
    for _ in range(rounds):
        fitted.centroids = _moved(fitted)
    return fitted


def _moved(fitted: Clustering) -> np.ndarray:
    """The centroids after one round."""
    planes, dim, k = fitted.planes, fitted.dim, len(fitted.centroids)
    c = pack(fitted.centroids, planes)
    lengths = squares(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, x in _blocks(batches, planes):
            n, s = bit_sums(x, _nearest(x, c, lengths)[0], k, dim)
            counts += n
            sums += s
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    parts = fitted.packed.mapInArrow(run, "cluster long, n long, sums array<long>")
    found = (parts.select("cluster", "n", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
             .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect())
    out = fitted.centroids.copy()
    for r in found:
        out[r["cluster"], r["at"]] = int(r["s"]) // r["n"]  # Python's division floors
    return out


def assign(fitted: Clustering) -> DataFrame:
    """vec_id, cluster, distance (squared) of every kept vector."""
    planes = fitted.planes
    if not len(fitted.centroids):
        return fitted.packed.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    c = pack(fitted.centroids, planes)
    lengths = squares(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, planes):
            at, far = _nearest(x, c, lengths)
            yield pa.RecordBatch.from_arrays([ids, pa.array(at.astype(np.int32)), pa.array(far)],
                                             names=["vec_id", "cluster", "distance"])

    return fitted.packed.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, **parameters) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    fitted = fit(vectors, **parameters)
    placed = fitted.scratch.cut(assign(fitted), "placed")
    fitted.scratch.drop("packed")
    far = F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")
    inertia = {r["cluster"]: r["far"] for r in placed.groupBy("cluster").agg(far.alias("far")).collect()}
    total, names = sum(inertia.values()), fitted.centroid_sha256()
    facts = vectors.sparkSession.createDataFrame(
        [(c, far, total, names[c]) for c, far in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(  # one row a centroid, k at most
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
