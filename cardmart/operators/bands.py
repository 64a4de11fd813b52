"""Near-duplicate vectors by sign projections (V06, J07) for high thresholds.

1. Rows with equal vectors are one class, named by its smallest id.  From here on a class is
   one row, however many copies it has.
2. Vectors are scaled to length 1 and the mean of all is taken off.  A cosine above t means a
   distance below r = sqrt(2 - 2t), which the shift leaves as it is, while unrelated vectors
   are about at right angles afterwards.  In each of ``tables`` tables a vector gets
   ``DEPTH`` sign bits, one for each seeded random hyperplane.
3. Within a table, vectors that share their first bits are a bucket.  A bucket with more than
   ``chunk`` members is split by its next bits, as in an LSH forest, until it is small
   enough; so no more than ``chunk`` rows meet, and candidates grow in proportion to
   the rows.  What shares all bits is compared in blocks of ``chunk``, so nothing is cut off.
4. Inside a bucket pairs must pass a bound on the bits in which their sketches differ (five
   deviations above the mean at distance r), then the exact cosine of V02 on the vectors.

Recall: a pair at distance r shares a bit with probability p = 1 - asin(r / s) / pi, where s is the
usual length of a shifted vector, so it meets with probability 1 - (1 - p**depth)**tables.
``tables`` is chosen from the number of classes for a miss of at most ``miss`` at the threshold;
closer pairs are found more surely.  Up to ``chunk`` classes are one bucket: exact.

NULL vectors and zero vectors have no cosine and are in no pair.  Ids must be unique.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardmart.operators.vectors import cosine, norm
from cardmart.session import checkpoint_root

DEPTH, SKETCH = 60, 4
STEP = 3


@dataclass
class Classes:
    """``reps`` (rep, v, keys, sketch, length), ``members`` (id, rep), and links of classes (a, b, s)."""

    reps: DataFrame
    members: DataFrame
    links: DataFrame
    tables: int
    candidates: int


def _planes(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng(20_240_501).standard_normal((dim, n))


def _tables(n: int, chunk: int, r: float, size: float, miss: float) -> tuple[int, int]:
    """First depth at which even buckets would be small enough, and the number of tables."""
    depth = max(0, math.ceil(math.log2(max(n, 1) / chunk)))
    if depth == 0:
        return 0, 1
    p = 1 - math.asin(min(1.0, r / max(size, 1e-9))) / math.pi
    # Real buckets are uneven, so some go two bits deeper.
    return depth, math.ceil(math.log(miss) / math.log(1 - p ** (depth + 2)))


def linked_classes(df: DataFrame, id_col: str, vec_col: str, threshold: float, miss: float = 1e-3, chunk: int = 1024,
                   tables: int | None = None) -> Classes:
    """Classes of equal vectors and the links between them above ``threshold``."""
    spark = df.sparkSession
    root = f"{checkpoint_root(spark).rstrip('/')}/bands-{uuid.uuid4().hex}"

    def cut(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    base = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (norm("v") > 0))
    same = [F.xxhash64("v").alias("h1"), F.hash("v", F.lit(7)).alias("h2")]
    ids = cut(base.select("id", *same), "ids")
    firsts = ids.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = cut(ids.join(firsts, ["h1", "h2"]).select("id", "rep"), "members")
    unique = cut(base.join(firsts.select(F.col("rep").alias("id")), "id", "left_semi")
                 .select(F.col("id").alias("rep"), "v"), "unique")

    n = unique.count()
    if n == 0:
        none = spark.createDataFrame([], f"a {members.schema['rep'].dataType.simpleString()}, "
                                         f"b {members.schema['rep'].dataType.simpleString()}, s double")
        return Classes(unique, members, none, 0, 0)
    unit = F.transform("v", lambda x: x / norm("v"))
    sums = unique.select(F.posexplode(unit)).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()
    mean = np.array([x["s"] for x in sums]) / n  # as many numbers as a vector has
    r = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    start, wanted = _tables(n, chunk, r, math.sqrt(max(1e-9, 1.0 - float(mean @ mean))), miss)
    tables = tables or wanted
    planes = _planes(len(mean), tables * DEPTH + SKETCH * 64)
    id_type = unique.schema["rep"].dataType.simpleString()

    def signs(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
            x = x / np.linalg.norm(x, axis=1, keepdims=True) - mean
            bits = x @ planes > 0
            powers = np.int64(1) << np.arange(DEPTH - 1, -1, -1, dtype=np.int64)
            keys = bits[:, :tables * DEPTH].reshape(len(x), tables, DEPTH) @ powers
            sketch = np.packbits(bits[:, tables * DEPTH:], axis=1).view(np.int64).reshape(len(x), SKETCH)
            yield pd.DataFrame({"rep": pdf["rep"], "keys": list(keys), "sketch": list(sketch),
                                "length": np.linalg.norm(x, axis=1)})

    signed = cut(unique.mapInPandas(signs, f"rep {id_type}, keys array<bigint>, sketch array<bigint>, length double"), "signs")

    # Buckets, split bit by bit where they are large.
    todo = signed.select("rep", F.posexplode("keys").alias("t", "k"))
    cells, depth, step = [], start, 0
    while True:
        at = todo.withColumn("prefix", F.shiftright("k", DEPTH - depth) if depth else F.lit(0).cast("long"))
        sizes = at.groupBy("t", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = cut(at.join(sizes, ["t", "prefix"]), f"depth-{step}")
        last = depth == DEPTH
        small = sized if last else sized.where(F.col("n") <= chunk)
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk).cast("int"))
        cells.append(small.select("rep", "t", F.lit(depth).alias("d"), "prefix", blocks.alias("blocks")))
        todo = sized.where(F.col("n") > chunk).select("rep", "t", "k")
        if last or todo.limit(1).count() == 0:
            break
        depth, step = min(DEPTH, depth + STEP), step + 1
    placed = cells[0]
    for c in cells[1:]:
        placed = placed.unionByName(c)

    # A cell of more than one block is met block by block; most have one.
    block = F.pmod(F.xxhash64("rep"), F.col("blocks").cast("long")).cast("int")
    mine = placed.withColumn("block", block).join(signed.select("rep", "sketch", "length"), "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    low = mine.withColumn("o", other)
    pieces = low.select("t", "d", "prefix", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "rep", "block",
                        "sketch", "length")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        s = np.stack(pdf["sketch"].to_numpy()).view(np.uint64)
        ids, length, blk = pdf["rep"].to_numpy(), pdf["length"].to_numpy(), pdf["block"].to_numpy()
        differ = sum(np.bitwise_count(s[:, None, k] ^ s[None, :, k]).astype(np.int16) for k in range(SKETCH))
        longest = np.maximum(length[:, None], length[None, :])
        share = np.where(longest <= r, 1.0, np.arcsin(np.minimum(1.0, r / np.maximum(longest, 1e-12))) / np.pi)
        bits = SKETCH * 64
        near = differ <= bits * share + 5 * np.sqrt(bits * share * (1 - share)) + 1
        own = ids[:, None] < ids[None, :]
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            own &= blk[:, None] != blk[None, :]  # pairs of one block meet in that block's own group
        a, b = np.nonzero(near & own)
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    pairs = pieces.groupBy("t", "d", "prefix", "i", "j").applyInPandas(compare, f"a {id_type}, b {id_type}").distinct()
    pairs = cut(pairs, "pairs")
    exact = (pairs.join(unique.select(F.col("rep").alias("a"), F.col("v").alias("va")), "a")
             .join(unique.select(F.col("rep").alias("b"), F.col("v").alias("vb")), "b")
             .select("a", "b", cosine("va", "vb").alias("s")).where(F.col("s") > F.lit(float(threshold))))
    return Classes(signed, members, cut(exact, "links"), tables, pairs.count())


def banded_pairs(df: DataFrame, id_col: str, vec_col: str, threshold: float, top: int | None = None, digits: int = 3,
                 **how) -> DataFrame:
    """All pairs ``a < b`` above ``threshold`` with their rounded score, copies written out."""
    found = linked_classes(df, id_col, vec_col, threshold, **how)
    of = lambda side: found.members.select(F.col("rep").alias(side), F.col("id").alias(f"id_{side}"))
    between = found.links.join(of("a"), "a").join(of("b"), "b").select("id_a", "id_b", "s")
    x, y = (found.members.select("rep", F.col("id").alias(f"id_{side}")) for side in "ab")
    vectors = df.select(F.col(id_col).alias("rep"), F.col(vec_col).alias("v"))
    copied = found.members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("rep")
    itself = vectors.join(copied, "rep").select("rep", cosine("v", "v").alias("s"))
    copies = x.join(y, "rep").where("id_a < id_b").join(itself, "rep").where(F.col("s") > F.lit(float(threshold)))
    pairs = between.unionByName(copies.select("id_a", "id_b", "s")).select(
        F.least("id_a", "id_b").alias(f"{id_col}_a"), F.greatest("id_a", "id_b").alias(f"{id_col}_b"), F.round("s", digits).alias("sim"))
    if top is not None:
        pairs = pairs.orderBy(F.col("sim").desc(), f"{id_col}_a", f"{id_col}_b").limit(top)
    return pairs


def duplicate_classes(df: DataFrame, id_col: str, vec_col: str, threshold: float, **how) -> DataFrame:
    """One row a vector: id, class (smallest id with an equal vector), copies in it, links to other classes."""
    found = linked_classes(df, id_col, vec_col, threshold, **how)
    ends = found.links.select(F.col("a").alias("rep")).unionAll(found.links.select(F.col("b").alias("rep")))
    links = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    copies = found.members.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    return (found.members.join(copies, "rep").join(links, "rep", "left")
            .select(F.col("id").alias(id_col), F.col("rep").alias("class_id"), "copies",
                    F.coalesce("links", F.lit(0).cast("long")).alias("links")))
