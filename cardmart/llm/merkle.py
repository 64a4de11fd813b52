"""Merkle manifest of a table by time-forward processing.

Every row is a leaf, the leaves of one language a tree of runs of eight, the roots of
the languages once more such a tree.  Nodes have labels in which children come before
parents, and are visited in label order; a node sends its digest to its parent through
a priority queue ordered by label, so that a parent finds all its children's digests
waiting when its turn comes.  A second sweep visits the labels in reversed order and
sends each child what its proof has above it, until the leaves have their whole proofs.

The queue has two parts.  Between blocks of ``BLOCK`` = 8**3 neighbouring nodes it is
an exchange of Spark, sorted by label (the external part, which spills as Spark
sorts): one round takes every tree three levels up or down, so 5e10 leaves take four
rounds each way.  Inside a block a task keeps the messages in a heap; a block never has
more than 512 nodes, whatever its language's size, and a hot language is many blocks.
Places of the leaves come from a range partitioning by (language, id) and the counts of
its parts; only one row a part and language is summed, nothing is numbered in one task.

* A field of a leaf is ``-`` if null, else its UTF-8 byte count, ``:`` and the value.
* Leaves of a language are ordered by id (nulls first), rows that share an id by their
  digest; equal rows are separate leaves with equal results.
* The null language is a language of its own, before all others.
* One leaf alone is its tree's root, an empty proof hashes as the empty text.
* An empty table gives an empty result.  Extra columns stay unread, whatever their names.
* Tampering: where 3 divides crc32 of the id's digits (a null id: of the empty text, which
  is 0), the letters A-Z of the text are lower-cased before the leaf is hashed again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmart.llm.common import Scratch

FAN, STEPS = 8, 3
BLOCK = FAN ** STEPS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<at: int, others: string>>"
_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.string())]))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- leaves and their places

def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of the fields of a row; a field may be given another value."""
    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in FIELDS]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (of the language; '-' for none), digest, altered digest, tampered."""
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    altered = leaf_digest(text=F.translate(F.col("text"), UPPER, LOWER))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"),
        leaf_digest().alias("digest"), F.when(tampered, altered).alias("altered"), tampered.alias("tampered"))


def placed(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with idx (place in the row's tree, from 0) and n (leaves of the tree)."""
    keys = ["tree", *order, "digest"]
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            places = []
            for t in b["tree"].to_pylist():
                tree, at = t, at + 1 if t == tree else 0
                places.append(at)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(places, pa.int64())],
                names=[*b.schema.names, "part", "place"])

    # Equal rows have nothing to be told apart by; the row number lets the ranges part them all the same.
    ranged = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row").drop("row")
    local = scratch.cut(ranged.mapInArrow(count, f"{schema}, part int, place long"), f"{name}-parts")
    sizes = local.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("k"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"),
                          F.sum("k").over(Window.partitionBy("tree")).alias("n"))
    out = local.join(starts, ["tree", "part"]).select(*rows.columns, (F.col("start") + F.col("place")).alias("idx"), "n")
    out = scratch.cut(out, name)
    scratch.drop(f"{name}-parts")
    return out


# ---------------------------------------------------------------- the two sweeps inside a block

def levels_of(n: int) -> int:
    """Levels that a block of a tree of n nodes has above them: three, or as many as leave one node."""
    if n > BLOCK:
        return STEPS
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def sweep_up(first: list[str], levels: int) -> dict[tuple[int, int], str]:
    """Digests by (level, place) of all nodes above ``first``, children before parents."""
    last = len(first) - 1

    def label(level: int, k: int) -> tuple[int, int]:
        return min((k + 1) * FAN ** level - 1, last), level

    found, queue = {}, []

    def done(level: int, k: int, value: str) -> None:
        found[level, k] = value
        if level < levels:
            heapq.heappush(queue, (label(level + 1, k // FAN), k, value))

    for k, value in enumerate(first):
        done(0, k, value)
        while queue and queue[0][0][0] <= k:  # all children of this node have sent
            at, run = queue[0][0], []
            while queue and queue[0][0] == at:
                _, child, child_digest = heapq.heappop(queue)
                run.append(child_digest)
            done(at[1], child // FAN, digest("".join(run)))
    return found


def sweep_down(found: dict[tuple[int, int], str], levels: int, above: tuple, suffix: str) -> Iterator[tuple[int, tuple, str]]:
    """(place, path, proof) of the first nodes, in reversed label order.

    A path is ((at, others), path of the parent); the proof is the others' text from the node to the root.
    """
    queue = [((0, -levels), 0, above, suffix)]
    while queue:
        (_, level), k, path, proof = heapq.heappop(queue)
        level = -level
        if level == 0:
            yield k, path, proof
            continue
        run = []
        while len(run) < FAN and (child := found.get((level - 1, k * FAN + len(run)))) is not None:
            run.append(child)
        for at in range(len(run)):
            others = "".join(run[:at] + run[at + 1:])
            child = k * FAN + at
            heapq.heappush(queue, ((-child * FAN ** (level - 1), 1 - level), child, ((at, others), path), others + proof))


def fold(leaf: str, path: tuple) -> str:
    """The root that a leaf and its path give."""
    while path:
        (at, others), path = path
        leaf = digest(others[:64 * at] + leaf + others[64 * at:])
    return leaf


# ---------------------------------------------------------------- rounds

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one block after another; the input is sorted by block."""
    block, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            if (key := (r["tree"], r["block"])) != block:
                if rows:
                    yield rows
                block, rows = key, []
            rows.append(r)
    if rows:
        yield rows


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def climb(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Tables of nodes (tree, idx, n, digest), each one round above the one before; the last has one node a tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _blocks(batches):
            n, levels = rows[0]["n"], levels_of(rows[0]["n"])
            top = sweep_up([r["digest"] for r in rows], levels)[levels, 0]
            out.append({"tree": rows[0]["tree"], "idx": rows[0]["block"], "n": -(-n // BLOCK), "digest": top})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 0) > 1:
        rows = tables[-1].select("tree", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "n", "digest")
        up = _dealt(rows, "idx").mapInArrow(run, "tree string, idx long, n long, digest string")
        tables.append(scratch.cut(up, f"{name}-{len(tables)}"))
    return tables


def _messages(tops: DataFrame, nodes: DataFrame, extra: list[str]) -> DataFrame:
    """Nodes of a round, and before those of each block what the round above sends to it."""
    sent = tops.select("tree", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), F.lit(0).cast("long").alias("n"),
                       F.lit(None).cast("string").alias("digest"), "path", "subroot",
                       *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in extra])
    own = nodes.select("tree", F.expr(f"idx div {BLOCK}").alias("block"), "idx", "n", "digest", F.lit(None).cast(PATH).alias("path"),
                       F.lit(None).cast("string").alias("subroot"), *extra)
    return _dealt(sent.unionByName(own), "idx")


def _delivered(rows: list[dict]) -> tuple[dict, list[dict], Iterator[tuple[int, tuple, str]]]:
    sent, own = rows[0], rows[1:]
    levels = levels_of(own[0]["n"])
    path: tuple = ()
    for step in reversed(sent["path"]):
        path = ((step["at"], step["others"]), path)
    suffix = "".join(step["others"] for step in sent["path"])
    return sent, own, sweep_down(sweep_up([r["digest"] for r in own], levels), levels, path, suffix)


def descend(tables: list[DataFrame], tops: DataFrame, scratch: Scratch, name: str, down_to: int = 0) -> DataFrame:
    """Paths (tree, idx, path, subroot) of the nodes of round ``down_to``, from those of the last round."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            sent, own, found = _delivered(rows)
            out = []
            for k, path, _ in found:
                steps = []
                while path:
                    (at, others), path = path
                    steps.append({"at": at, "others": others})
                out.append({"tree": sent["tree"], "idx": own[k]["idx"], "path": steps, "subroot": sent["subroot"]})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("path", _PATH), ("subroot", pa.string())])
    for k in range(len(tables) - 2, down_to - 1, -1):
        below = _messages(tops, tables[k], []).mapInArrow(run, f"tree string, idx long, path {PATH}, subroot string")
        tops = scratch.cut(below, f"{name}-{k}")
    return tops


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, tampered of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    own = placed(leaves(docs), ["doc_id"], scratch, "leaves")
    trees = climb(own, scratch, "up")
    subroots = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    forest = climb(placed(subroots, ["lang"], scratch, "subroots"), scratch, "top")
    top = forest[-1].first()
    root = top["digest"] if top else ""

    # Down: from the root to the languages' roots, then to the leaves.
    start = forest[-1].select("tree", "idx", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"))
    to_langs = descend(forest, start, scratch, "top-down")
    roots = forest[0].select("idx", F.col("lang").alias("tree"), "digest")
    start = roots.join(to_langs.select("idx", "path"), "idx").select(
        "tree", F.lit(0).cast("long").alias("idx"), "path", F.col("digest").alias("subroot"))
    if len(trees) == 1:  # every language is one leaf, which the message to block 0 reaches all the same
        blocks = start
    else:
        blocks = descend(trees, start, scratch, "down", down_to=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            sent, members, found = _delivered(rows)
            out = []
            for k, path, proof in found:
                r = members[k]
                folded = fold(r["altered"] or r["digest"], path)
                out.append({"doc_id": r["doc_id"], "leaf": r["digest"], "subroot": sent["subroot"], "root": root,
                            "proof_sha256": digest(proof), "folded_root": folded, "verified": folded == root,
                            "tampered": r["tampered"]})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                        ("verified", pa.bool_()), ("tampered", pa.bool_())])
    messages = _messages(blocks, own, ["doc_id", "altered", "tampered"])
    return messages.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                    "folded_root string, verified boolean, tampered boolean")
