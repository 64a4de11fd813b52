"""Near-duplicate documents by SuperMinHash signatures.

1. Every text becomes the set of its hashed word shingles.  Documents with equal
   sets are one class from here on, so a group of copies costs one row.
2. A SuperMinHash signature is drawn from each set: element by element a random
   permutation of the slots is built step by step, and step ``j`` offers the
   value ``j + r`` to its slot.  Values of step ``j`` lie in [j, j+1), so once
   every slot holds a value below ``j + 1`` no later step can change anything:
   drawing stops there, for most texts after a few steps.
3. Bands of ``rows`` slots are hashed into buckets.  Two sets with a similarity of
   0.8 share no bucket with probability (1 - 0.8**rows)**bands = 5e-6.
4. In each bucket all members are paired with one hub only: the member with the
   most bucket mates over all its buckets.  Pairs pass a size bound and a bound
   on the bits of a 1-bit sketch (a true pair fails with probability 1e-6), then
   the exact test on the full sets.  Connected components follow.
5. Buckets whose members are by now in different components are not settled.  Among
   the members of all of them the remaining links are found by prefix filtering: of
   each set the rarest shingles come first, and a pair is tried if it shares one of
   the first few, which every similar pair does.  Copies of one text with edits of
   their own each share none of those, so large families make few pairs.  A link
   inside one component cannot change the result, so none that matters is left out.

Words: A-Z in lower case, split at ASCII white space.  Fewer words than the
shingle size: the whole sequence is one shingle.  Null and empty texts, and texts
without words, have the empty set and are linked with nothing.  A null id is
never linked (its component is null and it is kept).  Rows that share an id are
one document: they are kept or dropped together, linked by all their texts.
Empty tables give empty results.  Other columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardmart.llm.common import MIX, Scratch, WordHash, mixed, shingle_hashes, word_hashes

SHINGLE = 4
ROWS, BANDS = 6, 40
SLOTS = ROWS * BANDS
#: Bits in which the 1-bit sketches of a linked pair may differ: mean at similarity 0.8 is a tenth, plus 5.3 deviations.
MAX_BITS = int(SLOTS * 0.1 + 5.3 * (SLOTS * 0.09) ** 0.5)
BIT_WORDS = -(-SLOTS // 64)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """[sets, slots] of signature values as 64-bit hashes; sets must not be empty.

    Works on all sets at once, step by step; sets that are done leave.
    Value and slot of an element at a step depend on the element's hash alone.
    """
    n = len(sets)
    best = np.full(n * slots, np.uint64(2 ** 64 - 1))
    level = np.full(n * slots, 255 if slots < 256 else 65535, dtype=np.uint16)
    elements = np.concatenate(sets) if n else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    perm = None
    for j in range(slots):
        r = mixed(elements + np.uint64((2 * j + 1) * int(MIX) & (2 ** 64 - 1)))
        pick = j + ((mixed(r ^ MIX) >> np.uint64(32)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = pick
        else:
            at = np.arange(len(elements))
            slot = perm[at, pick].astype(np.int64)
            perm[at, pick] = perm[:, j]
            perm[:, j] = slot
        where = owner * slots + slot
        free = level[where] >= j  # a slot that an earlier step has reached keeps its value
        np.minimum.at(best, where[free], r[free])
        level[where[free]] = j
        open_sets = (level.reshape(n, slots) == level.dtype.type(255 if slots < 256 else 65535)).any(axis=1)
        if not open_sets.any():
            break
        stay = open_sets[owner]
        if perm is None:
            first = pick[stay]
            elements, owner = elements[stay], owner[stay]
            perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
            perm[np.arange(len(elements)), first] = 0
            perm[:, 0] = first
        elif not stay.all():
            elements, owner, perm = elements[stay], owner[stay], perm[stay]
    # A slot's value is its step and its draw.
    return mixed(best.reshape(n, slots) ^ (level.reshape(n, slots).astype(np.uint64) * MIX))


def band_keys(signature: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    parts = signature[:, :rows * bands].reshape(len(signature), bands, rows)
    h = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for i in range(rows):
        h = mixed((h + parts[:, :, i]) * MIX)
    return h.view(np.int64)


def bit_sketch(signature: np.ndarray) -> np.ndarray:
    """One bit of every slot, in 64-bit words."""
    bits = (signature >> np.uint64(17) & np.uint64(1)).astype(np.uint8)
    pad = np.zeros((len(bits), BIT_WORDS * 64 - bits.shape[1]), np.uint8)
    return np.packbits(np.hstack([bits, pad]), axis=1).view(np.int64).reshape(len(bits), BIT_WORDS)


def signatures(docs: DataFrame, shingle: int = SHINGLE, batch_elements: int = 200_000) -> DataFrame:
    """doc_id, n_shingles, set_hash (128 bits, two longs; null for the empty set), bits, bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        salt = np.uint64(0x2545F4914F6CDD1D)

        def out(ids, sets):
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = super_minhash([sets[i] for i in full])
            bands, bits = [None] * len(sets), [None] * len(sets)
            h1, h2 = [None] * len(sets), [None] * len(sets)
            keys, sketches = band_keys(sig), bit_sketch(sig)
            for k, i in enumerate(full):
                bands[i], bits[i] = keys[k], sketches[k]
                a = mixed(sets[i] ^ salt)
                h1[i] = int(np.add.reduce(a).view(np.int64))
                h2[i] = int(np.add.reduce(mixed(a + MIX)).view(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_hash", "set_hash2", "bits", "bands"])

        ids, sets, held = [], [], 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                ids.append(doc_id)
                sets.append(shingle_hashes(word_hashes(text, memo), shingle))
                held += len(sets[-1])
                if held >= batch_elements or len(ids) >= 2000:
                    yield out(ids, sets)
                    ids, sets, held = [], [], 0
        if ids:
            yield out(ids, sets)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_hash long, set_hash2 long, bits array<bigint>, bands array<bigint>")


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the sorted shingle hashes of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in batches:
            sets = [shingle_hashes(word_hashes(t, memo), shingle).view(np.int64) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(sets, pa.list_(pa.int64()))],
                                             names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<bigint>")


def _plausible(a: str, b: str, percent: int) -> Column:
    """Size bound and 1-bit bound of a pair with columns ``{a}n``, ``{a}bits`` and so on."""
    n, m = F.col(a + "n"), F.col(b + "n")
    differ = sum((F.bit_count(F.get(a + "bits", F.lit(i)).bitwiseXOR(F.get(b + "bits", F.lit(i))))
                  for i in range(BIT_WORDS)), F.lit(0))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (differ <= MAX_BITS)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return (pairs.join(left, "b").join(right, "a").where(100 * both >= percent * union).select("a", "b"))


def components(edges: DataFrame, scratch: Scratch, name: str, max_rounds: int = 50) -> DataFrame:
    """(node, component): smallest node reachable.  Large-star and small-star rounds until nothing changes."""
    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not larger:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        joined = both.join(low, "a")
        if larger:
            out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
                low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    def state(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = scratch.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), f"{name}-0")
    before = state(now)
    for i in range(1, max_rounds + 1):
        if before[0] == 0:
            break
        following = scratch.cut(star(star(now, True), False), f"{name}-{i}")
        after = state(following)
        scratch.drop(f"{name}-{i - 1}")
        now = following
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE,
                    scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "neardup")
    base = scratch.cut(signatures(docs, shingle), "signatures")

    # One class per distinct set, named by its smallest id.
    known = base.where("set_hash is not null and doc_id is not null")
    classes = scratch.cut(
        known.groupBy("set_hash", "set_hash2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                   F.first("n_shingles").alias("n"), F.first("bits").alias("bits"),
                                                   F.first("bands").alias("bands")), "classes")

    rows = classes.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    members = scratch.cut(rows.join(shared, "key"), "members")
    degree = members.groupBy("rep").agg(F.sum("mates").alias("degree"))
    hubs = (members.join(degree, "rep").groupBy("key")
            .agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("top"))
            .select("key", (-F.col("top.minus")).alias("a")))
    info = classes.select("rep", "n", "bits")
    as_a = info.select(F.col("rep").alias("a"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    as_b = info.select(F.col("rep").alias("b"), F.col("n").alias("b_n"), F.col("bits").alias("b_bits"))
    stars = (members.join(hubs, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
             .join(as_b, "b").join(as_a, "a").where(_plausible("a_", "b_", percent)).select("a", "b"))
    stars = scratch.cut(stars, "stars")

    # Full sets of all classes that share a bucket with another one of a plausible size.
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = scratch.cut(shingle_sets(texts, shingle).join(
        base.where("set_hash is not null").select("doc_id").distinct(), "doc_id", "left_semi"), "sets")
    links = scratch.cut(verified(stars, sets, percent), "links")
    scratch.drop("stars")
    found = components(links, scratch, "first")
    scratch.drop("links")

    def unsettled(found: DataFrame, name: str) -> DataFrame:
        """Members (with their component) of buckets that hold more than one component."""
        label = found.select(F.col("node").alias("rep"), F.col("component").alias("found"))
        labelled = members.select("key", "rep").join(label, "rep", "left").select(
            "key", "rep", F.coalesce("found", "rep").alias("label"))
        keys = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where(
            "lo <> hi").select("key")
        return scratch.cut(labelled.join(keys, "key").join(info, "rep"), name)

    # Their remaining links.  The rarest shingles of a set come first; two sets that are similar enough
    # must share one among their first n - ceil(percent * n) + 1, so only such pairs are tried.
    open_sets = (unsettled(found, "open").select(F.col("rep").alias("doc_id"), "label", "n", "bits").distinct()
                 .join(sets, "doc_id"))
    tokens = scratch.cut(open_sets.select("doc_id", F.explode("shingles").alias("s")), "open-shingles")
    scratch.drop("members")
    spread = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("df", "s"))
    first = (tokens.join(spread, "s").withColumn("place", place)
             .join(open_sets.select("doc_id", "label", "n", "bits"), "doc_id")
             .where((F.col("df") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)))
    first = scratch.cut(first, "open-prefixes")
    scratch.drop("open-shingles")
    scratch.drop("open")
    x = first.select("s", F.col("doc_id").alias("a"), F.col("label").alias("a_label"),
                     F.col("n").alias("a_n"), F.col("bits").alias("a_bits"), F.col("place").alias("a_place"))
    y = first.select("s", F.col("doc_id").alias("b"), F.col("label").alias("b_label"),
                     F.col("n").alias("b_n"), F.col("bits").alias("b_bits"), F.col("place").alias("b_place"))
    # The first shingle that a pair shares leaves room for no more than the places after it.
    room = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place")) + 1
    enough = room * (100 + percent) >= percent * (F.col("a_n") + F.col("b_n"))
    more = (x.join(y, (x["s"] == y["s"]) & (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label"))
                   & enough & _plausible("a_", "b_", percent)).select("a", "b").distinct())
    more = scratch.cut(more, "open-pairs")
    scratch.drop("open-prefixes")
    more = scratch.cut(verified(more, sets, percent), "more")
    scratch.drop("sets")
    # The same id under several texts ties its classes together.
    again = (known.select("doc_id", "set_hash", "set_hash2").distinct()
             .join(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1"), "doc_id")
             .join(classes.select("set_hash", "set_hash2", "rep"), ["set_hash", "set_hash2"])
             .where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    graph = (found.select(F.col("node").alias("a"), F.col("component").alias("b"))
             .unionByName(more).unionByName(again))
    final = components(graph, scratch, "final")

    copied = classes.where("copies > 1").select("set_hash", "set_hash2", F.col("rep").alias("copy_of"))
    named = base.select("doc_id", "n_shingles", "set_hash", "set_hash2").join(
        copied, ["set_hash", "set_hash2"], "left").withColumn("rep", F.coalesce("copy_of", "doc_id"))
    named = named.join(final.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")))
    return named.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
