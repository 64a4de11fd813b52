"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays.

Counting.  Tasks count words and bigrams of their split as sorted arrays; one
shuffle each brings equal ones together.  The vocabulary is written as shards of
sorted 64-bit word hashes; a word's id is its rank.  Bigrams are dealt by their
first word (those of very frequent words by both), and each partition writes its
keys and counts as two sorted arrays.  Nothing of the size of the corpus passes
the driver: it gets one row per shard, the counts of counts and the few words
that are frequent enough to be dealt apart.

Scoring.  Workers map the arrays into memory from the shared folder and look up
all words and bigrams of a batch in sorted order.

    P(v | u) = max(c(uv) - D(c(uv)), 0) / c(u.) + g(u) P(v)
    P(v)     = max(n(.v) - E(n(.v)), 0) / n(..) + h / (V + 1)

with three discounts D and E each from the counts of counts (modified
Kneser-Ney), n(.v) the number of different words before v, and V + 1 for one
more, unknown word.

Tokens: words with A-Z in lower case, then one end token; the first word follows
a start mark that is never predicted.  Null and empty texts are the end token
alone.  A document with a null id is training text.  Repeated rows count and are
scored each.  No training text: every probability is 1 / (V + 1) = 1.  Empty
tables give no rows.  Other columns stay unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cardmart.llm.common import MIX, Scratch, WordHash, mapped, mixed, word_hashes, write_file

END = np.array([xxhash.xxh3_64_intdigest(b"</s> ")], dtype=np.uint64).view(np.int64)  # holds a space, so no word
CHUNK = 4_000_000   # tokens that a task gathers before it counts them
SHARD_WORDS = 4_000_000
KEYS_PER_PART = 4_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(text: str | None, memo: WordHash) -> np.ndarray:
    return np.concatenate([word_hashes(text, memo).view(np.int64), END])


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


@lru_cache(maxsize=100_000)
def _array(uri: str, dtype: str) -> np.ndarray:
    return mapped(uri, np.dtype(dtype))


def discounts(n: list[float]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and more from the numbers of keys with counts 1 to 4.

    Each is held within a tenth and the whole of its count, so something is always left for unseen tokens.
    """
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        out.append(min(max(k - (k + 1) * y * b / a, 0.1 * k), k) if a and b else 0.5 * k)
    return tuple(out)


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


@dataclass(frozen=True)
class Vocabulary:
    folder: str
    shards: tuple[int, ...] = ()
    first: tuple[int, ...] = ()    # smallest hash of each shard
    offset: tuple[int, ...] = ()   # id of its first word
    size: int = 0
    tokens: int = 0

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of word hashes, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        if not self.shards:
            return out
        distinct, back = np.unique(hashes, return_inverse=True)
        found = np.full(len(distinct), -1, np.int64)
        shard = np.searchsorted(np.array(self.first), distinct, side="right") - 1
        for s in np.unique(shard[shard >= 0]):
            at = np.flatnonzero(shard == s)
            held = _array(f"{self.folder}/hash-{self.shards[s]}", "int64")
            place = np.minimum(np.searchsorted(held, distinct[at]), len(held) - 1)
            found[at] = np.where(held[place] == distinct[at], place + self.offset[s], -1)
        return found[back]

    def column(self, name: str, dtype: str, ids: np.ndarray) -> np.ndarray:
        """Values of a column for known ids (start mark: id ``size``)."""
        out = np.zeros(len(ids), np.dtype(dtype))
        shard = np.searchsorted(np.array(self.offset), ids, side="right") - 1
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            out[at] = _array(f"{self.folder}/{name}-{self.shards[s]}", dtype)[ids[at] - self.offset[s]]
        return out


def _numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b[name].to_numpy(zero_copy_only=False)


def build_vocabulary(train: DataFrame, scratch: Scratch) -> Vocabulary:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = WordHash(), [], 0
        for b in batches:
            for text in b["text"].to_pylist():
                held.append(tokens(text, memo))
                size += len(held[-1])
                if size >= CHUNK:
                    k, c = summed(np.concatenate(held))
                    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["h", "c"])
                    held, size = [], 0
        if held:
            k, c = summed(np.concatenate(held))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(c)], names=["h", "c"])

    words = scratch.cut(train.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    size, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    folder = scratch.path("model")
    if not size:
        return Vocabulary(folder)
    n = -(-size // SHARD_WORDS)
    low = -2 ** 63

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for b in batches:
            keys.append(_numbers(b, "h"))
            counts.append(_numbers(b, "c"))
        if keys:
            k, c = summed(np.concatenate(keys), np.concatenate(counts))
            name = (int(k[0]) - low) * n >> 64
            write_file(f"{folder}/hash-{name}", k.astype(np.int64).tobytes())
            write_file(f"{folder}/count-{name}", c.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_pydict({"shard": [name], "first": [int(k[0])], "n": [len(k)]})

    # Hashes are spread evenly, so equal ranges of them are equal shards.
    shard = F.floor((F.shiftrightunsigned("h", 32).bitwiseXOR(F.lit(0x80000000)) * n) / F.lit(float(2 ** 32))).cast("int")
    made = sorted(scratch.cut(words.repartitionById(n, shard).mapInArrow(write, "shard long, first long, n long"), "shards")
                  .collect(), key=lambda r: r["shard"])
    offsets = np.concatenate([[0], np.cumsum([r["n"] for r in made])]).tolist()
    return Vocabulary(folder, tuple(r["shard"] for r in made), tuple(r["first"] for r in made),
                      tuple(offsets[:-1]), int(size), int(total))


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    parts: int = 0
    hot: tuple[int, ...] = ()                     # ids whose bigrams are dealt by both words
    filled: frozenset[int] = field(default_factory=frozenset)
    d: tuple[float, float, float] = (0.5, 1.0, 1.5)
    e: tuple[float, float, float] = (0.5, 1.0, 1.5)
    types: int = 0                                # n(..)
    spare: float = 1.0                            # h

    def part(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return deal(u, v, self.parts, self.hot)

    def bigrams(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Counts of bigrams of known ids."""
        keys, back = np.unique(u << 32 | v, return_inverse=True)
        part = self.part(keys >> 32, keys & 0xFFFFFFFF)
        out = np.zeros(len(keys), np.int64)
        for p in np.unique(part):
            if int(p) in self.filled:
                at = np.flatnonzero(part == p)
                held = _array(f"{self.vocabulary.folder}/bigram-{p}", "int64")
                place = np.minimum(np.searchsorted(held, keys[at]), len(held) - 1)
                out[at] = np.where(held[place] == keys[at],
                                   _array(f"{self.vocabulary.folder}/bigram-count-{p}", "int64")[place], 0)
        return out[back]

    def log10(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 P of each token; ``starts`` are the positions at which a text begins."""
        vocabulary = self.vocabulary
        size = vocabulary.size
        before = np.concatenate([[size], ids[:-1]])
        before[starts] = size
        known = ids >= 0
        p = np.full(len(ids), self.spare / (size + 1))
        if not size:
            return np.log10(p)
        n = vocabulary.column("types", "int64", ids[known])
        p[known] += np.maximum(n - discount(n, self.e), 0) / self.types
        context = np.flatnonzero(before >= 0)
        p[context] *= vocabulary.column("back", "float64", before[context])
        both = context[known[context]]
        c = self.bigrams(before[both], ids[both])
        total = vocabulary.column("total", "int64", before[both])
        p[both] += np.maximum(c - discount(c, self.d), 0) / np.maximum(total, 1)
        return np.log10(p)


def deal(u: np.ndarray, v: np.ndarray, parts: int, hot: tuple[int, ...]) -> np.ndarray:
    by = np.where(np.isin(u, np.array(hot, np.int64)), u << 32 | v, u).astype(np.uint64)
    return (mixed((by + np.uint64(1)) * MIX) % np.uint64(parts)).astype(np.int64)


def fit(docs: DataFrame, scratch: Scratch | None = None) -> Model:
    """Count the texts of ``docs`` (all of them) into a model in the shared folder."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "ngram")
    vocabulary = build_vocabulary(docs, scratch)
    if not vocabulary.size:
        return Model(vocabulary)
    folder, size = vocabulary.folder, vocabulary.size
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-vocabulary.tokens // KEYS_PER_PART))
    limit = vocabulary.tokens / n / 8
    frequent = [r["h"] for r in spark.read.schema("h long, c long").parquet(scratch.path("words")).where(
        F.col("c") > limit).select("h").collect()]  # fewer than 8 n
    hot = (*sorted(vocabulary.ids(np.array(frequent, np.int64)).tolist()), size) if frequent else (size,)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, length = WordHash(), [], 0

        def out():
            sizes = np.array([len(x) for x in held])
            ids = vocabulary.ids(np.concatenate(held))
            before = np.concatenate([[size], ids[:-1]])
            before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = size
            k, c = summed(before << 32 | ids)
            p = deal(k >> 32, k & 0xFFFFFFFF, n, hot)
            for i in range(0, len(k), 500_000):
                s = slice(i, i + 500_000)
                yield pa.RecordBatch.from_arrays([pa.array(p[s].astype(np.int32)), pa.array(k[s]), pa.array(c[s].astype(np.int32))],
                                                 names=["p", "k", "c"])

        for b in batches:
            for text in b["text"].to_pylist():
                held.append(tokens(text, memo))
                length += len(held[-1])
                if length >= CHUNK:
                    yield from out()
                    held, length = [], 0
        if held:
            yield from out()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, name = [], [], None
        for b in batches:
            if b.num_rows:
                name = b["p"][0].as_py()
                keys.append(_numbers(b, "k"))
                counts.append(_numbers(b, "c").astype(np.int64))
        if not keys:
            return
        k, c = summed(np.concatenate(keys), np.concatenate(counts))
        write_file(f"{folder}/bigram-{name}", k.tobytes())
        write_file(f"{folder}/bigram-count-{name}", c.tobytes())

        def rows(kind, ids, *numbers):
            m = len(ids)
            cols = [np.full(m, kind, np.int32), ids.astype(np.int64), *[x.astype(np.int64) for x in numbers],
                    *[np.zeros(m, np.int64)] * (4 - len(numbers))]
            for i in range(0, m, 500_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 500_000]) for x in cols], names=["kind", "id", "a", "b", "c", "d"])

        u = k >> 32
        first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]))
        yield from rows(0, u[first], *[np.add.reduceat(x, first) for x in (c, c == 1, c == 2, c >= 3)])
        v, types = summed(k & 0xFFFFFFFF)
        yield from rows(1, v, types)
        yield from rows(2, np.array([name]), *[np.array([(c == i).sum()]) for i in (1, 2, 3, 4)])

    schema = "kind int, id long, a long, b long, c long, d long"
    counted = (docs.select("text").mapInArrow(count, "p int, k long, c int").repartitionById(n, F.col("p"))
               .mapInArrow(write, schema))
    stats = scratch.cut(counted, "stats")
    of_counts = stats.where("kind = 2").select("id", "a", "b", "c", "d").collect()  # one row a partition
    d = discounts([sum(r[x] for r in of_counts) for x in ("a", "b", "c", "d")])

    when = lambda kind, x: F.sum(F.when(F.col("kind") == kind, F.col(x)).otherwise(0))
    per_word = stats.where("kind < 2").groupBy("id").agg(
        when(0, "a").alias("total"), when(0, "b").alias("n1"), when(0, "c").alias("n2"), when(0, "d").alias("n3"),
        when(1, "a").alias("types"))
    bounds = np.array(vocabulary.offset)
    lengths = np.diff(np.append(bounds, size + 1))  # the start mark is the last id

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = {x: [] for x in ("id", "total", "n1", "n2", "n3", "types")}
        for b in batches:
            for x in cols:
                cols[x].append(_numbers(b, x))
        if not cols["id"] or not sum(map(len, cols["id"])):
            return
        cols = {x: np.concatenate(v) for x, v in cols.items()}
        s = int(np.searchsorted(bounds, cols["id"][0], side="right") - 1)
        at, name = cols["id"] - bounds[s], vocabulary.shards[s]
        total, types, back = (np.zeros(lengths[s], t) for t in (np.int64, np.int64, np.float64))
        total[at], types[at] = cols["total"], cols["types"]
        back[at] = (d[0] * cols["n1"] + d[1] * cols["n2"] + d[2] * cols["n3"]) / np.maximum(cols["total"], 1)
        for column, x in (("total", total), ("types", types), ("back", back)):
            write_file(f"{folder}/{column}-{name}", x.tobytes())
        yield pa.RecordBatch.from_pydict({"sum": [int(types.sum())], **{f"n{i}": [int((types == i).sum())] for i in (1, 2, 3, 4)},
                                          "more": [int((types >= 3).sum())]})

    shard = F.size(F.filter(F.array(*[F.lit(int(o)) for o in bounds]), lambda o: o <= F.col("id"))) - 1
    made = scratch.cut(per_word.repartitionById(len(bounds), shard).mapInArrow(
        arrays, "sum long, n1 long, n2 long, n3 long, n4 long, more long"), "made").collect()
    number = {x: sum(r[x] for r in made) for x in ("sum", "n1", "n2", "n3", "n4", "more")}
    e = discounts([number[f"n{i}"] for i in (1, 2, 3, 4)])
    spare = (e[0] * number["n1"] + e[1] * number["n2"] + e[2] * number["more"]) / max(number["sum"], 1)
    scratch.drop("stats")
    return Model(vocabulary, n, hot, frozenset(r["id"] for r in of_counts), d, e, number["sum"], spare)


def score(docs: DataFrame, model: Model, batch_tokens: int = 1_000_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score.  Narrow."""
    vocabulary = model.vocabulary
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, doc_ids, held, length = WordHash(), [], [], 0

        def out():
            sizes = np.array([len(x) for x in held])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            ids = vocabulary.ids(np.concatenate(held))
            known = ids >= 0
            counts = np.zeros(len(ids), np.int64)
            if vocabulary.size:
                counts[known] = vocabulary.column("count", "int64", ids[known])
            base = np.log10((counts + 1) / (vocabulary.tokens + vocabulary.size + 1))
            return pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                 pa.array(np.full(len(sizes), vocabulary.tokens, np.int64)),
                 pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(model.log10(ids, starts), starts))],
                names=names)

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                doc_ids.append(doc_id)
                held.append(tokens(text, memo))
                length += len(held[-1])
                if length >= batch_tokens:
                    yield out()
                    doc_ids, held, length = [], [], 0
        if held:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
