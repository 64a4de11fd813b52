"""Removal of repeated passages by relative Lempel-Ziv parsing.

A window is ``WINDOW`` consecutive words of one document; it is repeated if its words
also start earlier (in a smaller document, or earlier in the same one).  Every word
that a repeated window covers goes.

Reference blocks are the pieces of ``PIECE`` words (with a margin) of the documents.
A document would have to be factored against every block that starts no later.  Blocks
that hold none of its windows yield no sufficiently long factor, so it is sent only to
blocks that can hold one, and the result is the same:

1. In every window the word ``GRAM``-gram with the smallest hash is its anchor, so equal
   windows have equal anchors at equal places.  About one word in seven is an anchor.
   The first occurrence of each repeated anchor names a block; the pieces that hold
   its other occurrences are factored against that block.
2. Parsing is greedy: at each word the longest match in the block is taken (the block's
   index maps its grams to their places), words without one are literals.  A window
   that occurs in the block lies in one factor or has exactly one end of a factor inside.
   So factors of ``WINDOW`` words or more are repeated spans, and at each end of a factor
   the windows across it are looked up in the block's index of windows.
3. An anchor may first occur in other surroundings than a window that holds it.  Windows
   that have a repeated anchor and were not found are sent by the hash of the whole
   window, in the same way: if the block of step 1 does not hold the window, then none of
   its occurrences was found there, so its first occurrence is among them.

A passage in a third of all documents is one block, against which each piece is
factored once: work follows the number of occurrences, never their pairs, and the
joins are plain joins by key that Spark splits where they are skewed.  Matches are
compared word by word (64-bit hashes of words), not only by their window's hash.

* Words are split at ASCII white space and compared as they are.  Null and empty texts
  have none; their kept text is empty.
* Documents are ordered by id, null ids first; rows that share an id by a hash of their
  text.  Rows that share both are one document and get the same result.
* A document shorter than a window loses nothing.  Long documents are many pieces.
* An empty table gives an empty result.  Extra columns stay unread, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cardmart.llm.common import Scratch, WordHash, mixed

WINDOW, GRAM, PIECE = 20, 8, 256
#: Words of a piece before its first and after its last own word, so that every window with an anchor in it is whole.
LEFT, RIGHT = WINDOW - GRAM, WINDOW - 1
PLACE = np.uint64((1 << 30) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2**64, as many as were needed so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 4096)
            cls.up, cls.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, np.uint64(b))]) for b in
                                (_BASE, pow(_BASE, -1, 1 << 64)))
        return cls.up[:n], cls.down[:n]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of k words, the same wherever the run stands."""
    n = len(words)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _Powers.of(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up)])
    return mixed((sums[k:] - sums[:-k]) * down[:n - k + 1])


def window_anchors(grams: np.ndarray) -> np.ndarray:
    """Place of the anchor of every window: its gram of the smallest hash, the first of equal ones."""
    span = WINDOW - GRAM + 1
    if len(grams) < span:
        return np.empty(0, np.int64)
    low = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = span - width
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    return (low & PLACE).astype(np.int64)


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashed(words: list[bytes], memo: WordHash) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


# ---------------------------------------------------------------- factoring

class Block:
    """A reference block and its index: places of its grams and of its windows."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.grams: dict[int, list[int]] = {}
        for at, h in enumerate(gram_hashes(words, GRAM).tolist()):
            self.grams.setdefault(h, []).append(at)
        self.windows: dict[int, int] = {}
        for at, h in enumerate(gram_hashes(words, WINDOW).tolist()):
            self.windows.setdefault(h, at)

    def match(self, words: np.ndarray, at: int, place: int) -> int:
        """Words that agree from ``at`` and, in the block, from ``place`` on."""
        m = min(len(words) - at, len(self.words) - place)
        differ = words[at:at + m] != self.words[place:place + m]
        first = int(differ.argmax()) if m else 0
        return first if m and differ[first] else m


def factor(words: np.ndarray, block: Block, ahead: int | None) -> Iterator[tuple[int, int]]:
    """(start, length) of the greedy factors of ``words``.

    ``ahead`` is how many words the piece starts after the block in the same document; a source
    must start before its copy then.  None: the block is of an earlier document.
    """
    grams, at = gram_hashes(words, GRAM).tolist(), 0
    while at < len(grams):
        best = 0
        for place in block.grams.get(grams[at], ()):
            if ahead is not None and place >= at + ahead:
                break
            best = max(best, block.match(words, at, place))
            if at + best == len(words):
                break
        if best >= GRAM:
            yield at, best
            at += best
        else:
            at += 1


def repeated_starts(words: np.ndarray, block: Block, ahead: int | None) -> list[tuple[int, int]]:
    """First and last start of runs of windows of ``words`` that occur in the block."""
    runs, windows = [], None
    for start, length in factor(words, block, ahead):
        end = start + length
        if length >= WINDOW:
            runs.append((start, end - WINDOW))
        if end == len(words):
            continue
        if windows is None:
            windows = gram_hashes(words, WINDOW).tolist()
        for s in range(max(start, end - WINDOW + 1), min(end, len(windows))):  # windows across the end of the factor
            place = block.windows.get(windows[s])
            if place is not None and (ahead is None or place < s + ahead) and block.match(words, s, place) >= WINDOW:
                runs.append((s, s))
    return runs


# ---------------------------------------------------------------- Spark

def _identified(docs: DataFrame) -> DataFrame:
    """doc and tie order documents: the id (nulls first) and a hash that tells rows of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(
        "doc_id", F.coalesce("doc_id", F.lit(-2 ** 63)).alias("doc"), F.xxhash64("doc_id", "text").alias("tie"), "text")


def scan(docs: DataFrame) -> DataFrame:
    """Of every document the number of words, the hash of its words, and its anchors (hash and place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in batches:
            counts, digests, keys, places = [], [], [], []
            for text in b["text"].to_pylist():
                words = split(text)
                grams = gram_hashes(hashed(words, memo), GRAM)
                at = np.unique(window_anchors(grams))
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                keys.append(grams[at].view(np.int64))
                places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["doc"], b["tie"], pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                names=["doc_id", "doc", "tie", "n_words", "sha", "keys", "places"])

    return _identified(docs).mapInArrow(
        run, "doc_id long, doc long, tie long, n_words long, sha string, keys array<long>, places array<int>")


def _routes(occurrences: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Pieces and the blocks they are sent to: (doc, tie, piece), (b_doc, b_tie, b_piece), places of the shared keys.

    The block is the one with the first occurrence of a key that occurs more than once.
    """
    firsts = (occurrences.groupBy("key").agg(F.min(F.struct("doc", "tie", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("key", F.col("first.doc").alias("b_doc"), F.col("first.tie").alias("b_tie"),
                                     F.col("first.at").alias("b_at")))
    firsts = scratch.cut(firsts, f"{name}-firsts")
    later = occurrences.join(firsts, "key").where("not (doc = b_doc and tie = b_tie and at = b_at)")
    piece = lambda c: F.expr(f"cast({c} div {PIECE} as int)")
    routes = (later.select("doc", "tie", piece("at").alias("piece"), "b_doc", "b_tie", piece("b_at").alias("b_piece"), "at")
              .groupBy("doc", "tie", "piece", "b_doc", "b_tie", "b_piece").agg(F.collect_set("at").alias("places")))
    routes = scratch.cut(routes, f"{name}-routes")
    scratch.drop(f"{name}-firsts")
    return routes


def _pieces(texts: DataFrame) -> DataFrame:
    """(doc, tie, piece, words) of whole texts: each piece with its margins, words joined by a space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, tie, text in zip(b["doc"].to_pylist(), b["tie"].to_pylist(), b["text"].to_pylist()):
                words = split(text)
                rows += [(doc, tie, p, b" ".join(words[max(0, p * PIECE - LEFT):(p + 1) * PIECE + RIGHT]))
                         for p in range(-(-len(words) // PIECE))]
            for at in range(0, len(rows), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[at:at + 5000]), types)], names=names)

    names, types = ["doc", "tie", "piece", "words"], [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return texts.mapInArrow(run, "doc long, tie long, piece int, words binary")


def _first_word(piece: int) -> int:
    return max(0, piece * PIECE - LEFT)


def _factored(routes: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc, tie, piece, first, last): runs of starts of repeated windows that parsing finds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, known, block = WordHash(), None, None
        for b in batches:
            out = []
            cols = [b[c].to_pylist() for c in ("doc", "tie", "piece", "words", "b_doc", "b_tie", "b_piece", "b_words")]
            for doc, tie, piece, words, b_doc, b_tie, b_piece, b_words in zip(*cols):
                if (key := (b_doc, b_tie, b_piece)) != known:
                    known, block = key, Block(hashed(b_words.split(), memo))
                start = _first_word(piece)
                ahead = start - _first_word(b_piece) if (doc, tie) == (b_doc, b_tie) else None
                out += [(doc, tie, piece, start + first, start + last)
                        for first, last in repeated_starts(hashed(words.split(), memo), block, ahead)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    names, types = ["doc", "tie", "piece", "first", "last"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    blocks = pieces.select(*[F.col(c).alias(f"b_{c}") for c in pieces.columns])
    both = routes.drop("places").join(pieces, ["doc", "tie", "piece"]).join(blocks, ["b_doc", "b_tie", "b_piece"])
    return both.mapInArrow(run, "doc long, tie long, piece int, first int, last int")


def _unfound(routes: DataFrame, pieces: DataFrame, spans: DataFrame) -> DataFrame:
    """(key, doc, tie, at): hash and start of the windows that have a repeated anchor and are in no span."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in batches:
            cols = []
            for doc, tie, piece, words, places, runs in zip(*(b[c].to_pylist() for c in (
                    "doc", "tie", "piece", "words", "places", "runs"))):
                hashes, start = hashed(words.split(), memo), _first_word(piece)
                anchors = window_anchors(gram_hashes(hashes, GRAM)) + start
                keep = np.isin(anchors, np.array(places))
                for r in runs or ():
                    keep[max(0, r["first"] - start):r["last"] - start + 1] = False
                at = np.flatnonzero(keep)
                if len(at):
                    cols.append((gram_hashes(hashes, WINDOW)[at].view(np.int64), np.full(len(at), doc), np.full(len(at), tie),
                                 (at + start).astype(np.int32)))
            if cols:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*cols)], names=["key", "doc", "tie", "at"])

    keys = ["doc", "tie", "piece"]
    places = routes.groupBy(*keys).agg(F.flatten(F.collect_list("places")).alias("places"))
    runs = spans.groupBy(*keys).agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    return places.join(pieces, keys).join(runs, keys, "left").mapInArrow(run, "key long, doc long, tie long, at int")


def _shortened(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, tie, n_removed, sha, kept) of the documents that lose words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, digests, kept = [], [], []
            for text, runs in zip(b["text"].to_pylist(), b["runs"].to_pylist()):
                words = split(text)
                edge = np.zeros(len(words) + 1, np.int64)
                for r in runs:
                    edge[r["first"]] += 1
                    edge[r["last"] + WINDOW] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b["doc"], b["tie"], pa.array(removed, pa.int64()), pa.array(digests, pa.string()),
                                              pa.array(kept, pa.string())], names=["doc", "tie", "n_removed", "sha", "kept"])

    runs = spans.groupBy("doc", "tie").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    return texts.join(runs, ["doc", "tie"]).mapInArrow(run, "doc long, tie long, n_removed long, sha string, kept string")


def repeated_spans(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts of every document, texts that share an anchor, and the runs (doc, tie, piece, first, last) of repeated windows."""
    facts = scratch.cut(scan(docs), "facts")
    anchors = facts.select("doc", "tie", F.explode(F.arrays_zip("keys", "places")).alias("a"))
    anchors = anchors.select(F.col("a.keys").alias("key"), "doc", "tie", F.col("a.places").alias("at"))
    routes = _routes(anchors, scratch, "anchors")

    # Whole texts that any piece or block is taken from, one row a document.
    wanted = routes.select("doc", "tie").unionByName(routes.select(F.col("b_doc").alias("doc"), F.col("b_tie").alias("tie"))).distinct()
    texts = _identified(docs).select("doc", "tie", "text").dropDuplicates(["doc", "tie"]).join(wanted, ["doc", "tie"], "left_semi")
    texts = scratch.cut(texts, "texts")
    pieces = _pieces(texts)
    first = scratch.cut(_factored(routes, pieces), "first-spans")

    unfound = scratch.cut(_unfound(routes, pieces, first), "windows")
    second = scratch.cut(_factored(_routes(unfound, scratch, "windows-by"), pieces), "second-spans")
    for name in ("anchors-routes", "windows", "windows-by-routes"):
        scratch.drop(name)
    return facts, texts, first.unionByName(second)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    scratch = Scratch(docs.sparkSession, "rlz")
    facts, texts, spans = repeated_spans(docs, scratch)
    short = scratch.cut(_shortened(texts, spans).drop("kept"), "shortened")
    scratch.drop("texts")
    return facts.select("doc_id", "doc", "tie", "n_words", F.col("sha").alias("whole")).join(short, ["doc", "tie"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("sha", "whole").alias("kept_sha256"))


def shorten_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text that is left of every row that loses words; other rows keep theirs and are not returned."""
    scratch = Scratch(docs.sparkSession, "rlz")
    _, texts, spans = repeated_spans(docs, scratch)
    return _shortened(texts, spans).select(F.when(F.col("doc") != F.lit(-2 ** 63), F.col("doc")).alias("doc_id"), "n_removed",
                                           F.col("kept").alias("text"))
