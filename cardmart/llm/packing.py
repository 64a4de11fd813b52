"""Hierarchical packing of token sequences of several lengths.

Each task packs the documents of its own input split.  A document's token ids
(with the separator) are cut into whole windows of the longest tier; what is
left is routed to the smallest tier that holds it.  Each tier is packed by best
fit.  Then the gaps of longer windows are filled, largest first, from the
pieces of the next shorter tiers, cutting the last one so that nothing is left
open.  Tiers are powers of two, so a full window of any tier needs no padding;
windows of a shorter tier that are not full are emptied into windows of the
longest, and only those may be padded.

Sequences are dealt into steps of ``step_tokens`` tokens, each tier spread
evenly over the steps of its task, so that all steps mix the tiers alike.

Null text: empty, so the document is the separator alone.  Every id of every
document is in exactly one piece.  Repeated rows are packed each on its own
(their pieces share doc_id).  A retried task packs the same split the same way.
Empty tables give no rows.  Other columns stay unread.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

TIERS = (128, 256, 512, 1024)
SEPARATOR = 0
STEP_TOKENS = 32 * 1024
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step long")


class Encoder:
    """Token ids of whole texts, equal to those of the ``tokenizers`` file.

    A byte-level BPE is decided by its ranks and its pattern, so the ids are made by
    ``tiktoken`` from the same vocabulary, several times as fast.  Texts that hold
    the string of an added token, which the file treats apart, and texts whose runs
    of white space are too long for its matcher are encoded by ``tokenizers``.
    """

    def __init__(self, path: str, ranks: str, pattern: str, longest_run: int = 10_000):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.long_run = re.compile(r"\s{%d}" % longest_run)

    def ids(self, text: str) -> np.ndarray:
        if any(a in text for a in self.added) or (len(text) > 10_000 and self.long_run.search(text)):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u4")


def best_fit(pieces: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """Pieces (document, start, length) into bins of ``size``, longest first, each into the fullest bin it fits."""
    bins: list[list[tuple[int, int, int]]] = []
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0], p[1])):
        at = bisect_left(room, (piece[2], -1))
        if at == len(room):
            bins.append([piece])
            free, where = size - piece[2], len(bins) - 1
        else:
            free, where = room.pop(at)
            bins[where].append(piece)
            free -= piece[2]
        if free:
            insort(room, (free, where))
    return bins


def pack(lengths: list[int], tiers=TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, pieces) of documents with these lengths."""
    top = tiers[-1]
    whole, routed = [], {t: [] for t in tiers}
    for d, n in enumerate(lengths):
        full = n // top * top
        whole += [(top, [(d, s, top)]) for s in range(0, full, top)]
        if n > full:
            routed[next(t for t in tiers if t >= n - full)].append((d, full, n - full))
    fill = lambda b: sum(p[2] for p in b)
    packed = {t: best_fit(routed[t], t) for t in tiers}
    done = whole
    for t in tiers:
        done += [(t, b) for b in packed[t] if fill(b) == t]
        packed[t] = [b for b in packed[t] if fill(b) < t]
    # Fill the gaps of longer windows from shorter tiers, the longest pieces first.
    spare = [p for t in tiers[:-1] for b in packed[t] for p in b]
    heap = [(-n, d, s) for d, s, n in spare]
    heapq.heapify(heap)
    bins = sorted(packed[top], key=lambda b: -fill(b))
    while bins or heap:
        b = bins.pop(0) if bins else []
        free = top - fill(b)
        while free and heap:
            n, d, s = heapq.heappop(heap)
            take = min(-n, free)
            b.append((d, s, take))
            free -= take
            if -n > take:
                heapq.heappush(heap, (n + take, d, s + take))
        if free and bins:  # no short piece is left: fill from the emptiest window
            last = bins[-1]
            while free and last:
                d, s, n = last.pop()
                take = min(n, free)
                b.append((d, s, take))
                free -= take
                if n > take:
                    last.append((d, s + take, n - take))
            if not last:
                bins.pop()
        done.append((top, b))
    return done


def balanced_steps(tiers: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Step of each sequence: sequences of one tier are spread evenly over all steps."""
    steps = max(1, -(-sum(tiers) // step_tokens))
    count: dict[int, int] = {}
    for t in tiers:
        count[t] = count.get(t, 0) + 1
    seen = dict.fromkeys(count, 0)
    out = []
    for t in tiers:
        out.append(seen[t] * steps // count[t])
        seen[t] += 1
    return out


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str, pattern: str, tiers=TIERS, step_tokens: int = STEP_TOKENS,
                   shard_tokens: int = 4 << 20) -> DataFrame:
    """One row per piece.  ``tokenizer`` and ``ranks`` are two files of one vocabulary (paths on every worker).

    Narrow: tokens never leave the task that reads the text.

    A task packs whenever ``shard_tokens`` ids are gathered, which bounds its memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks, pattern)
        part = TaskContext.get().partitionId()
        state = {"sequence": 0, "step": 0}
        ids: list[np.ndarray] = []
        names: list = []

        def flush():
            rows = []
            sequences = pack([len(x) for x in ids], tiers)
            for (tier, pieces), step in zip(sequences, balanced_steps([t for t, _ in sequences], step_tokens)):
                offset, sequence = 0, (part << 32) | state["sequence"]
                state["sequence"] += 1
                for d, start, length in pieces:
                    crc = zlib.crc32(ids[d][start:start + length].tobytes())
                    rows.append((names[d], start, length, crc, len(ids[d]), sequence, offset, tier,
                                 (part << 32) | (state["step"] + step)))
                    offset += length
            state["step"] += max(1, -(-sum(t for t, _ in sequences) // step_tokens))
            ids.clear()
            names.clear()
            for i in range(0, len(rows), 50_000):
                cols = list(zip(*rows[i:i + 50_000]))
                kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"])

        held = 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                one = np.append(encoder.ids(text or ""), np.array([SEPARATOR], dtype="<u4")).astype("<u4")
                ids.append(one)
                names.append(doc_id)
                held += len(one)
                if held >= shard_tokens:
                    yield from flush()
                    held = 0
        if ids:
            yield from flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
