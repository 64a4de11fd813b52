"""Document fingerprints: a threshold-scaled sketch of the shingles of a text.

A sketch keeps every 64-bit shingle hash below ``2**64 * fraction``.  The rule
looks at one hash alone, so the sketch of a union is the union of sketches and
the share of a sketch found in another estimates containment, however unequal
the texts are.  A text too short to have such a hash keeps its smallest hash
(``merge`` drops it again as soon as a hash below the threshold comes in).

Shingles are of five lower-cased words; fewer words are one shingle.  Null and
empty texts have the empty sketch; two empty sketches are alike (1), an empty
and another one are not (0).  Equal texts have equal sketches.  The next
document of a row is the one after it in the order of doc_id (null ids first;
ties by text), that of the last row is the first.  Rows without an id follow one another by
text and so share a part.  Other columns stay unread.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from cardmart.llm.common import WordHash, shingle_hashes, word_hashes

SHINGLE = 5
FRACTION = 1 / 4


def sketch(text: str | None, memo: WordHash, fraction: float = FRACTION) -> np.ndarray:
    """Sorted hashes (unsigned) of one text."""
    h = shingle_hashes(word_hashes(text, memo), SHINGLE)
    kept = h[:np.searchsorted(h, np.uint64(int(fraction * 2 ** 64)))]
    return kept if len(kept) else h[:1]


def _below(fraction: float):
    """Condition on a hash held as a signed number of the same bits."""
    limit = int(fraction * 2 ** 64)
    if limit > 2 ** 63:
        raise ValueError("a fraction is at most one half")
    return lambda x: (x >= 0) & (x <= limit - 1)


def _counts(a: Column, b: Column, fraction: float) -> tuple[Column, Column, Column]:
    """Hashes below the threshold in a, in b and in both.  Sketches are sorted and distinct, so one look tells names from sketches."""
    below = _below(fraction)
    n = [F.when(F.coalesce(below(F.get(x, F.lit(0))), F.lit(False)), F.size(x)).otherwise(0) for x in (a, b)]
    return n[0], n[1], F.when((n[0] > 0) & (n[1] > 0), F.size(F.array_intersect(a, b))).otherwise(0)


def containment(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Share of the smaller sketch that is in the other one (0 to 1)."""
    n, m, both = _counts(a, b, fraction)
    return F.when(a == b, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(both / F.least(n, m))


def jaccard(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    n, m, both = _counts(a, b, fraction)
    return F.when(a == b, 1.0).when((n == 0) | (m == 0), 0.0).otherwise(both / (n + m - both))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of the union of two texts (hashes are held as signed numbers of the same bits)."""
    union = F.array_sort(F.array_union(a, b))
    inside = F.filter(union, _below(fraction))
    return F.when(F.size(inside) > 0, inside).otherwise(union)


def as_text(a: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(part, tail, doc_id, text): rows dealt by ranges of doc_id, so that a row's next is the row after it.

    Each part also gets a copy of the first row of the part after it (``tail``);
    the last gets the first row of all.  Two numbers a part pass the driver: its lower bound,
    which a row finds by binary search, and its smallest id, which travels back as a table of as
    many rows as there are parts.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf)).alias("place"))
    cuts = rows.where("doc_id is not null").approxQuantile("place", [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(bounds) > 2:
        rows = Bucketizer(splits=bounds, inputCol="place", outputCol="part").transform(rows).withColumn("part", F.col("part").cast("int"))
    else:
        rows = rows.withColumn("part", F.lit(0))
    rows = rows.select("part", "doc_id", "text")
    firsts = sorted(rows.groupBy("part").agg(F.max(F.col("doc_id").isNull()).alias("nulls"), F.min("doc_id").alias("first")).collect())
    if not firsts:
        return rows.select("part", F.lit(False).alias("tail"), "doc_id", "text")
    heads = [(r["part"], firsts[i - 1]["part"], None if r["nulls"] else r["first"]) for i, r in enumerate(firsts)]
    heads = spark.createDataFrame(heads, "part int, before int, first long")  # the first part's head also ends the last part
    copies = (rows.join(F.broadcast(heads), "part").where(F.col("doc_id").eqNullSafe(F.col("first")))
              .groupBy("before").agg(F.min(F.struct("doc_id", "text")).alias("row"))
              .select(F.col("before").alias("part"), F.lit(True).alias("tail"), "row.doc_id", "row.text"))
    dealt = rows.select("part", F.lit(False).alias("tail"), "doc_id", "text").unionByName(copies)
    return dealt.repartitionById(len(bounds) - 1, F.col("part")).sortWithinPartitions("tail", "doc_id", "text")


def fingerprint_documents(docs: DataFrame, fraction: float = FRACTION, partitions: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, and the sketches of the text, the edited text and the next text.

    Edited: the last floor(n/2) code points are replaced by the first as many of the next document.
    One shuffle of the texts, by ranges; within a part the rows are read as a stream.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "next_sketch"]
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, rows = WordHash(), None, []

        def done(row, after):
            doc_id, text, own = row
            half = len(text) // 2
            edited = text[:len(text) - half] + after[1][:half]
            changed = sketch(edited, memo, fraction) if edited != text else own
            rows.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                         own.view(np.int64), changed.view(np.int64), after[2].view(np.int64)))

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
            return batch

        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                now = (doc_id, text, sketch(text, memo, fraction))
                if held is not None:
                    done(held, now)
                held = now  # the last row of a part is the copy of the next part's head
                if len(rows) >= 500:
                    yield out()
        if rows:
            yield out()

    schema = ("doc_id long, n_chars long, edited_sha256 string, sketch array<bigint>, edited_sketch array<bigint>, "
              "next_sketch array<bigint>")
    return with_next(docs, partitions).select("doc_id", "text").mapInArrow(run, schema)
