"""Toxicity by maximum-scoring segments of token log-odds.

Training, on labelled documents only.  Features of a word are the word itself in
lower case and its first ``STEM`` letters; a text counts once for each of its
features, so one repetitive text has no more weight than another.  For each feature
the log-odds of toxic against other texts are taken with an informative Dirichlet
prior in proportion to the feature's frequency in both, so rare features stay near
zero, and only those that differ from zero significantly (z) are kept.  A word scores
the largest weight among its features less a ``drift``; other words score minus
the drift.

Scoring.  One linear scan finds all maximal scoring segments of a text (Ruzzo and
Tompa): stretches whose total cannot be improved by moving an end.  By
extreme-value theory the number of segments with at least a total of ``s`` in an
innocent text of ``n`` words is about ``K n exp(-lambda s)``.  lambda solves
``sum p(x) exp(lambda x) = 1`` over the histogram of the word scores of innocent
training texts; K is the maximum-likelihood value for the best segment of each of
them, where a text without a segment says that its best is below the smallest
positive word score.  Half an observation of that score is added, so both exist where no
innocent text has a scoring word.  The evidence of a document is the sum of
-log(expected count) over its segments that are not expected by chance
(count below one).  The score rises with it from 0 to 1 and is ``THRESHOLD`` at the
evidence that parts the labelled training texts with the fewest errors.

Limit of the fit: at most ``MAX_TRAINING`` labelled documents (those with the
smallest md5 of their id; of rows that share an id, the smallest text), so the model
grows no further than their words and may travel with the tasks.  All features that are
significant in them are kept.  Every document is scored whole.

Rows: null or empty text scores 0.  Labels that are null or belong to no document
are left out; a document with several labels counts once for each.  Without
toxic or without other training texts every score is 0.  Repeated rows score
alike.  Extra columns are kept by ``with_score``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardmart.llm.common import Scratch

WORD = re.compile(r"\w+")
STEM = 5
MAX_TRAINING = 20_000
PRIOR = 100.0      # total weight of the Dirichlet prior, in texts
MIN_Z = 3.0
MIN_WEIGHT = 2.0
DRIFT = 0.35
THRESHOLD = 0.3
LEAST_LAMBDA = 1e-6


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last) of a text.

    ``hits`` are the positions with a positive score; every position costs
    ``drift``.  Time is linear in the number of hits.
    """
    # Candidates as (left total, right total, first, last), by the rule of Ruzzo and Tompa.
    stack: list[list] = []
    total, at = 0.0, 0
    for position, gain in hits:
        total -= drift * (position - at)
        left, total = total, total + gain - drift
        at = position + 1
        new = [left, total, position, position]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= new[0]:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= new[1]:
                stack.append([*new, j])
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(r - left, first, last) for left, r, first, last, _ in stack]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    drift: float
    lam: float
    k: float
    scale: float = 3.0  # evidence at which the score is THRESHOLD

    def hits(self, text: str | None) -> tuple[list[tuple[int, float]], int]:
        """Positions and weights of the words that score, and the number of words."""
        words = WORD.findall(text.lower()) if text else []
        get = self.weights.get
        hits = []
        for i, w in enumerate(words):
            x = get(w)
            if len(w) >= STEM:
                y = get(w[:STEM] + "~")
                x = y if x is None or (y is not None and y > x) else x
            if x is not None and x > self.drift:
                hits.append((i, x))
        return hits, len(words)

    def segments(self, text: str | None) -> tuple[list[tuple[float, int, int]], int]:
        """Maximal segments in words, and the number of words."""
        hits, n = self.hits(text)
        return maximal_segments(hits, self.drift), n

    def surprise(self, score: float, n: int) -> float:
        """Negative log of the expected number of segments with at least this total in an innocent text of n words."""
        return self.lam * score - math.log(self.k * max(n, 1))

    def evidence(self, text: str | None) -> float:
        """The surprise of all segments that chance would not bring about."""
        found, n = self.segments(text)
        return sum(max(self.surprise(s, n), 0.0) for s, _, _ in found)

    def score(self, text: str | None) -> float:
        x = self.evidence(text)
        return x / (x + self.scale * (1 - THRESHOLD) / THRESHOLD)


def solve_lambda(histogram: Mapping[float, float]) -> float:
    """The positive root of ``sum p(x) exp(lambda x) = 1`` for the counts of the word scores x."""
    total = sum(histogram.values())
    if sum(x * c for x, c in histogram.items()) >= 0:
        return LEAST_LAMBDA  # scoring words are so common that long segments are no surprise

    def excess(lam: float) -> float:
        return sum(c * math.expm1(lam * x) for x, c in histogram.items()) / total

    lo, hi = LEAST_LAMBDA, 1.0
    while excess(hi) <= 0:
        lo, hi = hi, 2 * hi
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if excess(mid) > 0 else (mid, hi)
    return (lo + hi) / 2


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> DataFrame:
    """(text, toxic) of at most ``limit`` labelled training documents (crc32 of the id mod 4 is not 2)."""
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
              .select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")).distinct()
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id", "toxic").limit(limit))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING, scratch: Scratch | None = None) -> ToxicityModel:
    scratch = scratch or Scratch(docs.sparkSession, "toxicity")
    rows = scratch.cut(training_rows(docs, labels, limit), "training")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel({}, DRIFT, 1.0, 1.0)
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    stems = F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) >= STEM),
                                         lambda w: F.concat(F.substring(w, 1, STEM), F.lit("~"))))
    counts = (rows.select("toxic", F.explode(F.concat(words, stems)).alias("w")).groupBy("w")
              .agg(F.sum("toxic").cast("double").alias("y1"), F.sum(1 - F.col("toxic")).cast("double").alias("y0")))
    y1, y0 = F.col("y1"), F.col("y0")
    a = F.lit(PRIOR) * (y1 + y0) / float(n1 + n0)
    odds = lambda y, n: F.log((y + a) / (n + PRIOR - y - a))
    weighed = counts.withColumn("weight", odds(y1, float(n1)) - odds(y0, float(n0))).withColumn(
        "z", F.col("weight") / F.sqrt(1 / (y1 + a) + 1 / (y0 + a)))
    top = weighed.where((F.col("z") >= MIN_Z) & (F.col("weight") >= MIN_WEIGHT)).select("w", "weight")
    weights = {r["w"]: float(r["weight"]) for r in top.collect()}
    model = ToxicityModel(weights, DRIFT, 1.0, 1.0)
    smallest = min(weights.values(), default=MIN_WEIGHT) - DRIFT

    # The histogram of the word scores of innocent texts: one row for each weight that occurs.
    def observe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter[float] = Counter()
            for text in b["text"]:
                hits, n = model.hits(text)
                seen.update(x - DRIFT for _, x in hits)
                seen[-DRIFT] += n - len(hits)
            yield pd.DataFrame({"x": list(seen.keys()), "n": list(seen.values())})

    innocent = rows.where("toxic = 0").select("text")
    histogram = {r["x"]: float(r["n"]) for r in innocent.mapInPandas(observe, "x double, n long").groupBy("x").agg(
        F.sum("n").alias("n")).collect() if r["n"]}
    histogram[smallest] = histogram.get(smallest, 0.0) + 0.5
    histogram.setdefault(-DRIFT, 1.0)
    lam = solve_lambda(histogram)

    # K: texts with a segment, over the sum of n exp(-lambda best).
    def bests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text in b["text"]:
                found, n = model.segments(text)
                out.append((int(bool(found)), n * math.exp(-lam * max((s for s, _, _ in found), default=smallest))))
            yield pd.DataFrame(out, columns=["has", "weight"])

    stat = innocent.mapInPandas(bests, "has long, weight double").agg(F.sum("has").alias("has"), F.sum("weight").alias("weight")).first()
    k = ((stat["has"] or 0) + 0.5) / ((stat["weight"] or 0.0) + math.exp(-lam * smallest))
    calibrated = ToxicityModel(weights, DRIFT, lam, k)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [calibrated.evidence(t) for t in b["text"]], "toxic": b["toxic"]})

    # At most ``limit`` pairs of numbers.
    pairs = sorted((r["x"], r["toxic"]) for r in rows.mapInPandas(weigh, "x double, toxic int").collect())
    errors = best = sum(t == 0 for x, t in pairs if x > 0) + sum(t for x, t in pairs if x <= 0)
    scale, i = None, 0
    pairs = [p for p in pairs if p[0] > 0]
    while i < len(pairs):  # the cut goes up through the distinct values
        x = pairs[i][0]
        while i < len(pairs) and pairs[i][0] == x:
            errors += 1 if pairs[i][1] else -1
            i += 1
        if errors < best and i < len(pairs):
            best, scale = errors, (x + pairs[i][0]) / 2
    scale = scale if scale is not None else (pairs[0][0] if pairs else 3.0)
    return ToxicityModel(weights, DRIFT, lam, k, scale)


def with_score(docs: DataFrame, model: ToxicityModel, column: str, text: str = "text") -> DataFrame:
    """``docs`` and one more column, 0 to 1.  Narrow: only the text goes through Python."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter(map(model.score, texts), float, len(texts)))

    return docs.withColumn(column, score(F.col(text)))
