"""Answers to a question from the sentences of each text, scored by BM25.

The question's words, without ``stop`` words, are looked for in every sentence.  One aggregate over all
sentences gives the number of sentences, their mean length and, for each word of the question, how many
hold it: as many numbers as the question has words, on the driver.  The second pass is narrow: each text
ranks its own sentences, so nothing is shuffled and no text leaves its row.

The answer is the part of a sentence from the first to the last word of the question in it, or, where
the question asks for an amount, a date, a reason code, a currency or an address, what the sentence has of that form.

NULL text: NULL.  No sentence with a word of the question, or none of the asked form: an empty array.
Equal scores go to the earlier sentence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cardmart.functions.text import DESCRIPTION_STOPWORDS, SLOTS, WORD_PATTERN, slot_for

#: End marks with white space after them (so amounts stay whole), or line ends.
SENTENCE_END = r"[.!?]+(?:[ \t\r\n]+|$)|\n+"
K1, B = 1.2, 0.75
QUESTION_WORDS = ("what", "why", "when", "where", "which", "who", "how", "does", "do", "did", "are", "be", "about", "said", "much")


def sentences(text: str | Column) -> Column:
    """Sentences with at least one word, in order."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.lower(s).rlike(WORD_PATTERN))


def question_terms(question: str, stop: Sequence[str] = (*DESCRIPTION_STOPWORDS, *QUESTION_WORDS)) -> list[str]:
    return [w for w in dict.fromkeys(re.findall(WORD_PATTERN, question.lower())) if w not in set(stop)]


@dataclass(frozen=True)
class Statistics:
    """Sentences, their mean length in words, and of each word the sentences that hold it."""

    n: int
    mean: float
    holding: tuple[int, ...]


def _words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(WORD_PATTERN), F.lit(0))


def statistics(df: DataFrame, text: str, terms: Sequence[str]) -> Statistics:
    s = df.select(F.explode(sentences(text)).alias("s")).select(_words(F.col("s")).alias("w"))
    row = s.agg(F.count(F.lit(1)), F.sum(F.size("w")), *[F.count_if(F.array_contains("w", t)) for t in terms]).first()
    return Statistics(row[0], (row[1] or 0) / row[0] if row[0] else 1.0, tuple(row[2:]))


def idf(n: int, holding: int) -> float:
    return math.log(1 + (n - holding + 0.5) / (holding + 0.5))


def _span(sentence: Column, question: str, terms: Sequence[str]) -> Column:
    slot = slot_for(question)
    if slot is not None:
        return F.nullif(F.regexp_extract(sentence, dict(SLOTS)[slot], 1), F.lit(""))
    one = f"(?<![a-z])(?:{'|'.join(terms)})(?![a-z])"
    return F.regexp_extract(sentence, rf"(?is)({one}(?:.*{one})?)", 1)


def answers(df: DataFrame, text: str, question: str, k: int = 3, out: str = "answers", digits: int = 4) -> DataFrame:
    """``df`` and ``out``: up to ``k`` of ``{answer, score}``, best first."""
    terms = question_terms(question)
    empty = F.array().cast("array<struct<answer:string,score:double>>")
    if not terms:
        return df.withColumn(out, F.when(F.col(text).isNotNull(), empty))
    st = statistics(df, text, terms)

    # Sentences without a word of the question drop out by one pattern; the others are split into words once.
    any_term = f"(?<![a-z])(?:{'|'.join(terms)})(?![a-z])"
    placed = F.transform(sentences(text), lambda s, pos: F.struct(s.alias("s"), pos.alias("pos")))
    hits = F.transform(F.filter(placed, lambda x: F.lower(x["s"]).rlike(any_term)),
                       lambda x: F.struct(x["s"].alias("s"), x["pos"].alias("pos"), _words(x["s"]).alias("w")))

    def scored(x: Column) -> Column:
        length = F.size(x["w"]) / F.lit(st.mean)
        score = None
        for t, n in zip(terms, st.holding):
            tf = F.size(F.filter(x["w"], lambda y: y == t)).cast("double")  # noqa: B023 -- used at once
            part = F.lit(idf(st.n, n)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))
            score = part if score is None else score + part
        return F.struct((-F.round(score, digits)).alias("minus"), x["pos"].alias("pos"), _span(x["s"], question, terms).alias("answer"))

    ranked = F.array_sort(F.filter(F.transform(hits, scored), lambda x: (x["minus"] < 0) & x["answer"].isNotNull()))
    best = F.transform(F.slice(ranked, 1, k), lambda x: F.struct(x["answer"].alias("answer"), (-x["minus"]).alias("score")))
    return df.withColumn(out, best)
