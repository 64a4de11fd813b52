"""Row filter by an instruction in words.

The instruction's content words are its terms.  Sentences that hold a term are its topic, and words
that keep company with it are found by normalised pointwise mutual information over the sentences of the
corpus: ln(p(w, topic) / (p(w) p(topic))) / -ln p(w, topic), 1 for words that occur in the topic alone and
all over it, 0 for unrelated ones.  Up to ``expand`` words of ``min_support`` sentences and ``min_npmi`` join
the terms with that weight.  A text's score is the weight of its distinct words; it is kept if the score is
above the mean of all texts' scores by ``deviations`` standard deviations (and above 0), so the
threshold follows the corpus and the instruction.

One aggregate by word over sentences, and one row of sums; scoring is narrow.  Words are ``[a-z]+`` of the
lower-cased text.  NULL text: NULL score, not kept.  An instruction without content words keeps nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardmart.functions.text import DESCRIPTION_STOPWORDS, words
from cardmart.operators.answers import question_terms, sentences

#: Words by which an instruction addresses the reader, beside the usual stop words.
INSTRUCTION_WORDS = ("this", "that", "it", "text", "texts", "keep", "find", "describes", "mentions", "is", "about", "any", "someone", "as", "where")


def instruction_terms(instruction: str, stop: Sequence[str] = (*DESCRIPTION_STOPWORDS, *INSTRUCTION_WORDS)) -> list[str]:
    return question_terms(instruction, stop)


def expansion(df: DataFrame, text: str, terms: Sequence[str], expand: int = 20, min_support: int = 5,
              min_npmi: float = 0.3) -> dict[str, float]:
    """Weights of the terms (1) and of the words that keep their company; at most ``expand`` of these."""
    s = df.select(F.explode(sentences(text)).alias("s")).select(F.array_distinct(words(F.col("s"))).alias("w"))
    s = s.withColumn("topic", F.arrays_overlap("w", F.array(*map(F.lit, terms))))
    n, n_topic = s.agg(F.count(F.lit(1)), F.count_if("topic")).first()
    if not n_topic:
        return {t: 1.0 for t in terms}
    counted = s.select("topic", F.explode("w").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).cast("double").alias("k"), F.count_if("topic").cast("double").alias("both"))
    npmi = F.when(F.col("both") == n, 1.0).otherwise(
        F.log(F.col("both") * n / (F.col("k") * n_topic)) / -F.log(F.col("both") / n))
    found = (counted.where((F.col("both") >= min_support) & ~F.col("word").isin(*terms)).withColumn("npmi", F.round(npmi, 4))
             .where(F.col("npmi") >= min_npmi).orderBy(F.desc("npmi"), "word").limit(expand).collect())
    return {t: 1.0 for t in terms} | {r["word"]: r["npmi"] for r in found}


def instruction_score(text: str, weights: dict[str, float]) -> Column:
    """Weight of the distinct words of a text."""
    table = F.create_map(*[F.lit(x) for w, v in weights.items() for x in (w, float(v))])
    hits = F.array_intersect(words(text), F.array(*map(F.lit, weights)))
    return F.round(F.aggregate(F.array_sort(hits), F.lit(0.0), lambda a, w: a + F.element_at(table, w)), 4)


def filter_by_instruction(df: DataFrame, text: str, instruction: str, deviations: float = 2.0, score: str = "score", flag: str = "keep",
                          **expand) -> DataFrame:
    """``df`` with a score and whether the instruction keeps the row."""
    terms = instruction_terms(instruction)
    if not terms:
        return df.withColumns({score: F.when(F.col(text).isNotNull(), 0.0), flag: F.lit(False)})
    value = instruction_score(text, expansion(df, text, terms, **expand))
    mean, spread = df.select(value.alias("x")).agg(F.avg("x"), F.stddev_pop("x")).first()
    limit = max(0.0, round((mean or 0.0) + deviations * (spread or 0.0), 6))
    return df.withColumn(score, value).withColumn(flag, F.coalesce(F.col(score) > limit, F.lit(False)))
