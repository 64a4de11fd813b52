"""Lexicon scoring as a DataFrame operator (the scalable form of T01, T04, T07, T09, T14).

Per-row lexicon counting with higher-order functions (``filter(words, w -> w
IN (...))``) runs lambdas interpreted, outside whole-stage codegen.  Here the
words are exploded inside a code-generated stage, matched against the
lexicon with a broadcast hash join -- the lexicon is a fixed list given by
the caller, so its size is known -- and only the *hits* go on: one partial
aggregate per text before the shuffle, at most one row per (text, lexicon)
after it.  Measured on the sf0.1 documents: 3.6 s instead of 13.2 s for the
four-label classification, same predictions.

The column functions in ``cardmart.functions.text`` keep the same rules for
per-row use; both give identical results (tests compare them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardmart.functions.text import keywords_from_labels, words


def lexicon_frame(spark, lexicons: Mapping[str, Sequence[str]]) -> DataFrame:
    rows = [(w, name) for name, ws in lexicons.items() for w in sorted(set(ws))]
    return spark.createDataFrame(rows, "word string, _lex string")


def hit_counts(df: DataFrame, keys: Sequence[str], text_col: str,
               lexicons: Mapping[str, Sequence[str]], carry: Sequence[str] = (),
               with_word_count: bool = False) -> DataFrame:
    """``keys + carry`` plus one column per lexicon with its hit count (0 when none);
    ``n_words`` too when asked.  ``keys`` must identify a row."""
    keys, carry = list(keys), list(carry)
    spark = df.sparkSession
    lex = F.broadcast(lexicon_frame(spark, lexicons))  # fixed, caller-sized list
    exploded = df.select(*keys, F.explode(words(text_col)).alias("word"))
    hits = (exploded.join(lex, "word", "inner").groupBy(*keys)
            .agg(*[F.count_if(F.col("_lex") == name).alias(name) for name in lexicons]))
    base_cols = [*keys, *carry]
    if with_word_count:
        base = df.select(*base_cols, F.size(words(text_col)).alias("n_words"))
    else:
        base = df.select(*base_cols)
    out = base.join(hits, keys, "left")
    return out.fillna(0, subset=list(lexicons))


def argmax_label(hits: Sequence[Column], names: Sequence[str]) -> Column:
    """Label with the most hits; tie -> first in order; no hit -> NULL."""
    best = F.greatest(*hits) if len(hits) > 1 else hits[0]
    out = F.when(best <= 0, F.lit(None).cast("string"))
    for n, h in zip(names, hits):
        out = out.when(h == best, F.lit(n))
    return out


def classify_frame(df: DataFrame, keys: Sequence[str], text_col: str,
                   labels: Sequence[str | Mapping[str, str]], carry: Sequence[str] = (),
                   out_col: str = "predicted",
                   keywords: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """T07 over a DataFrame: ``keys + carry + out_col``."""
    kw = dict(keywords) if keywords is not None else keywords_from_labels(labels)
    names = [lab["label"] if isinstance(lab, Mapping) else lab for lab in labels]
    tmp = {n: f"_h{i}" for i, n in enumerate(names)}
    h = hit_counts(df, keys, text_col, {tmp[n]: kw[n] for n in names}, carry)
    return h.select(*keys, *carry, argmax_label([F.col(tmp[n]) for n in names], names)
                    .alias(out_col))
