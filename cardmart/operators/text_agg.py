"""Corpus-level text operators: extractive summaries and per-group insights.

All three are joins and aggregates over exploded sentences / words:

* document frequency of a word -> ``groupBy(word)`` with map-side partial
  aggregation (a very common word is combined per map task before the shuffle);
* sentence score = mean IDF of its words -> the frequent words' document
  frequencies (a counted number of them) are broadcast, words of one text need
  no table, and only what is between goes through a join (``with_idf``);
* top-n sentences / terms per text or group -> ``row_number() <= n``, which
  Catalyst turns into a partial ``WindowGroupLimit`` before the shuffle, so a
  group holding a third of all rows still reaches its reducer as n rows per
  map task.

No group is ever collected whole: only the n winners per group are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardmart.functions.text import STOPWORDS, words
from cardmart.session import checkpoint_root

# A sentence ends at a run of blanks that follows '.', '!' or '?' (explicit blank class:
# '\s' is not the same set in every regex engine).
SENTENCE_SPLIT = r"(?<=[.!?])[ \t\n\x0B\f\r]+"
# Scores are rounded before ranking so that mathematically equal averages tie exactly
# (whatever the summation order of the shuffle) and fall to the positional tie-break.
SCORE_DIGITS = 9
# Words whose document frequency is broadcast: about 10 MB.
FREQUENT_WORDS = 250_000
# Words ignored when naming a group's recurring terms: function words of the four
# languages plus anything shorter than three letters.
_TERM_STOP = sorted({w for ws in STOPWORDS.values() for w in ws})


def sentences(df: DataFrame, keys: str | list[str], text_col: str) -> DataFrame:
    """(keys, pos, sentence) for every non-blank sentence."""
    keys = [keys] if isinstance(keys, str) else keys
    s = df.select(*keys, F.posexplode(F.split(F.col(text_col), SENTENCE_SPLIT))
                  .alias("pos", "sentence"))
    return s.filter(F.length(F.trim("sentence")) > 0)


def idf_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, idf) with idf = ln(N / document frequency)."""
    dw = docs.select(id_col, F.explode(F.array_distinct(words(text_col))).alias("word"))
    df_ = dw.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.select(id_col).count()  # a scalar
    return df_.select("word", F.log(F.lit(float(max(n_docs, 1))) / F.col("df")).alias("idf"))


def repeated_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, df) of the words that two texts or more hold, written once below the checkpoint folder.

    Words of one text alone (most of a large vocabulary) need no row: their df is 1.
    """
    found = (docs.select(F.explode(F.array_distinct(words(text_col))).alias("word")).groupBy("word")
             .agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1))
    path = f"{checkpoint_root(docs.sparkSession).rstrip('/')}/word-df/{uuid.uuid4().hex}"
    found.write.parquet(path)
    return docs.sparkSession.read.schema("word string, df long").parquet(path)


def frequent_from(df_table: DataFrame, max_words: int) -> int:
    """The smallest power of two such that at most ``max_words`` words have that df or more (one count a power)."""
    power = F.length(F.bin("df")) - 1  # in integers
    held, least = 0, 62
    for b, n in sorted(((r["b"], r["n"]) for r in df_table.groupBy(power.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True):
        held += n
        if held > max_words:
            return 2 ** least
        least = b
    return 2


def with_idf(exploded: DataFrame, docs: DataFrame, text_col: str, max_words: int = FREQUENT_WORDS) -> DataFrame:
    """``exploded`` (a row a word, NULL where a text has none) with the word's ``idf`` over ``docs``.

    The most frequent words, at most ``max_words`` of them by a count, are broadcast, so that nearly all rows get
    their IDF where they are.  Only if other words repeat too do the rows without one go through a join.
    A word of neither table stands in one text: its IDF is ln(N).
    """
    table = repeated_words(docs, text_col)
    n_docs = float(max(docs.count(), 1))
    idf = F.log(F.lit(n_docs) / F.coalesce(F.col("df"), F.lit(1)))
    least = frequent_from(table, max_words)
    near = exploded.join(F.broadcast(table.where(F.col("df") >= least)), "word", "left")
    if least > 2:
        known = F.col("df").isNotNull() | F.col("word").isNull()
        rare = near.where(~known).drop("df").join(table.where(F.col("df") < least), "word", "left")
        near = near.where(known).unionByName(rare)
    return near.withColumn("idf", F.when(F.col("word").isNotNull(), idf)).drop("df")


def sentence_scores(df: DataFrame, keys: list[str], id_col: str, text_col: str, max_words: int = FREQUENT_WORDS) -> DataFrame:
    """(``keys``, pos, score): mean IDF of each sentence's words, 0 without words.

    Words meet their IDF before any exchange (``with_idf``), so the exchange holds one sum a sentence.
    """
    sent = sentences(df.select(*keys, text_col), keys, text_col)
    w = sent.select(*keys, "pos", F.explode_outer(words("sentence")).alias("word"))
    return (with_idf(w, df, text_col, max_words).groupBy(*keys, "pos")
            .agg(F.coalesce(F.round(F.avg("idf"), SCORE_DIGITS), F.lit(0.0)).alias("score")))


def sentence_at(text_col: str, pos) -> Column:
    """The sentence of a text at a position that ``sentences`` gave."""
    return F.get(F.split(F.col(text_col), SENTENCE_SPLIT), pos)


def summarize(df: DataFrame, id_col: str, text_col: str, n_sentences: int = 2) -> DataFrame:
    """Per text, its ``n_sentences`` best sentences by mean IDF, in text order.

    Positions are ranked; the text meets its few winning positions afterwards and cuts them out itself.
    """
    scored = sentence_scores(df, [id_col], id_col, text_col)
    w = Window.partitionBy(id_col).orderBy(F.col("score").desc(), F.col("pos"))
    top = (scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_sentences)
           .groupBy(id_col).agg(F.array_sort(F.collect_list("pos")).alias("_best")))
    return df.select(id_col, text_col).join(top, id_col, "left").select(
        id_col, F.array_join(F.transform("_best", lambda p: sentence_at(text_col, p)), " ").alias("summary"))


def summarize_groups(df: DataFrame, group_col: str, id_col: str, text_col: str,
                     n_sentences: int = 3) -> DataFrame:
    """One summary per group -- the group's best sentences across all its texts.

    (group, id, position) are ranked, partially before the exchange; only the texts of the winners are fetched.
    """
    scored = sentence_scores(df, [group_col, id_col], id_col, text_col)
    w = Window.partitionBy(group_col).orderBy(F.col("score").desc(), F.col(id_col), F.col("pos"))
    top = scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_sentences).select(group_col, id_col, "pos", "_r")
    fetched = top.join(df.select(id_col, text_col), id_col).withColumn("sentence", sentence_at(text_col, F.col("pos")))
    summary = fetched.groupBy(group_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "sentence"))),
                                 lambda x: x["sentence"]), " ").alias("category_summary"))
    counts = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(summary, group_col, "left").orderBy(F.col("n").desc(), group_col)


def group_terms(df: DataFrame, group_col: str, text_col: str, instruction: str, n_terms: int = 3) -> DataFrame:
    """T11 with an instruction: (group, terms), the words of each group that answer the instruction.

    Candidates are the instruction's words and the company they keep in the corpus (``operators.instruct``);
    in a group they rank by weight times class-based TF-IDF, tf(w, group) * ln(1 + mean group size / f(w)).
    """
    from cardmart.operators.instruct import expansion, instruction_terms
    weights = expansion(df, text_col, instruction_terms(instruction))
    if not weights:
        return df.select(group_col).distinct().withColumn("terms", F.lit(None).cast("string"))
    table = F.create_map(*[F.lit(x) for w, v in weights.items() for x in (w, float(v))])
    counted = (df.select(group_col, F.explode(words(text_col)).alias("word")).groupBy(group_col, "word")
               .agg(F.count(F.lit(1)).cast("double").alias("tf")))
    total, groups = counted.agg(F.sum("tf"), F.countDistinct(F.struct(group_col))).first()
    hits = counted.filter(F.col("word").isin(*weights))
    f = hits.groupBy("word").agg(F.sum("tf").alias("f"))
    size = float(total or 0) / max(1, groups or 0)
    scored = hits.join(f, "word").withColumn("score", F.round(
        F.element_at(table, F.col("word")) * F.col("tf") * F.log(1 + F.lit(size) / F.col("f")), 6))
    w = Window.partitionBy(group_col).orderBy(F.col("score").desc(), F.col("word"))
    top = (scored.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_terms).groupBy(group_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "word"))), lambda x: x["word"]), ", ").alias("terms")))
    return df.select(group_col).distinct().join(top, group_col, "left")


def group_insight(df: DataFrame, group_col: str, text_col: str, category_col: str,
                  id_col: str, min_rows: int = 3, top: int = 10, n_terms: int = 3) -> DataFrame:
    """One insight string per group: size, most common category (ties -> first by
    name), recurring terms (count desc, word asc) and a representative text (highest
    mean IDF, ties -> larger id); groups with at least ``min_rows`` rows, the ``top``
    largest (count desc, group asc)."""
    base = df.select(group_col, text_col, category_col, id_col)
    whole = base
    # The groups that are reported are known from their counts; only their texts are taken apart.
    counts = (base.groupBy(group_col).agg(F.count(F.lit(1)).alias("dispute_count"))
              .filter(F.col("dispute_count") >= min_rows).orderBy(F.col("dispute_count").desc(), group_col).limit(top))
    base = base.join(F.broadcast(counts.select(group_col)), group_col, "left_semi")  # ``top`` rows
    per_cat = base.groupBy(group_col, category_col).agg(F.count(F.lit(1)).alias("_n"))
    top_cat = per_cat.groupBy(group_col).agg(
        F.min_by(category_col, F.struct((-F.col("_n")).alias("_neg"), F.col(category_col)))
        .alias("top_category"))
    terms = (base.select(group_col, F.explode(words(text_col)).alias("word"))
             .filter((F.length("word") >= 3) & ~F.col("word").isin(*_TERM_STOP))
             .groupBy(group_col, "word").agg(F.count(F.lit(1)).alias("tf")))
    wt = Window.partitionBy(group_col).orderBy(F.col("tf").desc(), F.col("word"))
    top_terms = (terms.withColumn("_r", F.row_number().over(wt)).filter(F.col("_r") <= n_terms)
                 .groupBy(group_col).agg(F.array_join(F.transform(
                     F.array_sort(F.collect_list(F.struct("_r", "word"))), lambda x: x["word"]),
                     ", ").alias("terms")))
    # representative text: score every text by the mean IDF of its words, carrying only
    # (id, group, word) through the shuffle; the text itself is joined back for the
    # single winner of each group.
    idf = idf_table(whole, id_col, text_col)
    doc_score = (base.select(id_col, group_col, F.explode(words(text_col)).alias("word"))
                 .join(idf, "word").groupBy(id_col, group_col)
                 .agg(F.round(F.avg("idf"), SCORE_DIGITS).alias("score")))
    best = doc_score.groupBy(group_col).agg(
        F.max_by(id_col, F.struct("score", F.col(id_col))).alias(id_col))
    rep = best.join(base.select(id_col, group_col, F.col(text_col).alias("rep")),
                    [id_col, group_col]).select(group_col, "rep")
    out = (counts.join(top_cat, group_col, "left").join(top_terms, group_col, "left")
           .join(rep, group_col, "left"))
    insight = F.format_string(
        "%d disputes; most common problem: %s; recurring terms: %s. Representative memo: %s",
        F.col("dispute_count"), F.col("top_category"), F.coalesce("terms", F.lit("-")),
        F.coalesce("rep", F.lit("-")))
    return (out.select(group_col, "dispute_count", insight.alias("merchant_dispute_insight"))
            .orderBy(F.col("dispute_count").desc(), group_col).limit(top))
