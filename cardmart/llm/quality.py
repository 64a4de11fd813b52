"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of a text are compared with those of its language:

* characters by class: space, digit, A-Z, sentence mark, symbol, code points outside ASCII, other;
* words: one bin for each common word of the language, one for all other words.

The reference of a language is the sum of the histograms of all its documents, null being a language
too.  Languages with less than one in ``SHARE`` of all documents (so all but ``SHARE`` of them) have the
character histogram of the whole table as their reference, and none for words.
The measure is the Jensen-Shannon distance (base 2, 0 to 1).  A document whose
distance exceeds the limit of a histogram is rejected; a histogram is looked at
only when the text is long enough for it (``min_chars``, ``min_words``).

Rows are judged by themselves: repeated rows get equal results, ties cannot
arise.  Null or empty text: no words, so the base rule rejects it.  Words are
compared in languages with a word list, characters in all.  An empty table gives
no rows.  Extra columns are kept and may have any name; those added here are
within one struct, ``QUALITY``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardmart.llm.common import WORD, Scratch, plain

QUALITY = "__cm_quality"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MARKS = "[.,;:!?]"
WIDE = r"[^\x00-\x7F]"
#: Runs of characters that no class counts singly (spelled out: Java tests such a class by one table).
COUNTED_GAPS = "[^#*$%&|<>.,;:!?0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ]+"
#: Common words looked for, by language (a parameter; frequencies come from the corpus).
COMMON_WORDS = {
    "en": "the of and to in is that for".split(),
    "de": "der die das und ein mit ist nicht".split(),
    "fr": "le la les de des et un en".split(),
    "es": "el la los de que y en un".split(),
}
#: A language with at least one in so many documents has a reference of its own.
SHARE = 1000
SLOTS = max(map(len, COMMON_WORDS.values()))
CLASSES = ("space", "digit", "upper", "mark", "symbol", "wide", "other")
#: Largest distances of accepted texts, and the lengths from which they count.
MAX_CLASS_DISTANCE, MIN_CHARS = 0.3, 200
MAX_WORD_DISTANCE, MIN_WORDS = 0.215, 100


def _common_array(language: Column, common: dict[str, list[str]]) -> Column:
    out = F.lit(None).cast("array<string>")
    for lang, words in common.items():
        out = F.when(language == lang, F.array(*map(F.lit, words))).otherwise(out)
    return out


def with_features(docs: DataFrame, common: dict[str, list[str]] = COMMON_WORDS,
                  text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` and a struct of counts.  Narrow: no shuffle, every text is read once."""
    t = F.coalesce(F.col(text), F.lit(""))
    q = "__cm_q_"
    df = docs.withColumns({
        q + "words": F.array_remove(F.split(t, SPACES), ""),
        # What remains of the text when letters, spaces and all else that is not counted singly have gone.
        q + "rest": F.array_join(F.split(t, COUNTED_GAPS), ""),
        q + "lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))})
    w = F.col(q + "words")
    joined = F.concat(F.lit(" "), F.array_join(w, "  "), F.lit(" "))  # two spaces for each word
    df = df.withColumns({
        q + "n": F.size(w).cast("long"),
        q + "wc": F.when(F.size(w) > 0, F.length(joined) - 2 * F.size(w)).otherwise(0).cast("long"),
        # Hashes of the windows of three words; two windows are equal if their hashes are.
        q + "h": F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))),
        # All words in lower case, each between two spaces of its own.
        q + "low": F.lower(joined)})
    h = F.col(q + "h")
    df = df.withColumn(q + "s", F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(
        F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col(q + "s")
    same = lambda x, i: (F.get(s, i - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, i + 1)["h"].eqNullSafe(x["h"]))
    covered = F.array_distinct(F.flatten(F.transform(
        F.filter(s, same), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    lines, low = F.col(q + "lines"), F.col(q + "low")
    n_chars = F.length(t).cast("long")
    count = lambda pattern: F.regexp_count(q + "rest", F.lit(pattern)).cast("long")
    slots = []
    listed = _common_array(F.col(lang), common)
    for k in range(SLOTS):
        word = F.concat(F.lit(" "), F.get(listed, F.lit(k)), F.lit(" "))
        removed = F.octet_length(low) - F.octet_length(F.replace(low, word, F.lit("")))
        slots.append(F.coalesce((removed / F.octet_length(word)).cast("long"), F.lit(0).cast("long")))
    counts = {"n_symbols": count(SYMBOLS), "digit": count("[0-9]"), "upper": count("[A-Z]"), "mark": count(MARKS),
              "wide": F.when(F.octet_length(t) > F.length(t), F.regexp_count(t, F.lit(WIDE)).cast("long")).otherwise(F.lit(0).cast("long"))}
    df = df.withColumns({q + k: v for k, v in counts.items()})
    c = lambda name: F.col(q + name)
    space = n_chars - c("wc")
    classes = [space, c("digit"), c("upper"), c("mark"), c("n_symbols"), c("wide"),
               n_chars - space - c("digit") - c("upper") - c("mark") - c("n_symbols") - c("wide")]
    df = df.withColumn(QUALITY, F.struct(
        F.col(lang).alias("lang"), n_chars.alias("n_chars"), c("n").alias("n_words"), c("wc").alias("word_chars"),
        c("n_symbols").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.size(covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(*classes).alias("classes"), F.array(*slots).alias("common")))
    return df.select(*docs.columns, QUALITY)


def references(features: DataFrame, languages=tuple(COMMON_WORDS), share: int = SHARE) -> DataFrame:
    """At most ``share + 1`` rows: sums over the documents of each language that has one in ``share`` of them, and over all.

    ``r_whole`` marks the row of the whole table; ``r_common`` is null there and in languages without a word list.
    """
    q = F.col(QUALITY)
    total = lambda name, n: F.array(*[F.sum(F.get(q[name], F.lit(k))) for k in range(n)])
    least = features.count() / share
    whole = F.grouping_id() == 1
    sums = (features.withColumn("r_lang", q["lang"]).rollup("r_lang")
            .agg(whole.alias("r_whole"), F.count(F.lit(1)).alias("r_docs"), total("classes", len(CLASSES)).alias("r_classes"),
                 total("common", SLOTS).alias("r_common"), F.sum(q["n_words"]).alias("r_words")))
    listed = ~F.col("r_whole") & F.col("r_lang").isin(*languages)
    return (sums.where(F.col("r_whole") | (F.col("r_docs") >= F.lit(least)))
            .select("r_whole", "r_lang", "r_classes", F.when(listed, F.col("r_common")).alias("r_common"), "r_words"))


def js_distance(p: Column, r: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts (null if either has none)."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    shares = lambda a, n: F.transform(a, lambda v: v / n)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(shares(p, total(p)), shares(r, total(r)),
                       lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    distance = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) / 2))
    return F.when((total(p) > 0) & (total(r) > 0), F.round(distance, 6))


def with_verdict(features: DataFrame, refs: DataFrame, max_class: float = MAX_CLASS_DISTANCE,
                 min_chars: int = MIN_CHARS, max_words: float = MAX_WORD_DISTANCE,
                 min_words: int = MIN_WORDS) -> DataFrame:
    """``features`` with the struct of counts replaced by counts, distances, ``base_failed`` and ``kept``.

    ``refs`` has at most ``SHARE + 1`` rows, so its languages are broadcast; the row of the whole table is fetched.
    """
    whole = refs.where("r_whole").first()
    whole = F.array(*map(F.lit, whole["r_classes"])).cast("array<long>") if whole else F.lit(None).cast("array<long>")
    refs = refs.where(~F.col("r_whole"))
    q = F.col(QUALITY)
    rest = lambda n, ks: F.array_append(ks, F.greatest(
        F.lit(0).cast("long"), n - F.aggregate(ks, F.lit(0).cast("long"), lambda x, y: x + y)))
    df = features.join(F.broadcast(refs), q["lang"].eqNullSafe(F.col("r_lang")), "left").withColumns({
        "__cm_q_class": js_distance(q["classes"], F.coalesce(F.col("r_classes"), whole)),
        "__cm_q_word": js_distance(rest(q["n_words"], q["common"]), rest(F.col("r_words"), F.col("r_common")))})
    by_class, by_word = F.col("__cm_q_class"), F.col("__cm_q_word")
    base = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    bad = ((q["n_chars"] >= min_chars) & (by_class > max_class)) | ((q["n_words"] >= min_words) & (by_word > max_words))
    judged = F.struct(q.alias("counts"), by_class.alias("class_distance"), by_word.alias("word_distance"),
                      base.alias("base_failed"), (~base & ~F.coalesce(bad, F.lit(False))).alias("kept"))
    return df.withColumn(QUALITY, judged).select(*features.columns)


def judge_documents(docs: DataFrame, scratch: Scratch | None = None, **limits) -> DataFrame:
    """All rows of ``docs`` with the struct ``QUALITY`` (counts, distances, base_failed, kept).

    The counts are written once and read twice: for the references and for the verdict.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")

    def judged(named: DataFrame) -> DataFrame:
        features = scratch.cut(with_features(named), "features")
        return with_verdict(features, references(features), **limits)

    return plain(docs, judged)
