"""Text queries over the memos (``documents``) and their evaluation against ``labels`` (T*, A08-A10, A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardmart import constants as K
from cardmart.functions import text as TX
from cardmart.operators import text_agg as TA
from cardmart.operators.evaluate import accuracy, confusion_misses, flag_overlap
from cardmart.operators.lexicon import argmax_label, classify_frame, hit_counts
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.sources import driver_tables as DT

TOKEN_RE = TX.TOKEN_PATTERN
WORDS_SQL = "regexp_extract_all(lower(memo_text), '[a-z]+')"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(set(values)))


def hits_sql(words: str, lexicon) -> str:
    return f"len(list_filter({words}, lambda w: w IN ({_in(lexicon)})))"


# --- T06 / A10 tokens ----------------------------------------------------------------------------

@query("t06_tokens", with_views(f"""
SELECT dispute_id, CAST(len(regexp_extract_all(memo_text, '{TOKEN_RE}')) AS BIGINT) AS n_tokens
FROM dispute_memos""", "dispute_memos"))
def t06(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    return d.select("dispute_id", TX.token_count("memo_text").alias("n_tokens"))


@query("a10_token_stats", with_views(f"""
SELECT CAST(count(*) AS BIGINT) AS memos,
  CAST(sum(n) AS BIGINT) AS total_prompt_tokens, CAST(sum(n) AS DOUBLE) / count(*) AS avg_tokens_per_memo
FROM (SELECT len(regexp_extract_all(memo_text, '{TOKEN_RE}')) AS n FROM dispute_memos)""",
                                      "dispute_memos"))
def a10(spark, sf_dir):
    n = TX.token_count("memo_text")
    d = DT.dispute_memos(spark, sf_dir).select(n.alias("n"))
    return d.agg(F.count(F.lit(1)).alias("memos"),
                 F.sum("n").cast("long").alias("total_prompt_tokens"),
                 (F.sum("n").cast("double") / F.count(F.lit(1))).alias("avg_tokens_per_memo"))


# --- T01 / T02 sentiment -------------------------------------------------------------------------

_SENT_SQL = f"""
CASE WHEN p > n THEN 'positive' WHEN p < n THEN 'negative' WHEN p + n > 0 THEN 'mixed'
     ELSE 'neutral' END"""
_SENT_FROM = f"""(SELECT *, {hits_sql('w', TX.POSITIVE)} AS p, {hits_sql('w', TX.NEGATIVE)} AS n
 FROM (SELECT *, {WORDS_SQL} AS w FROM dispute_memos))"""


@query("t01_sentiment", with_views(f"""
SELECT dispute_id, {_SENT_SQL} AS overall_sentiment FROM {_SENT_FROM}""", "dispute_memos"))
def t01(spark, sf_dir):
    return _sentiment(spark, sf_dir).select("dispute_id", "overall_sentiment")


def _sentiment(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    h = hit_counts(d, ["dispute_id"], "memo_text", {"pos": TX.POSITIVE, "neg": TX.NEGATIVE})
    return h.withColumn("overall_sentiment", TX.sentiment_rule(F.col("pos"), F.col("neg")))


@query("t02_sentiment_dist", with_views(f"""
SELECT {_SENT_SQL} AS sentiment, CAST(count(*) AS BIGINT) AS memos FROM {_SENT_FROM}
GROUP BY 1 ORDER BY memos DESC""", "dispute_memos"))
def t02(spark, sf_dir):
    s = _sentiment(spark, sf_dir)
    return (s.groupBy(F.col("overall_sentiment").alias("sentiment"))
            .agg(F.count(F.lit(1)).alias("memos")).orderBy(F.col("memos").desc()))


# --- T03 / T04 -----------------------------------------------------------------------------------

def _scored_sentences_sql() -> str:
    """(dispute_id, pos, s, score): every non-blank sentence of every memo with its
    mean corpus IDF rounded to 9 digits (the oracle twin of text_agg.sentence_scores)."""
    blank = "[ \\t\\n\\x0B\\f\\r]+"
    parts = f"""(
          SELECT dispute_id, parts, unnest(generate_series(0, len(parts) - 1)) AS pos FROM (
            SELECT dispute_id, string_split(regexp_replace(memo_text, '([.!?]){blank}', '\\1' || chr(1), 'g'),
                                            chr(1)) AS parts FROM dispute_memos))"""
    return f"""(
    SELECT st.dispute_id, st.pos, st.s, coalesce(sc.score, 0.0) AS score FROM (
      SELECT dispute_id, pos, parts[pos + 1] AS s FROM {parts}
      WHERE length(trim(parts[pos + 1])) > 0) st
    LEFT JOIN (
      SELECT dispute_id, pos, round(avg(idf), 9) AS score FROM (
        SELECT dispute_id, pos, unnest(regexp_extract_all(lower(parts[pos + 1]), '[a-z]+')) AS word
        FROM {parts}) sw
      JOIN (
        SELECT word, ln((SELECT CAST(count(*) AS DOUBLE) FROM dispute_memos) / count(*)) AS idf FROM (
          SELECT DISTINCT dispute_id, unnest(regexp_extract_all(lower(memo_text), '[a-z]+')) AS word
          FROM dispute_memos) GROUP BY word) idf USING (word)
      GROUP BY dispute_id, pos) sc
    ON st.dispute_id = sc.dispute_id AND st.pos = sc.pos)"""


def _summary_sql(n_sentences: int) -> str:
    return f"""
SELECT m.dispute_id, t.summary FROM dispute_memos m LEFT JOIN (
  SELECT dispute_id, string_agg(s, ' ' ORDER BY pos) AS summary FROM (
    SELECT *, row_number() OVER (PARTITION BY dispute_id ORDER BY score DESC, pos) AS r
    FROM {_scored_sentences_sql()})
  WHERE r <= {n_sentences} GROUP BY dispute_id) t ON m.dispute_id = t.dispute_id"""


def _group_summary_sql(n_sentences: int) -> str:
    return f"""
SELECT c.dispute_category, c.n, t.category_summary FROM (
  SELECT dispute_category, CAST(count(*) AS BIGINT) AS n FROM dispute_memos GROUP BY 1) c
LEFT JOIN (
  SELECT dispute_category, string_agg(s, ' ' ORDER BY r) AS category_summary FROM (
    SELECT m.dispute_category, x.s,
      row_number() OVER (PARTITION BY m.dispute_category ORDER BY x.score DESC, x.dispute_id, x.pos) AS r
    FROM {_scored_sentences_sql()} x JOIN dispute_memos m ON x.dispute_id = m.dispute_id)
  WHERE r <= {n_sentences} GROUP BY dispute_category) t ON c.dispute_category = t.dispute_category"""


@query("t03_summary", with_views(_summary_sql(2), "dispute_memos"))
def t03(spark, sf_dir):
    """Extractive one-text summary: top-2 sentences by corpus TF-IDF, in text order."""
    d = DT.dispute_memos(spark, sf_dir)
    return TA.summarize(d, "dispute_id", "memo_text", n_sentences=2)


_LANG_CASE = "CASE WHEN best <= 0 THEN NULL " + " ".join(
    f"WHEN h_{l} = best THEN '{l}'" for l in TX.LANGS) + " END"


@query("t04_detect_lang", f"""
SELECT doc_id, lang, {_LANG_CASE} AS detected_lang FROM (
  SELECT *, greatest({', '.join('h_' + l for l in TX.LANGS)}) AS best FROM (
    SELECT doc_id, lang, {', '.join(hits_sql('w', TX.STOPWORDS[l]) + ' AS h_' + l for l in TX.LANGS)}
    FROM (SELECT doc_id, lang, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents)))""")
def t04_detect(spark, sf_dir):
    d = DT.read(spark, sf_dir, "documents")
    h = hit_counts(d, ["doc_id"], "text", {lang: TX.STOPWORDS[lang] for lang in TX.LANGS},
                   carry=["lang"])
    pred = argmax_label([F.col(lang) for lang in TX.LANGS], TX.LANGS)
    return h.select("doc_id", "lang", pred.alias("detected_lang"))


def _translate_sql() -> str:
    gl = TX.GLOSSARY[("en", "es")]
    mp = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in sorted(gl.items())) + "}"
    hits = ", ".join(hits_sql('w', TX.STOPWORDS[l]) + ' AS h_' + l for l in TX.LANGS)
    return f"""
SELECT dispute_id, memo_text AS original,
  CASE WHEN detected = 'en' THEN array_to_string(list_transform(string_split_regex(memo_text, '\\s+'),
         lambda p: coalesce({mp}[lower(p)], p)), ' ') ELSE memo_text END AS translated_es
FROM (SELECT dispute_id, memo_text, {_LANG_CASE} AS detected FROM (
  SELECT *, greatest({', '.join('h_' + l for l in TX.LANGS)}) AS best FROM (
    SELECT dispute_id, memo_text, {hits} FROM (
      SELECT dispute_id, memo_text, {WORDS_SQL} AS w FROM dispute_memos))))"""


@query("t04_translate", with_views(_translate_sql(), "dispute_memos"))
def t04_translate(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    return d.select("dispute_id", F.col("memo_text").alias("original"),
                    TX.translate("memo_text", "", "es").alias("translated_es"))


# --- T05 extraction ------------------------------------------------------------------------------

_AMT = dict(TX.SLOTS)["amount"]
_RSN = dict(TX.SLOTS)["reason"]


@query("t05_extract", with_views(f"""
SELECT dispute_id, nullif(regexp_extract(memo_text, '{_AMT}', 1), '') AS disputed_amount,
  nullif(regexp_extract(memo_text, '{_RSN}', 1), '') AS extracted_reason
FROM dispute_memos""", "dispute_memos"))
def t05(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    return d.select("dispute_id",
                    TX.top_answer("memo_text", "What is the disputed amount?").alias("disputed_amount"),
                    TX.top_answer("memo_text", "Why is the cardholder disputing?")
                    .alias("extracted_reason"))


# --- T07 / T08 / A08 / A09 classification and its evaluation -------------------------------------

LABELS = K.DISPUTE_CATEGORIES


def _classify_sql() -> str:
    kw = TX.keywords_from_labels(LABELS)
    hs = ", ".join(f"{hits_sql('w', kw[l])} AS h{i}" for i, l in enumerate(LABELS))
    best = "greatest(" + ", ".join(f"h{i}" for i in range(len(LABELS))) + ")"
    case = "CASE WHEN best <= 0 THEN NULL " + " ".join(
        f"WHEN h{i} = best THEN '{l}'" for i, l in enumerate(LABELS)) + " END"
    return f"""(SELECT dispute_id, dispute_category AS actual_category, {case} AS predicted_category
  FROM (SELECT *, {best} AS best FROM (
    SELECT dispute_id, dispute_category, {hs} FROM (
      SELECT dispute_id, dispute_category, {WORDS_SQL} AS w FROM dispute_memos))))"""


PRED_SQL = _classify_sql()


def predictions(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    p = classify_frame(d, ["dispute_id"], "memo_text", LABELS, carry=["dispute_category"],
                       out_col="predicted_category")
    return p.select("dispute_id", F.col("dispute_category").alias("actual_category"),
                    "predicted_category")


@query("t07_classify", with_views(f"SELECT * FROM {PRED_SQL}", "dispute_memos"))
def t07(spark, sf_dir):
    return predictions(spark, sf_dir)


@query("a08_accuracy", with_views(f"""
SELECT n, correct, ((2000 * correct + n) // (2 * n)) / 10.0 AS accuracy_pct FROM (
  SELECT CAST(count(*) AS BIGINT) AS n,
    CAST(count(*) FILTER (WHERE predicted_category = actual_category) AS BIGINT) AS correct
  FROM {PRED_SQL})""", "dispute_memos"))
def a08(spark, sf_dir):
    return accuracy(predictions(spark, sf_dir), "actual_category", "predicted_category")


@query("a09_confusion", with_views(f"""
SELECT actual_category, predicted_category, CAST(count(*) AS BIGINT) AS misses
FROM {PRED_SQL} WHERE predicted_category <> actual_category
GROUP BY 1, 2 ORDER BY misses DESC""", "dispute_memos"))
def a09(spark, sf_dir):
    return confusion_misses(predictions(spark, sf_dir), "actual_category", "predicted_category")


@query("a09_confusion_matrix", with_views(f"""
SELECT actual_category, {', '.join(f"CAST(count(*) FILTER (WHERE predicted_category = '{l}') AS BIGINT) AS {l}" for l in K.DISPUTE_CATEGORIES)}
FROM {PRED_SQL} GROUP BY actual_category""", "dispute_memos"))
def a09_matrix(spark, sf_dir):
    """Full confusion matrix (pivot with the known label list: no discovery pass)."""
    from cardmart.operators.evaluate import confusion_matrix
    return confusion_matrix(predictions(spark, sf_dir), "actual_category", "predicted_category",
                            K.DISPUTE_CATEGORIES)


# Classification with described labels, scored against a real ground truth: the
# document language.  Each label's description supplies its keywords.
LANG_LABELS = [{"label": lang, "description": " ".join(TX.STOPWORDS[lang])} for lang in TX.LANGS]
_LANG_KW = TX.keywords_from_labels(LANG_LABELS)


def _lang_pred_sql() -> str:
    hs = ", ".join(f"{hits_sql('w', _LANG_KW[l['label']])} AS h{i}" for i, l in enumerate(LANG_LABELS))
    best = "greatest(" + ", ".join(f"h{i}" for i in range(len(LANG_LABELS))) + ")"
    case = "CASE WHEN best <= 0 THEN NULL " + " ".join(
        f"WHEN h{i} = best THEN '{l['label']}'" for i, l in enumerate(LANG_LABELS)) + " END"
    return f"""(SELECT doc_id, lang AS actual, {case} AS predicted FROM (
  SELECT *, {best} AS best FROM (SELECT doc_id, lang, {hs} FROM (
    SELECT doc_id, lang, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents))))"""


LANG_PRED_SQL = _lang_pred_sql()


def lang_predictions(spark, sf_dir):
    d = DT.read(spark, sf_dir, "documents")
    p = classify_frame(d, ["doc_id"], "text", LANG_LABELS, carry=["lang"])
    return p.select("doc_id", F.col("lang").alias("actual"), "predicted")


@query("t07_classify_described", f"SELECT * FROM {LANG_PRED_SQL}")
def t07_described(spark, sf_dir):
    return lang_predictions(spark, sf_dir)


@query("a08_accuracy_described", f"""
SELECT n, correct, ((2000 * correct + n) // (2 * n)) / 10.0 AS accuracy_pct FROM (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE predicted = actual) AS BIGINT) AS correct
  FROM {LANG_PRED_SQL})""")
def a08_described(spark, sf_dir):
    return accuracy(lang_predictions(spark, sf_dir), "actual", "predicted")


@query("a09_confusion_described", f"""
SELECT actual, predicted, CAST(count(*) AS BIGINT) AS misses FROM {LANG_PRED_SQL}
WHERE predicted <> actual GROUP BY 1, 2""")
def a09_described(spark, sf_dir):
    return confusion_misses(lang_predictions(spark, sf_dir), "actual", "predicted")


# FIXED VALUES: insult vocabulary of the toxicity rule.
TOXIC_TERMS = ["trash", "idiot", "scum", "clown", "worthless", "moron", "pathetic", "loser",
               "disgusting", "stupid"]
SYMBOL_RE = r"[^A-Za-z0-9 \t\n\r]"
CAPS_RE = r"[A-Z]{2,}"


def _eval_frame(spark, sf_dir):
    """Rule predictions for the labelled documents: toxic by insult words; low quality
    by symbol-heavy or shouting text."""
    d = DT.read(spark, sf_dir, "documents")
    lab = DT.read(spark, sf_dir, "labels")
    n_tok = F.greatest(F.size(TX.tokens("text")), F.lit(1)).cast("double")
    n_sym = F.size(F.regexp_extract_all("text", F.lit(SYMBOL_RE), 0)).cast("double")
    n_alpha = F.greatest(F.size(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), 0)), F.lit(1))
    n_caps = F.size(F.regexp_extract_all("text", F.lit(CAPS_RE), 0)).cast("double")
    low_q = (n_sym / n_tok > 0.45) | (n_caps / n_alpha.cast("double") > 0.1)
    labelled = lab.join(d, "doc_id").select(
        "doc_id", "quality", "toxic", "text", F.when(low_q, 0).otherwise(1).alias("quality_pred"))
    h = hit_counts(labelled, ["doc_id"], "text", {"tox": TOXIC_TERMS},
                   carry=["quality", "toxic", "quality_pred"])
    return h.select("doc_id", "quality", "toxic", "quality_pred",
                    F.when(F.col("tox") > 0, 1).otherwise(0).alias("toxic_pred"))


@query("t08_eval", f"""
SELECT task, n, correct, ((2000 * correct + n) // (2 * n)) / 10.0 AS accuracy_pct FROM (
SELECT task, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE pred = actual) AS BIGINT) AS correct
FROM (
  SELECT 'toxic' AS task, toxic AS actual, toxic_pred AS pred FROM ev
  UNION ALL SELECT 'quality', quality, quality_pred FROM ev)
GROUP BY task""".replace("FROM ev", f"""FROM (
    SELECT l.doc_id, quality, toxic,
      CASE WHEN {hits_sql("regexp_extract_all(lower(text), '[a-z]+')", TOXIC_TERMS)} > 0 THEN 1 ELSE 0 END AS toxic_pred,
      CASE WHEN len(regexp_extract_all(text, '{SYMBOL_RE}')) / greatest(len(regexp_extract_all(text, '{TOKEN_RE}')), 1) > 0.45
             OR len(regexp_extract_all(text, '{CAPS_RE}')) / greatest(len(regexp_extract_all(text, '[A-Za-z]+')), 1) > 0.1
           THEN 0 ELSE 1 END AS quality_pred
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id) ev""") + ")")
def t08(spark, sf_dir):
    """Evaluation loop on ground truth: accuracy of the toxicity and quality rules."""
    ev = _eval_frame(spark, sf_dir)
    tox = ev.select(F.lit("toxic").alias("task"), F.col("toxic").alias("actual"),
                    F.col("toxic_pred").alias("pred"))
    qual = ev.select(F.lit("quality").alias("task"), F.col("quality").alias("actual"),
                     F.col("quality_pred").alias("pred"))
    return accuracy(tox.unionByName(qual), "actual", "pred", group_by=["task"])


@query("t08_confusion", f"""
SELECT actual, pred, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT toxic AS actual,
    CASE WHEN {hits_sql("regexp_extract_all(lower(text), '[a-z]+')", TOXIC_TERMS)} > 0 THEN 1 ELSE 0 END AS pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id) GROUP BY 1, 2""")
def t08_confusion(spark, sf_dir):
    """Full 2x2 confusion matrix of the toxicity rule."""
    ev = _eval_frame(spark, sf_dir)
    return (ev.groupBy(F.col("toxic").alias("actual"), F.col("toxic_pred").alias("pred"))
            .agg(F.count(F.lit(1)).alias("n")))


# --- T09 / A13 filter ---------------------------------------------------------------------------

FILTER_TEMPLATE = K.FILTER_PROMPT
FILTER_TERMS = TX.terms_for(FILTER_TEMPLATE)
_FILTER_SQL = f"""
(SELECT *, CASE WHEN len(pw) > 0 THEN {hits_sql('pw', FILTER_TERMS)} / len(pw) >= 0.001 ELSE false END AS flagged
 FROM (SELECT *, {WORDS_SQL} AS pw FROM dispute_memos))"""


def _flagged(spark, sf_dir):
    """The filter's instruction (FILTER_TEMPLATE) selects the topic terms; the memo is scored."""
    d = DT.dispute_memos(spark, sf_dir)
    h = hit_counts(d, ["dispute_id"], "memo_text", {"topic": FILTER_TERMS},
                   carry=["dispute_category"], with_word_count=True)
    return h.withColumn("flagged", TX.filter_rule(F.col("topic"), F.col("n_words"), 0.001))


@query("t09_filter", with_views(f"""
SELECT dispute_id, dispute_category FROM {_FILTER_SQL} WHERE flagged""", "dispute_memos"))
def t09(spark, sf_dir):
    return _flagged(spark, sf_dir).filter("flagged").select("dispute_id", "dispute_category")


@query("a13_flag_overlap", with_views(f"""
SELECT CAST(count(*) AS BIGINT) AS flagged_by_ai_filter,
  CAST(count(*) FILTER (WHERE dispute_category IN ('FRAUD', 'UNRECOGNIZED')) AS BIGINT) AS of_those_labeled_fraud_like
FROM {_FILTER_SQL} WHERE flagged""", "dispute_memos"))
def a13(spark, sf_dir):
    return flag_overlap(_flagged(spark, sf_dir), "flagged", "dispute_category",
                        ["FRAUD", "UNRECOGNIZED"])


# --- T10 / T13 / T14 / T16 -----------------------------------------------------------------------

def _reply_sql() -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    cases = " ".join(
        f"WHEN d.dispute_category = {lit(c)} THEN "
        + " || m.merchant_name || ".join(lit(p) for p in (TX.REPLY_OPENING + t + TX.REPLY_CLOSING)
                                         .split("{0}"))
        for c, t in TX.REPLY_TEMPLATES.items())
    generic = " || m.merchant_name || ".join(
        lit(p) for p in (TX.REPLY_OPENING + "We are reviewing the charge at {0}."
                         + TX.REPLY_CLOSING).split("{0}"))
    return f"CASE {cases} ELSE {generic} END"


@query("t10_reply", with_views(f"""
SELECT d.dispute_id, m.merchant_name, {_reply_sql()} AS draft_reply
FROM dispute_memos d JOIN raw_merchant_master m USING (merchant_id)""",
                               "dispute_memos", "raw_merchant_master"))
def t10(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir).select("dispute_id", "merchant_id", "dispute_category")
    m = DT.merchant_master(spark, sf_dir).select("merchant_id", "merchant_name")
    j = d.join(m, "merchant_id")
    return j.select("dispute_id", "merchant_name",
                    TX.draft_reply("dispute_category", "merchant_name").alias("draft_reply"))


@query("t13_max_tokens", with_views(f"""
SELECT dispute_id, array_to_string(list_slice(regexp_extract_all(summary, '{TOKEN_RE}'), 1, 60), ' ')
  AS tight_summary FROM ({_summary_sql(1)})""", "dispute_memos"))
def t13(spark, sf_dir):
    """Generation parameters: a deterministic one-sentence summary of the whole memo
    (temperature 0), its output capped at ``max_tokens`` = 60 tokens."""
    d = DT.dispute_memos(spark, sf_dir)
    s = TA.summarize(d, "dispute_id", "memo_text", n_sentences=1)
    return s.select("dispute_id", TX.truncate_tokens("summary", 60).alias("tight_summary"))


def _triage_sql() -> str:
    actions = " ".join(f"WHEN predicted_category = '{k}' THEN '{v}'" for k, v in TX.ACTIONS.items())
    return f"""
SELECT p.dispute_id,
  CASE WHEN h >= 3 THEN 'HIGH' WHEN h >= 1 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  coalesce(predicted_category IN ({_in(TX.REFUND_LABELS)}), false) AS refund_recommended,
  CASE {actions} ELSE 'Manual review' END AS recommended_action
FROM {PRED_SQL} p JOIN (
  SELECT dispute_id, {hits_sql(WORDS_SQL, TX.SEVERITY_TERMS)} AS h FROM dispute_memos) s
  ON p.dispute_id = s.dispute_id"""


@query("t14_triage", with_views(_triage_sql(), "dispute_memos"))
def t14(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    kw = TX.keywords_from_labels(LABELS)
    lex = {f"_h{i}": kw[lab] for i, lab in enumerate(LABELS)}
    lex["_sev"] = TX.SEVERITY_TERMS
    h = hit_counts(d, ["dispute_id"], "memo_text", lex)
    lab = argmax_label([F.col(f"_h{i}") for i in range(len(LABELS))], LABELS)
    t = h.select("dispute_id", TX.triage_rule(F.col("_sev"), lab).alias("triage"))
    return t.select("dispute_id", "triage.severity", "triage.refund_recommended",
                    "triage.recommended_action")


@query("t16_injection_flag", with_views(f"""
SELECT dispute_id, coalesce(regexp_matches(memo_text, '{TX.INJECTION_PATTERN}'), false) AS injection_flag,
  CAST(length(memo_text) + 13 AS BIGINT) AS wrapped_length
FROM dispute_memos""", "dispute_memos"))
def t16(spark, sf_dir):
    d = DT.dispute_memos(spark, sf_dir)
    return d.select("dispute_id", TX.injection_flag("memo_text").alias("injection_flag"),
                    F.length(TX.as_data("memo_text")).cast("long").alias("wrapped_length"))


# --- T11 / T12 group roll-ups, T15 batch function ------------------------------------------------

def _insight_sql() -> str:
    stop = _in(sorted({w for ws in TX.STOPWORDS.values() for w in ws}))
    return f"""
WITH dm AS (SELECT d.dispute_id, d.dispute_category, d.memo_text, m.merchant_name
            FROM dispute_memos d JOIN raw_merchant_master m USING (merchant_id)),
cnt AS (SELECT merchant_name, CAST(count(*) AS BIGINT) AS dispute_count FROM dm GROUP BY 1
        HAVING count(*) >= 3),
cat AS (SELECT merchant_name, dispute_category AS top_category FROM (
          SELECT merchant_name, dispute_category, row_number() OVER (
            PARTITION BY merchant_name ORDER BY count(*) DESC, dispute_category) AS r
          FROM dm GROUP BY 1, 2) WHERE r = 1),
tf AS (SELECT merchant_name, word, count(*) AS tf FROM (
         SELECT merchant_name, unnest(regexp_extract_all(lower(memo_text), '[a-z]+')) AS word FROM dm)
       WHERE length(word) >= 3 AND word NOT IN ({stop}) GROUP BY 1, 2),
terms AS (SELECT merchant_name, string_agg(word, ', ' ORDER BY r) AS terms FROM (
            SELECT *, row_number() OVER (PARTITION BY merchant_name ORDER BY tf DESC, word) AS r
            FROM tf) WHERE r <= 3 GROUP BY 1),
idf AS (SELECT word, ln((SELECT CAST(count(*) AS DOUBLE) FROM dm) / count(*)) AS idf FROM (
          SELECT DISTINCT dispute_id, unnest(regexp_extract_all(lower(memo_text), '[a-z]+')) AS word
          FROM dm) GROUP BY word),
sc AS (SELECT dispute_id, merchant_name, round(avg(idf), 9) AS score FROM (
         SELECT dispute_id, merchant_name, unnest(regexp_extract_all(lower(memo_text), '[a-z]+')) AS word
         FROM dm) w JOIN idf USING (word) GROUP BY 1, 2),
rep AS (SELECT s.merchant_name, dm.memo_text AS rep FROM (
          SELECT merchant_name, dispute_id, row_number() OVER (
            PARTITION BY merchant_name ORDER BY score DESC, dispute_id DESC) AS r FROM sc) s
        JOIN dm ON s.dispute_id = dm.dispute_id AND s.merchant_name = dm.merchant_name
        WHERE s.r = 1)
SELECT c.merchant_name, c.dispute_count,
  printf('%d disputes; most common problem: %s; recurring terms: %s. Representative memo: %s',
         c.dispute_count, cat.top_category, coalesce(t.terms, '-'), coalesce(rep.rep, '-'))
    AS merchant_dispute_insight
FROM cnt c LEFT JOIN cat USING (merchant_name) LEFT JOIN terms t USING (merchant_name)
LEFT JOIN rep USING (merchant_name)
ORDER BY c.dispute_count DESC, c.merchant_name LIMIT 10"""


@query("t11_agg", with_views(_insight_sql(), "dispute_memos", "raw_merchant_master"))
def t11(spark, sf_dir):
    """One insight per merchant with >= 3 memos (top 10 by count)."""
    d = DT.dispute_memos(spark, sf_dir)
    m = DT.merchant_master(spark, sf_dir).select("merchant_id", "merchant_name")
    return TA.group_insight(d.join(m, "merchant_id"), "merchant_name", "memo_text",
                            "dispute_category", "dispute_id", min_rows=3, top=10)


@query("t12_summarize_agg", with_views(_group_summary_sql(3), "dispute_memos"))
def t12(spark, sf_dir):
    """One extractive summary per dispute category."""
    d = DT.dispute_memos(spark, sf_dir)
    return TA.summarize_groups(d, "dispute_category", "dispute_id", "memo_text", n_sentences=3)


@query("t15_ai_map")
def t15(spark, sf_dir):
    """Batch text function with safe failure over distinct memo texts (Arrow batches)."""
    from cardmart.functions.ai_map import ai_map, keyword_triage_json
    d = DT.dispute_memos(spark, sf_dir).select("dispute_id", "memo_text")
    out = ai_map(d, keyword_triage_json, "memo_text", TX.TRIAGE_SCHEMA)
    return out.select("dispute_id", "ai_result.ok", "ai_result.error",
                      "ai_result.value.severity", "ai_result.value.refund_recommended")


# --- chat prompts over conversations (P20 with role filters) -------------------------------------

@query("p20_chat_prompt", """
SELECT conv_id, CAST(count(*) AS BIGINT) AS user_turns,
  string_agg('[' || CAST(turn AS VARCHAR) || '] ' || text, chr(10) ORDER BY turn) AS prompt
FROM conversations WHERE role = 'user' GROUP BY conv_id""")
def p20_chat(spark, sf_dir):
    """One prompt per conversation from its user turns, in turn order.  A conversation is
    a bounded group (its turns); turns are ordered inside the group, not globally."""
    c = DT.read(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    line = F.concat(F.lit("["), F.col("turn").cast("string"), F.lit("] "), F.col("text"))
    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("user_turns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))),
                                 lambda x: x["l"]), "\n").alias("prompt"))


@query("t08_mllib_toxic")
def t08_mllib(spark, sf_dir):
    """T07 (c) + T08: an MLlib text pipeline trained on the labelled documents (70% split by
    id hash) and evaluated on the rest, next to the lexicon rule on the same rows."""
    from cardmart.operators.classify_ml import predict_text, split_by_hash, train_text_classifier
    d = DT.read(spark, sf_dir, "documents").select("doc_id", "text")
    lab = DT.read(spark, sf_dir, "labels").join(d, "doc_id")
    train, test = split_by_hash(lab, "doc_id")
    model = train_text_classifier(train, "text", "toxic")
    ml = predict_text(model, test, ["doc_id", "toxic"]).select(
        F.lit("mllib_logreg").alias("task"), F.col("toxic").alias("actual"), "predicted")
    rule = (hit_counts(test, ["doc_id"], "text", {"tox": TOXIC_TERMS}, carry=["toxic"])
            .select(F.lit("lexicon_rule").alias("task"), F.col("toxic").alias("actual"),
                    F.when(F.col("tox") > 0, 1).otherwise(0).alias("predicted")))
    return accuracy(ml.unionByName(rule), "actual", "predicted", group_by=["task"])
