"""Classification from examples (T07, A08), answers with scores (T05), and paths into their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardmart.functions import text as TX, variant as VA
from cardmart.operators import answers as AN, bayes as NB, instruct as IN
from cardmart.operators.evaluate import accuracy
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.plans.queries_text import _SENT_FROM, _SENT_SQL
from cardmart.sources import driver_tables as DT

# ---------------------------------------------------------------- T07 with descriptions and examples

LANGUAGES = [{"label": "en", "description": "the of and"}, {"label": "fr", "description": "le la les"},
             {"label": "de", "description": "der die das"}, {"label": "es", "description": "el los las"}]
TONES = [{"label": "clean", "description": "ordinary prose without insults"},
         {"label": "toxic", "description": "insults such as idiot moron or stupid"}]
#: Rows whose hash begins with one of these digits are held out of the examples.
HELD_OUT = "0123"


def held_out(key: str):
    return F.substring(F.md5(F.col(key).cast("string")), 1, 1).isin(*HELD_OUT)


def _toxicity_examples(spark, sf_dir) -> DataFrame:
    labels = DT.read(spark, sf_dir, "labels").where("toxic is not null").select(
        "doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("label"))
    return DT.read(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


def _models(spark, sf_dir):
    docs = DT.read(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    tones = _toxicity_examples(spark, sf_dir)
    return {"lang_described": NB.fit(spark, LANGUAGES), "lang_examples": NB.fit(spark, LANGUAGES, docs.where(~held_out("doc_id"))),
            "toxic_described": NB.fit(spark, TONES), "toxic_examples": NB.fit(spark, TONES, tones.where(~held_out("doc_id")))}


def _counts_sql(labels, examples: str | None) -> str:
    parts = [f"SELECT unnest(regexp_extract_all('{d}', '[a-z]+')) AS word, '{name}' AS label" for name, d in NB.described(labels).items()]
    if examples:
        parts.append(f"SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word, label FROM {examples}")
    return " UNION ALL ".join(parts)


_FOLD = f"substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) NOT IN ({', '.join(repr(c) for c in HELD_OUT)})"
_EXAMPLES = {"lang": f"(SELECT text, lang AS label FROM documents WHERE text IS NOT NULL AND {_FOLD})",
             "toxic": f"""(SELECT text, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS label FROM documents JOIN labels USING (doc_id)
             WHERE text IS NOT NULL AND toxic IS NOT NULL AND {_FOLD})"""}


def _bayes_ctes() -> str:
    ctes = ["""tf AS MATERIALIZED (SELECT doc_id, word, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY ALL)"""]
    for task, labels in (("lang", LANGUAGES), ("toxic", TONES)):
        for mode in ("described", "examples"):
            m, examples = f"{task}_{mode}", _EXAMPLES[task] if mode == "examples" else None
            names = list(NB.described(labels))
            n = lambda i: f"n{i}"
            ctes.append(f"{m}_w AS MATERIALIZED (SELECT word, " + ", ".join(f"count(*) FILTER (WHERE label = '{x}') AS {n(i)}" for i, x in enumerate(names))
                        + f" FROM ({_counts_sql(labels, examples)}) GROUP BY word)")
            ctes.append(f"{m}_t AS (SELECT count(*) AS v, " + ", ".join(f"sum({n(i)}) AS t{i}" for i in range(len(names))) + f" FROM {m}_w)")
            seen = ", ".join(f"1 + {f'(SELECT count(*) FROM {examples} WHERE label = {x!r})' if examples else 0} AS d{i}" for i, x in enumerate(names))
            ctes.append(f"{m}_d AS (SELECT {seen})")
            ctes.append(f"{m}_s AS (SELECT doc_id, sum(k) AS known, " + ", ".join(f"sum(k * ln({n(i)} + 1.0)) AS s{i}" for i in range(len(names)))
                        + f" FROM tf JOIN {m}_w USING (word) GROUP BY doc_id)")
            total = " + ".join(f"d{i}" for i in range(len(names)))
            ctes.append(f"{m}_c AS (SELECT d.doc_id, text IS NOT NULL AS has, coalesce(known, 0) AS known, " + ", ".join(
                f"ln(CAST(d{i} AS DOUBLE) / ({total})) + coalesce(s{i}, 0.0) - coalesce(known, 0) * ln(t{i} + 1.0 * v) AS c{i}" for i in range(len(names)))
                + f" FROM documents d LEFT JOIN {m}_s USING (doc_id), {m}_t, {m}_d)")
            best = "greatest(" + ", ".join(f"c{i}" for i in range(len(names))) + ")"
            ctes.append(f"{m} AS (SELECT doc_id, known, CASE WHEN NOT has THEN NULL " + " ".join(
                f"WHEN c{i} = {best} THEN '{x}'" for i, x in enumerate(names)) + f" END AS p FROM {m}_c)")
    return ",\n".join(ctes)


_ALL = "lang_described ld JOIN lang_examples le USING (doc_id) JOIN toxic_described td USING (doc_id) JOIN toxic_examples te USING (doc_id)"


@query("t07_classify_bayes", f"""
WITH {_bayes_ctes()}
SELECT doc_id, ld.p AS lang_described, le.p AS lang_examples, td.p AS toxic_described, te.p AS toxic_examples,
  CAST(le.known AS BIGINT) AS n_known FROM {_ALL}""")
def t07_bayes(spark, sf_dir):
    """Language and tone of every document, from descriptions alone and with the examples that are not held out."""
    docs = DT.read(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select("doc_id")
    for name, model in _models(spark, sf_dir).items():
        found = NB.classify(docs, ["doc_id"], "text", model, name)
        out = out.join(found if name == "lang_examples" else found.drop("n_known"), "doc_id")
    return out


@query("a08_accuracy_bayes", f"""
WITH {_bayes_ctes()},
p AS (SELECT d.doc_id, d.lang, ld.p AS lang_described, le.p AS lang_examples, td.p AS toxic_described, te.p AS toxic_examples
      FROM documents d JOIN lang_described ld USING (doc_id) JOIN lang_examples le USING (doc_id) JOIN toxic_described td USING (doc_id)
      JOIN toxic_examples te USING (doc_id) WHERE NOT ({_FOLD})),
j AS (SELECT 'lang_described' AS task, lang AS actual, lang_described AS predicted FROM p UNION ALL SELECT 'lang_examples', lang, lang_examples FROM p
  UNION ALL SELECT 'toxic_described', CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END, toxic_described FROM p JOIN labels USING (doc_id) WHERE toxic IS NOT NULL
  UNION ALL SELECT 'toxic_examples', CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END, toxic_examples FROM p JOIN labels USING (doc_id) WHERE toxic IS NOT NULL)
SELECT task, n, correct, ((2000 * correct + n) // (2 * n)) / 10.0 AS accuracy_pct FROM (
  SELECT task, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE predicted = actual) AS BIGINT) AS correct FROM j GROUP BY task)""")
def a08_bayes(spark, sf_dir):
    """Held-out accuracy of the four classifiers: examples raise it over descriptions alone."""
    docs = DT.read(spark, sf_dir, "documents").where(held_out("doc_id"))
    tones = _toxicity_examples(spark, sf_dir).where(held_out("doc_id"))
    judged = None
    for name, model in _models(spark, sf_dir).items():
        truth = docs.select("doc_id", "text", F.col("lang").alias("actual")) if name.startswith("lang") else tones.withColumnRenamed("label", "actual")
        one = NB.classify(truth, ["doc_id"], "text", model).join(truth.select("doc_id", "actual"), "doc_id").select(
            F.lit(name).alias("task"), "actual", "predicted")
        judged = one if judged is None else judged.unionByName(one)
    return accuracy(judged, "actual", "predicted", group_by=["task"])


# ---------------------------------------------------------------- T05 answers with scores

#: The question is about the first benchmark item: its ten longest words (ties in alphabetical order).
def benchmark_question(spark, sf_dir) -> str:
    text = DT.read(spark, sf_dir, "benchmark").orderBy("item_id").select("text").first()[0]
    found = sorted(set(AN.question_terms(text)), key=lambda w: (-len(w), w))[:10]
    return "Which passage mentions " + " ".join(sorted(found)) + "?"


_STOP = ", ".join(f"'{w}'" for w in (*TX.DESCRIPTION_STOPWORDS, *AN.QUESTION_WORDS))


_ANSWERS_SQL = rf"""item AS (SELECT text FROM benchmark ORDER BY item_id LIMIT 1),
q AS MATERIALIZED (SELECT w FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM item)
  WHERE w NOT IN ({_STOP}) ORDER BY length(w) DESC, w LIMIT 10),
terms AS MATERIALIZED (SELECT w FROM q UNION SELECT w FROM (VALUES ('passage'), ('mentions')) v(w)),
s AS MATERIALIZED (SELECT doc_id, x.s, x.pos, regexp_extract_all(lower(x.s), '[a-z]+') AS w FROM (
  SELECT doc_id, unnest([{{'s': y, 'pos': i}} FOR y, i IN [z FOR z IN regexp_split_to_array(text, '{AN.SENTENCE_END}') IF regexp_matches(lower(z), '[a-z]+')]]) AS x FROM documents)),
st AS (SELECT count(*) AS n, sum(len(w)) / CAST(count(*) AS DOUBLE) AS mean FROM s),
h AS MATERIALIZED (SELECT doc_id, pos, s.s, len(s.w) AS dl, t.w AS term, CAST(len([x FOR x IN s.w IF x = t.w]) AS DOUBLE) AS tf FROM s, terms t WHERE list_contains(s.w, t.w)),
df AS (SELECT term, count(*) AS k FROM h GROUP BY term),
sc AS (SELECT doc_id, pos, any_value(h.s) AS s, round(sum(ln(1 + (n - k + 0.5) / (k + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 4) AS score
  FROM h JOIN df USING (term), st GROUP BY doc_id, pos),
top AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM sc WHERE score > 0)"""


@query("t05_answers", rf"""
WITH {_ANSWERS_SQL}
SELECT doc_id, CAST(rank AS INTEGER) AS rank, score,
  regexp_extract(s, '(?is)(\b(?:' || (SELECT string_agg(w, '|' ORDER BY w) FROM terms) || ')\b(?:.*\b(?:' || (SELECT string_agg(w, '|' ORDER BY w) FROM terms) || ')\b)?)', 1) AS answer
FROM top WHERE rank <= 3""")
def t05_answers(spark, sf_dir):
    """Up to three answers of every document that has any, best first."""
    docs = DT.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = AN.answers(docs, "text", benchmark_question(spark, sf_dir))
    return found.select("doc_id", F.posexplode("answers").alias("p", "a")).select(
        "doc_id", (F.col("p") + 1).alias("rank"), "a.answer", "a.score")


# ---------------------------------------------------------------- P18 paths

def _payloads(spark, sf_dir) -> DataFrame:
    """Events as nested documents, built from their ``props``."""
    e = DT.read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    item = lambda n, tags: F.struct(n.alias("k"), tags.alias("tags"))
    return e.select("event_id", F.to_json(F.struct(
        F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("source"),
        F.array(item(k, F.array(F.col("event_type"), F.lit("first"))), item(k * 2, F.array(F.lit("double"))),
                item(k % 7, F.array())).alias("items"))).alias("payload"))


@query("p18_variant_path", """
SELECT event_id, event_type AS kind, CAST(props->>'$.k' AS BIGINT) AS first_k, CAST(props->>'$.k' AS BIGINT) * 2 AS second_k,
  event_type AS first_tag, CAST(NULL AS VARCHAR) AS no_tag, CAST(NULL AS BIGINT) AS no_cast, CAST(user_id AS DECIMAL(12,2)) AS user_amount
FROM events""")
def p18_variant(spark, sf_dir):
    """Values by name, position and type, ones that are not there or do not cast among them."""
    v = _payloads(spark, sf_dir).select("event_id", VA.json("payload").alias("v"))
    return v.select("event_id", VA.path("v:source.kind::string").alias("kind"), VA.path("v:items[0].k::bigint").alias("first_k"),
                    VA.path("v:items[1].k::bigint").alias("second_k"), VA.path("v:items[0].tags[0]::string").alias("first_tag"),
                    VA.path("v:items[2].tags[0]::string").alias("no_tag"), VA.path("v:source.kind::bigint").alias("no_cast"),
                    VA.path("v:source.user::decimal(12,2)").alias("user_amount"))


@query("p18_variant_elements", """
SELECT event_id, i - 1 AS pos, CASE i WHEN 1 THEN k WHEN 2 THEN 2 * k ELSE k % 7 END AS k, CASE i WHEN 1 THEN event_type WHEN 2 THEN 'double' END AS tag
FROM (SELECT event_id, event_type, CAST(props->>'$.k' AS BIGINT) AS k, unnest([1, 2, 3]) AS i FROM events)""")
def p18_elements(spark, sf_dir):
    """One row for each element of the nested array."""
    v = _payloads(spark, sf_dir).select("event_id", VA.json("payload").alias("v")).select("event_id", VA.path("v:items").alias("items"))
    return VA.elements(v, "items").select("event_id", "pos", VA.path("value:k::bigint").alias("k"), VA.path("value:tags[0]::string").alias("tag"))


@query("p18_result_paths", with_views(f"""
WITH {_bayes_ctes()},
{_ANSWERS_SQL},
mood AS (SELECT dispute_id, {_SENT_SQL} AS overall FROM {_SENT_FROM})
SELECT m.dispute_id, m.overall, te.p AS tone, t.score AS best_score, t2.score AS second_score
FROM mood m JOIN toxic_examples te ON CAST(te.doc_id AS VARCHAR) = m.dispute_id
LEFT JOIN top t ON t.doc_id = te.doc_id AND t.rank = 1 LEFT JOIN top t2 ON t2.doc_id = te.doc_id AND t2.rank = 2""", "dispute_memos"))
def p18_results(spark, sf_dir):
    """The structs of sentiment (T01), classification (T07) and answers (T05) of every memo, read by path."""
    memos = DT.dispute_memos(spark, sf_dir).select("dispute_id", "memo_text")
    tones = _toxicity_examples(spark, sf_dir).where(~held_out("doc_id"))
    tone = NB.classify(memos, ["dispute_id"], "memo_text", NB.fit(spark, TONES, tones)).select(
        "dispute_id", NB.labels_object(F.col("predicted")).alias("c"))
    rows = AN.answers(memos, "memo_text", benchmark_question(spark, sf_dir)).select(
        "dispute_id", F.to_variant_object(TX.sentiment("memo_text")).alias("s"), F.to_variant_object("answers").alias("a"))
    return rows.join(tone, "dispute_id").select(
        "dispute_id", VA.path("s:categories[0].sentiment::string").alias("overall"), VA.path("c:labels[0]::string").alias("tone"),
        VA.path("a[0]:score::double").alias("best_score"), VA.path("a[1]:score::double").alias("second_score"))


# ---------------------------------------------------------------- T09, A13 filters by instruction

INSULTS = "Find texts that insult someone as an idiot or a moron"
LICENSES = "Keep any text that is licensed, or mentions a license"


def _instruction_ctes(name: str, instruction: str) -> str:
    terms = IN.instruction_terms(instruction)
    listed = ", ".join(f"'{t}'" for t in terms)
    return rf"""
{name}_t AS MATERIALIZED (SELECT w, list_has_any(w, [{listed}]) AS topic FROM sent),
{name}_n AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE topic) AS DOUBLE) AS nt FROM {name}_t),
{name}_k AS MATERIALIZED (SELECT word, CAST(count(*) AS DOUBLE) AS k, CAST(count(*) FILTER (WHERE topic) AS DOUBLE) AS b FROM (SELECT topic, unnest(w) AS word FROM {name}_t) GROUP BY word),
{name}_x AS (SELECT word, CASE WHEN b = n THEN 1.0 ELSE round(ln(b * n / (k * nt)) / -ln(b / n), 4) END AS v FROM {name}_k, {name}_n WHERE b >= 5 AND word NOT IN ({listed})),
{name}_w AS MATERIALIZED (SELECT word, v FROM (SELECT word, v FROM {name}_x WHERE v >= 0.3 ORDER BY v DESC, word LIMIT 20)
  UNION ALL SELECT unnest([{listed}]), 1.0),
{name}_s AS MATERIALIZED (SELECT doc_id, CASE WHEN text IS NOT NULL THEN round(coalesce(s, 0.0), 4) END AS score FROM documents LEFT JOIN (
  SELECT doc_id, sum(v) AS s FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) JOIN {name}_w USING (word) GROUP BY doc_id) USING (doc_id)),
{name} AS (SELECT doc_id, score, coalesce(score > (SELECT greatest(0.0, round(avg(score) + 2 * stddev_pop(score), 6)) FROM {name}_s), false) AS keep FROM {name}_s)"""


_INSTRUCTION_SQL = rf"""sent AS MATERIALIZED (SELECT list_distinct(regexp_extract_all(lower(s), '[a-z]+')) AS w FROM (
  SELECT unnest([z FOR z IN regexp_split_to_array(text, '{AN.SENTENCE_END}') IF regexp_matches(lower(z), '[a-z]+')]) AS s FROM documents)),
{_instruction_ctes('insult', INSULTS)}, {_instruction_ctes('license', LICENSES)}"""


@query("t09_filter_instruction", f"""
WITH {_INSTRUCTION_SQL}
SELECT i.doc_id, i.score AS insult_score, i.keep AS insult_keep, l.score AS license_score, l.keep AS license_keep
FROM insult i JOIN license l USING (doc_id)""")
def t09_instruction(spark, sf_dir):
    """Two instructions over all documents; each finds its own words and keeps its own rows."""
    docs = DT.read(spark, sf_dir, "documents").select("doc_id", "text")
    found = IN.filter_by_instruction(docs, "text", INSULTS, score="insult_score", flag="insult_keep")
    return IN.filter_by_instruction(found, "text", LICENSES, score="license_score", flag="license_keep").drop("text")


@query("a13_instruction_overlap", f"""
WITH {_INSTRUCTION_SQL}
SELECT name AS instruction, CAST(count(*) AS BIGINT) AS labelled, CAST(count(*) FILTER (WHERE keep) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE keep AND toxic = 1) AS BIGINT) AS kept_toxic, CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS toxic
FROM (SELECT 'insult' AS name, doc_id, keep FROM insult UNION ALL SELECT 'license', doc_id, keep FROM license) x JOIN labels USING (doc_id)
WHERE toxic IS NOT NULL GROUP BY name""")
def a13_instruction(spark, sf_dir):
    """How the rows that each instruction keeps line up with the toxicity labels: the first is about them, the second is not."""
    labels = DT.read(spark, sf_dir, "labels").where("toxic is not null").select("doc_id", "toxic")
    kept = t09_instruction(spark, sf_dir).join(labels, "doc_id")
    both = kept.select(F.col("toxic"), F.explode(F.array(
        F.struct(F.lit("insult").alias("instruction"), F.col("insult_keep").alias("keep")),
        F.struct(F.lit("license").alias("instruction"), F.col("license_keep").alias("keep")))).alias("x"))
    toxic, keep = F.col("toxic") == 1, F.col("x.keep")
    return both.groupBy(F.col("x.instruction").alias("instruction")).agg(
        F.count(F.lit(1)).alias("labelled"), F.count_if(keep).alias("kept"), F.count_if(keep & toxic).alias("kept_toxic"), F.count_if(toxic).alias("toxic"))


# ---------------------------------------------------------------- T11 with an instruction

def _group_terms_sql(name: str) -> str:
    return f"""SELECT g.dispute_category, '{name}' AS instruction, t.terms FROM (SELECT DISTINCT dispute_category FROM dispute_memos) g LEFT JOIN (
  SELECT dispute_category, string_agg(word, ', ' ORDER BY r) AS terms FROM (
    SELECT *, row_number() OVER (PARTITION BY dispute_category ORDER BY score DESC, word) AS r FROM (
      SELECT dispute_category, word, round(v * tf * ln(1 + (SELECT sum(tf) / count(DISTINCT dispute_category) FROM tf) / f), 6) AS score
      FROM tf JOIN {name}_w USING (word) JOIN (SELECT word, sum(tf) AS f FROM tf GROUP BY word) USING (word)))
  WHERE r <= 3 GROUP BY dispute_category) t ON t.dispute_category = g.dispute_category"""


@query("t11_agg_instruction", with_views(f"""
WITH {_INSTRUCTION_SQL},
tf AS MATERIALIZED (SELECT dispute_category, word, CAST(count(*) AS DOUBLE) AS tf FROM (
  SELECT dispute_category, unnest(regexp_extract_all(lower(memo_text), '[a-z]+')) AS word FROM dispute_memos) GROUP BY ALL)
{_group_terms_sql('insult')} UNION ALL {_group_terms_sql('license')}""", "dispute_memos"))
def t11_instruction(spark, sf_dir):
    """Words of each dispute category that answer two instructions; another instruction gives other words."""
    from cardmart.operators.text_agg import group_terms
    memos = DT.dispute_memos(spark, sf_dir)
    one = lambda name, text: group_terms(memos, "dispute_category", "memo_text", text).select(
        "dispute_category", F.lit(name).alias("instruction"), "terms")
    return one("insult", INSULTS).unionByName(one("license", LICENSES))
