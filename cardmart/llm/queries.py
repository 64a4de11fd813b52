"""Registered queries of the training-data operators, each over its whole table.

``QUERIES[name](spark, sf_dir)``; ``ORACLE[name]`` is DuckDB SQL for the same
rows where SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardmart.llm import (
    bitplanes, fingerprint, kneser_ney, merkle, mixing, neardup, packing, quality, rlz, sharding, toxicity, urlfilter, warc)
from cardmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- 1: mixing

def _weight_case(level: str) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {w}" for v, w in mixing.WEIGHTS[level].items())
    return f"CAST(CASE {level} {whens} ELSE {mixing.DEFAULT_WEIGHT} END AS BIGINT)"


def mixing_sql(share: float, max_epochs: int, seed: str) -> str:
    """Budgets level by level, then the seeded prefix of each leaf by one running sum."""
    ctes = [f"""
    base AS (SELECT doc_id, lang, source, CAST(len({WORDS_SQL}) AS BIGINT) AS n_tokens, md5(coalesce(text, '')) AS text_md5
             FROM documents),
    tokens AS (SELECT *, CASE WHEN n_tokens < 150 THEN 'note' WHEN n_tokens < 1500 THEN 'article' ELSE 'long' END AS domain
               FROM base),
    leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS supply FROM tokens GROUP BY ALL),
    b0 AS (SELECT *, least(CAST(floor((SELECT sum(supply) FROM leaves) * CAST({share} AS DOUBLE)) AS BIGINT),
                           CAST((SELECT sum(supply) FROM leaves) * {max_epochs} AS BIGINT)) AS budget FROM leaves)"""]
    for depth in range(1, len(mixing.LEVELS) + 1):
        key, parent = ", ".join(mixing.LEVELS[:depth]), ", ".join(mixing.LEVELS[:depth - 1])
        part = f"PARTITION BY {parent}" if parent else ""
        join = " AND ".join(f"b.{k} IS NOT DISTINCT FROM s.{k}" for k in mixing.LEVELS[:depth])
        ctes.append(f"""
    n{depth} AS (SELECT {key}, any_value(budget) AS budget, CAST(sum(supply) * {max_epochs} AS BIGINT) AS cap,
                 {_weight_case(mixing.LEVELS[depth - 1])} AS w FROM b{depth - 1} GROUP BY {key}),
    r{depth} AS (SELECT *, sum(cap) OVER o - cap AS cap_before, sum(w) OVER ({part}) - sum(w) OVER o + w AS w_left,
                 row_number() OVER o AS rk FROM n{depth}
                 WINDOW o AS ({part} ORDER BY cap / w, {key} ROWS UNBOUNDED PRECEDING)),
    f{depth} AS (SELECT *, min(CASE WHEN (budget - cap_before) * w < cap * w_left THEN rk END) OVER ({part}) AS fr FROM r{depth}),
    l{depth} AS (SELECT *, max(CASE WHEN rk = fr THEN CAST(budget - cap_before AS BIGINT) END) OVER ({part}) AS lf,
                 max(CASE WHEN rk = fr THEN CAST(w_left AS BIGINT) END) OVER ({part}) AS wl FROM f{depth}),
    s{depth} AS (SELECT *, CASE WHEN fr IS NULL OR rk < fr THEN cap
                 ELSE greatest(0, least(CAST(floor(CAST(lf * w AS DOUBLE) / CAST(wl AS DOUBLE)) AS BIGINT), cap)) END AS share FROM l{depth}),
    b{depth} AS (SELECT b.domain, b.lang, b.source, b.supply, CAST(s.share AS BIGINT) AS budget
                 FROM b{depth - 1} b JOIN s{depth} s ON {join})""")
    leaf = " AND ".join(f"t.{k} IS NOT DISTINCT FROM b.{k}" for k in mixing.LEVELS)
    ctes.append(f"""
    q AS (SELECT *, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS whole FROM b3),
    placed AS (SELECT t.*, q.budget, q.whole, q.budget - q.whole * q.supply AS rest,
               md5(concat_ws('|', '{seed}', CAST(q.whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), 'null'), text_md5)) AS place
               FROM tokens t JOIN q ON {leaf.replace('b.', 'q.')}),
    sums AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed)""")
    return "WITH " + ",".join(ctes) + f"""
    SELECT doc_id, domain, lang, source, n_tokens, budget AS leaf_budget, whole AS whole_epochs,
           (budget > 0 AND upto <= rest AND whole < {max_epochs}) AS in_prefix,
           whole + CASE WHEN budget > 0 AND upto <= rest AND whole < {max_epochs} THEN 1 ELSE 0 END AS epochs FROM sums"""


@query("op1_mixing", mixing_sql(0.9, 2, mixing.SEED))
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs of every document under the production weights: 90% of all tokens, at most two epochs."""
    return mixing.mix(table(spark, sf_dir, "documents"), budget_share=0.9, max_epochs=2).drop("text_md5")


# ---------------------------------------------------------------- 2: quality rules

def quality_sql() -> str:
    common = " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in quality.COMMON_WORDS.items())
    js = lambda p, r: f"""CASE WHEN list_sum({p}) > 0 AND list_sum({r}) > 0 THEN round(sqrt(greatest(0.0, list_sum([(CASE WHEN z[1] > 0 THEN (z[1] / list_sum({p})) * log2((z[1] / list_sum({p})) / ((z[1] / list_sum({p}) + z[2] / list_sum({r})) / 2)) ELSE 0.0 END)
        + (CASE WHEN z[2] > 0 THEN (z[2] / list_sum({r})) * log2((z[2] / list_sum({r})) / ((z[1] / list_sum({p}) + z[2] / list_sum({r})) / 2)) ELSE 0.0 END) for z in list_zip({p}, {r})]) / 2)), 6) END"""  # noqa: E731
    n = len(quality.CLASSES)
    return rf"""
    WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {WORDS_SQL} AS w FROM documents),
    c AS (SELECT doc_id, lang, t, w, len(w) AS n_words, coalesce(length(array_to_string(w, '')), 0) AS word_chars,
          len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
          [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines,
          len(regexp_extract_all(t, '[0-9]')) AS digit, len(regexp_extract_all(t, '[A-Z]')) AS upper,
          len(regexp_extract_all(t, '[.,;:!?]')) AS mark, length(t) AS n_chars,
          len(regexp_extract_all(t, '{quality.WIDE}')) AS wide,
          [lower(x) for x in w] AS low, CASE lang {common} END AS listed,
          [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)] AS wins FROM d),
    p AS (SELECT doc_id, unnest(wins) AS win, generate_subscripts(wins, 1) AS i FROM c),
    rep AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (
            SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM p) WHERE k > 1) GROUP BY doc_id),
    f AS (SELECT c.doc_id, lang, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
          coalesce(n_repeat_words, 0) AS n_repeat_words, n_chars,
          CASE WHEN listed IS NULL THEN [CAST(0 AS BIGINT) for i in range({quality.SLOTS})]
               ELSE [CAST(len([x for x in low if x = v]) AS BIGINT) for v in listed] END AS com,
          [n_chars - word_chars, digit, upper, mark, n_symbols, wide,
           word_chars - digit - upper - mark - n_symbols - wide] AS cls
          FROM c LEFT JOIN rep USING (doc_id)),
    r AS (SELECT lang AS r_lang, true AS own, [{', '.join(f'CAST(sum(cls[{k + 1}]) AS DOUBLE)' for k in range(n))}] AS r_cls,
          CASE WHEN lang IN ({', '.join(repr(x) for x in quality.COMMON_WORDS)}) THEN [{', '.join(f'CAST(sum(com[{k + 1}]) AS DOUBLE)' for k in range(quality.SLOTS))},
           CAST(sum(n_words) AS DOUBLE) - ({' + '.join(f'sum(com[{k + 1}])' for k in range(quality.SLOTS))})] END AS r_com
          FROM f GROUP BY lang HAVING count(*) >= (SELECT count(*) FROM f) / {float(quality.SHARE)}),
    a AS (SELECT [{', '.join(f'CAST(sum(cls[{k + 1}]) AS DOUBLE)' for k in range(n))}] AS a_cls FROM f),
    j AS (SELECT *, CAST(cls AS DOUBLE[]) AS pc, CAST(list_append(com, greatest(0, n_words - list_sum(com))) AS DOUBLE[]) AS pw,
          CASE WHEN own THEN r_cls ELSE (SELECT a_cls FROM a) END AS ref_cls
          FROM f LEFT JOIN r ON lang IS NOT DISTINCT FROM r_lang),
    v AS (SELECT *, {js('pc', 'ref_cls')} AS class_distance, {js('pw', 'r_com')} AS word_distance,
          (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM j)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           (NOT base_failed AND NOT coalesce((n_chars >= {quality.MIN_CHARS} AND class_distance > {quality.MAX_CLASS_DISTANCE})
            OR (n_words >= {quality.MIN_WORDS} AND word_distance > {quality.MAX_WORD_DISTANCE}), false)) AS kept,
           class_distance, word_distance FROM v"""


@query("op2_quality", quality_sql())
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col(quality.QUALITY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # The text is not carried into the table of counts.
    from cardmart.llm.common import Scratch
    scratch = Scratch(spark, "quality")
    features = scratch.cut(quality.with_features(docs).drop("text", "lang"), "features")
    judged = quality.with_verdict(features, quality.references(features))
    return judged.select("doc_id", *[q["counts"][c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        q["base_failed"].alias("base_failed"), q["kept"].alias("kept"),
        q["class_distance"].alias("class_distance"), q["word_distance"].alias("word_distance"))


# ---------------------------------------------------------------- 3: packing

@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                  public_tokenizers.PATTERN)


# ---------------------------------------------------------------- 4: fingerprints

@query("op4_fingerprint")
def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_chars", "edited_sha256", fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
                    fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                    fingerprint.containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    fingerprint.containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                    fingerprint.jaccard(F.col("sketch"), F.col("edited_sketch")).alias("jaccard_edited"))


# ---------------------------------------------------------------- 5: WARC

@query("op5_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
    m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d),
    r AS (SELECT *, payload_bytes >= 100 AND first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id AS again FROM m)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN again THEN first_id END AS refers_to FROM r""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, table(spark, sf_dir, "pages")).drop("archive")


# ---------------------------------------------------------------- 6: language model

@query("op6_kneser_ney")
def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = kneser_ney.fit(docs.where(~kneser_ney.held_out()))
    return kneser_ney.score(docs, model).withColumn("held_out", kneser_ney.held_out())


# ---------------------------------------------------------------- 7: sharding

@query("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 8: toxicity

@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model, "score")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


# ---------------------------------------------------------------- 9: near-duplicates

@query("op9_superminhash", r"""
    WITH RECURSIVE
    d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)])
          END AS sh FROM d),
    n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
    e AS (SELECT doc_id, unnest(sh) AS x FROM s),
    i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT i.a, i.b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
          WHERE 100 * k >= 80 * (p.n_shingles + q.n_shingles - k)),
    g AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, g.b FROM reach r JOIN g ON r.other = g.a)
    SELECT n.doc_id, any_value(n_shingles) AS n_shingles, min(other) AS component_id, n.doc_id = min(other) AS kept
    FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id""")
def op9_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 10: URL filter

def _glob_regex(glob: str) -> str:
    out = glob.replace(".", r"\.").replace("?", "[^/]").replace("**", "\0").replace("*", "[^/]*").replace("\0", ".*")
    return f"(?s)^{out}$"


def url_sql() -> str:
    url = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"
    sites = sorted(urlfilter.SITE_RULES, key=lambda s: (-len(s[0]), s[0]))
    fits = lambda r: (f"((host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) "  # noqa: E731
                      f"AND starts_with(path, '/{r.partition('/')[2]}'))")
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in sites) + " END"
    verdict = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in sites)
    globs = sorted(urlfilter.GLOB_RULES, key=lambda g: g[1] != "allow")
    glob = "CASE WHEN rule IS NOT NULL THEN NULL " + " ".join(
        f"WHEN regexp_matches(host || path, '{_glob_regex(g)}') THEN '{g}'" for g, _ in globs) + " END"
    verdict += " " + " ".join(f"WHEN glob_rule = '{g}' THEN '{v}'" for g, v in globs) + " ELSE 'allow' END"
    return f"""
    WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), {url}, 1), '{urlfilter.UPPER}', '{urlfilter.LOWER}') AS host,
               regexp_extract(coalesce(url, ''), {url}, 2) AS path FROM pages),
    r AS (SELECT *, {rule} AS rule FROM p), g AS (SELECT *, {glob} AS glob_rule FROM r)
    SELECT page_id, host, path, rule, glob_rule, {verdict} AS verdict FROM g"""


@query("op10_urlfilter", url_sql())
def op10_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- 11: centroid clustering

def clustering_sql() -> str:
    """The rounds one after the other; integers stay exact in doubles at this size."""
    kept = f"""
    x AS MATERIALIZED (SELECT vec_id, [floor({bitplanes.SCALE} * CAST(c AS DOUBLE)) FOR c IN embedding] AS v,
          sha256('{bitplanes.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS place FROM embeddings
          WHERE len(embedding) = {bitplanes.DIM} AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS cluster, v FROM x ORDER BY place LIMIT {bitplanes.K})"""
    near = """
    a{r} AS MATERIALIZED (SELECT x.vec_id, any_value(x.v) AS v, arg_min(c.cluster, list_dot_product(x.v, x.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(x.v, c.v) + c.cluster / 1000.0) AS cluster,
          min(list_dot_product(x.v, x.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(x.v, c.v)) AS distance
          FROM x, c{r} c GROUP BY x.vec_id)"""
    moved = """
    m{r} AS (SELECT cluster, p, floor(sum(u) / count(*)) AS u FROM (
             SELECT cluster, unnest(v) AS u, generate_subscripts(v, 1) AS p FROM a{r}) GROUP BY cluster, p),
    n{r} AS (SELECT cluster, list(u ORDER BY p) AS v FROM m{r} GROUP BY cluster),
    c{s} AS MATERIALIZED (SELECT c.cluster, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN n{r} n ON n.cluster = c.cluster)"""
    rounds = "".join("," + near.format(r=r) + "," + moved.format(r=r, s=r + 1) for r in range(bitplanes.ROUNDS))
    last = bitplanes.ROUNDS
    return f"""WITH {kept}{rounds},{near.format(r=last)}
    SELECT a.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance,
      CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
      CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string([CAST(u AS BIGINT) FOR u IN c.v], ',')) AS centroid_sha256
    FROM a{last} a JOIN c{last} c ON c.cluster = a.cluster"""


@query("op11_bitplanes", clustering_sql())
def op11_bitplanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster_vectors(table(spark, sf_dir, "embeddings"))


# ---------------------------------------------------------------- 12: repeated passages

@query("op12_rlz", rf"""
    WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    s AS (SELECT doc_id, unnest(range(1, len(w) - {rlz.WINDOW - 2})) AS s, w FROM d),
    h AS (SELECT doc_id, s, md5(array_to_string(w[s:s + {rlz.WINDOW - 1}], ' ')) AS h FROM s),
    later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS n FROM h) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {rlz.WINDOW})) AS p FROM later),
    left_over AS (SELECT d.doc_id, u.p, w[u.p] AS word FROM d, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS p) u
                  ANTI JOIN gone g ON g.doc_id = d.doc_id AND g.p = u.p),
    kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM left_over GROUP BY doc_id)
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
      sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id""")
def op12_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.remove_repeats(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 13: Merkle manifest

def manifest_sql(leaf_levels: int = 7, lang_levels: int = 3) -> str:
    """Level by level, up to 8**7 leaves a language and 8**3 languages."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(part(text if c == 'text' else c) for c in merkle.FIELDS)})"
    low = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    ctes = [f"""
    crc AS MATERIALIZED (SELECT [list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, o: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) FOR i IN range(256)] AS t),
    k AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf, {leaf(low)} AS low,
          xor(list_reduce(list_concat([4294967295::UBIGINT], [CAST(ascii(b) AS UBIGINT) FOR b IN string_split(coalesce(CAST(doc_id AS VARCHAR), ''), '')]),
              lambda c, b: xor(c // 256, crc.t[CAST(xor(c % 256, b) + 1 AS BIGINT)])), 4294967295::UBIGINT) % 3 = 0 AS tampered FROM documents, crc),
    l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
          count(*) OVER (PARTITION BY tree) AS n FROM k),
    a0 AS (SELECT tree, idx, n, leaf AS h FROM l)"""]

    def up(p: str, levels: int) -> str:
        return "".join(f""",
    {p}r{t} AS MATERIALIZED (SELECT tree, idx // 8 AS idx, any_value(n) AS n, string_agg(h, '' ORDER BY idx) AS run FROM {p}{t} WHERE n > 1 GROUP BY 1, 2),
    {p}{t + 1} AS MATERIALIZED (SELECT tree, idx, (n + 7) // 8 AS n, sha256(run) AS h FROM {p}r{t} UNION ALL SELECT * FROM {p}{t} WHERE n = 1)"""
                       for t in range(levels))

    ctes.append(up("a", leaf_levels))
    ctes.append(f""",
    subroots AS MATERIALIZED (SELECT tree AS lang_tree, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS idx, count(*) OVER () AS n FROM a{leaf_levels}),
    b0 AS (SELECT '' AS tree, idx, n, subroot AS h FROM subroots)""")
    ctes.append(up("b", lang_levels))
    before, prefix = "l JOIN subroots s ON s.lang_tree = l.tree", "p0 AS (SELECT l.doc_id, l.tree, l.idx, s.idx AS at, l.leaf, s.subroot, "         "CASE WHEN tampered THEN low ELSE leaf END AS f, '' AS proof FROM"
    ctes.append(f", {prefix} {before})")
    step = 0
    for p, levels, idx, on in (("a", leaf_levels, "p.idx", "r.tree = p.tree AND "), ("b", lang_levels, "p.at", "")):
        for t in range(levels):
            at = f"({idx} // {8 ** t}) % 8"
            left, right = f"substr(run, 1, CAST(64 * ({at}) AS BIGINT))", f"substr(run, CAST(64 * ({at}) + 65 AS BIGINT))"
            ctes.append(f""",
    p{step + 1} AS (SELECT p.* REPLACE (CASE WHEN run IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f,
          CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof)
          FROM p{step} p LEFT JOIN {p}r{t} r ON {on}r.idx = {idx} // {8 ** (t + 1)})""")
            step += 1
    return "WITH " + "".join(ctes) + f"""
    SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = root.h AS verified
    FROM p{step}, (SELECT h FROM b{lang_levels}) root"""


@query("op13_merkle", manifest_sql())
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("tampered")
