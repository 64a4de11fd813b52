"""Completions with a temperature (T13), replies that read the memo (T10), triage by what the memo shows (T14), hardened prompts (T16) and chat history (P20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardmart.functions import text as TX
from cardmart.operators import respond as RE
from cardmart.plans.catalog import query
from cardmart.plans.oracle_views import with_views
from cardmart.plans.queries_text import _LANG_CASE, TOKEN_RE, WORDS_SQL, _in, _scored_sentences_sql, hits_sql
from cardmart.sources import driver_tables as DT

TEMPERATURES = {"cold": 0.0, "warm": 0.7}
SEED, MAX_TOKENS, QUOTE_TOKENS = 7, 30, 25


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _completed_sql(temperatures: dict[str, float], max_tokens: int) -> str:
    """(dispute_id, one completion a temperature): the drawn sentence of every memo."""
    gumbel = f"-ln(-ln((CAST(('0x' || substr(md5('{SEED}:' || dispute_id || ':' || pos), 1, 8)) AS BIGINT) + 0.5) / 4294967296.0))"
    won = ", ".join(
        f"first(s ORDER BY {f'round(score + {t} * {gumbel}, 9)' if t else 'score'} DESC, pos) AS at_{name}" for name, t in temperatures.items())
    cut = ", ".join(f"""CASE WHEN m.memo_text IS NOT NULL THEN
  coalesce(array_to_string(list_slice(regexp_extract_all(w.at_{name}, '{TOKEN_RE}'), 1, {max_tokens}), ' '), '') END AS {name}""" for name in temperatures)
    return f"""
SELECT m.dispute_id, {cut} FROM dispute_memos m
LEFT JOIN (SELECT dispute_id, {won} FROM {_scored_sentences_sql()} GROUP BY dispute_id) w ON m.dispute_id = w.dispute_id"""


@query("t13_temperature", with_views(_completed_sql(TEMPERATURES, MAX_TOKENS), "dispute_memos"))
def t13_temperature(spark, sf_dir):
    """One sentence of at most 30 tokens for each memo, at temperature 0 and drawn at 0.7."""
    d = DT.dispute_memos(spark, sf_dir)
    return RE.complete(d, "dispute_id", "memo_text", TEMPERATURES, MAX_TOKENS, SEED)


def _redact_sql(text: str) -> str:
    for _, pattern, put in RE.SENSITIVE:
        text = f"regexp_replace({text}, '{pattern}', '{put}', 'g')"
    return text


_HITS = ", ".join(hits_sql("w", TX.STOPWORDS[x]) + f" AS h_{x}" for x in TX.LANGS)
_BEST = f"greatest({', '.join('h_' + x for x in TX.LANGS)}) AS best"
_UNREADABLE = (f"coalesce(length(memo_text) > 0 AND (length(memo_text) - length(translate(memo_text, '{RE.SYMBOLS}', ''))) "
               f"* {RE.UNREADABLE} >= length(memo_text), false)")


def _reply_sql() -> str:
    opening = " ".join(f"WHEN lang = '{k}' THEN {_lit(v)}" for k, v in RE.OPENINGS.items())
    steps = " ".join(f"WHEN dispute_category = '{c}' THEN " + " || merchant_name || ".join(_lit(p) for p in t.split("{0}"))
                     for c, t in TX.REPLY_TEMPLATES.items())
    return f"""
SELECT x.dispute_id, (CASE {opening} ELSE {_lit(RE.OPENINGS[TX.LANGS[0]])} END)
    || CASE WHEN quote <> '' THEN ' You wrote: "' || {_redact_sql('quote')} || '".' ELSE '' END || ' '
    || CASE {steps} ELSE 'We are reviewing the charge at ' || merchant_name || '.' END AS draft_reply
FROM (SELECT dispute_id, merchant_id, dispute_category, {_LANG_CASE} AS lang FROM (
    SELECT *, {_BEST} FROM (SELECT dispute_id, merchant_id, dispute_category, {_HITS}
      FROM (SELECT *, {WORDS_SQL} AS w FROM dispute_memos)))) x
JOIN ({_completed_sql({'quote': 0.0}, QUOTE_TOKENS)}) q ON x.dispute_id = q.dispute_id
JOIN raw_merchant_master m ON x.merchant_id = m.merchant_id"""


@query("t10_reply_memo", with_views(_reply_sql(), "dispute_memos", "raw_merchant_master"))
def t10_reply_memo(spark, sf_dir):
    """A reply to every memo: opening in its language, its own best sentence, next step of its category."""
    d = DT.dispute_memos(spark, sf_dir).select("dispute_id", "merchant_id", "dispute_category", "memo_text")
    m = DT.merchant_master(spark, sf_dir).select("merchant_id", "merchant_name")
    return RE.reply(d.join(m, "merchant_id"), "dispute_id", "memo_text", "dispute_category", "merchant_name", QUOTE_TOKENS)


def _triage_sql() -> str:
    by_category = " ".join(f"WHEN dispute_category = '{k}' THEN '{v}'" for k, v in RE.SEVERITY.items())
    action = " ".join(f"WHEN dispute_category = '{k}' THEN '{v}'" for k, v in TX.ACTIONS.items())
    return f"""
SELECT dispute_id, rule,
  CASE rule WHEN 'card_number' THEN 'HIGH' WHEN 'abuse' THEN 'HIGH' WHEN 'unreadable' THEN 'LOW' WHEN 'language' THEN 'MEDIUM'
    ELSE CASE {by_category} ELSE 'LOW' END END AS severity,
  coalesce(dispute_category IN ({_in(TX.REFUND_LABELS)}), false) AND NOT bad AS refund_recommended,
  CASE rule WHEN 'card_number' THEN 'Mask the card number and tell security' WHEN 'abuse' THEN 'Pass to a senior agent'
    WHEN 'unreadable' THEN 'Ask for a readable statement' WHEN 'language' THEN 'Pass to the desk for ' || lang
    ELSE CASE {action} ELSE 'Manual review' END END AS recommended_action
FROM (SELECT *, CASE WHEN coalesce(regexp_matches(memo_text, '[0-9]{{13,}}'), false) THEN 'card_number' WHEN abuse >= {RE.ABUSIVE} THEN 'abuse'
    WHEN bad THEN 'unreadable' WHEN coalesce(lang <> 'en', false) THEN 'language' ELSE 'category' END AS rule
  FROM (SELECT *, {_LANG_CASE} AS lang, {_UNREADABLE} AS bad FROM (SELECT *, {_BEST} FROM (
    SELECT dispute_id, dispute_category, memo_text, {_HITS}, coalesce({hits_sql('w', TX.ABUSE_TERMS)}, 0) AS abuse
    FROM (SELECT *, {WORDS_SQL} AS w FROM dispute_memos)))))"""


@query("t14_triage_memo", with_views(_triage_sql(), "dispute_memos"))
def t14_triage_memo(spark, sf_dir):
    """Triage of every memo by the first rule that its text or category meets."""
    return RE.triage(DT.dispute_memos(spark, sf_dir), "dispute_id", "memo_text", "dispute_category")


def _findings_sql() -> str:
    found = ", ".join(f"CASE WHEN regexp_matches(memo_text, '{p}') THEN '{name}' END"
                      for name, p in [("instruction", TX.INJECTION_PATTERN), *[(n, p) for n, p, _ in RE.SENSITIVE]])
    quoted = f"regexp_replace({_redact_sql('memo_text')}, '{TX.INJECTION_PATTERN}', '[quoted: \\1]', 'g')"
    return f"""
SELECT dispute_id,
  array_to_string(list_filter([{found}, CASE WHEN {_UNREADABLE} THEN 'symbols' END], lambda x: x IS NOT NULL), ', ') AS findings,
  '<memo>' || replace({quoted}, '</memo>', '</ memo>') || '</memo>' AS prompt
FROM dispute_memos"""


@query("t16_harden", with_views(_findings_sql(), "dispute_memos"))
def t16_harden(spark, sf_dir):
    """What each memo holds that must not reach a model, and the memo made safe."""
    return DT.dispute_memos(spark, sf_dir).select("dispute_id", F.array_join(RE.findings("memo_text"), ", ").alias("findings"),
                                                  RE.harden("memo_text").alias("prompt"))


HISTORY = 3


@query("p20_chat_history", f"""
SELECT u.conv_id, u.turn, CAST(count(*) AS BIGINT) AS n_turns,
  string_agg('[' || coalesce(h.role, '-') || '] ' || coalesce(h.text, ''), chr(10) ORDER BY h.turn) AS prompt
FROM (SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'user') u
JOIN conversations h ON h.conv_id = u.conv_id AND h.turn BETWEEN u.turn - {HISTORY} AND u.turn
GROUP BY u.conv_id, u.turn""")
def p20_chat_history(spark, sf_dir):
    """For every user turn, a prompt of it and the three turns before it; no conversation is gathered in one row."""
    return RE.chat_history(DT.read(spark, sf_dir, "conversations"), history=HISTORY)
