"""Answers written for a memo: completion with parameters (T13), replies (T10), triage (T14), hardened prompts.

``complete`` answers a request for a short summary with one sentence of the text.  A sentence scores the mean
IDF of its words over the corpus (``text_agg.sentence_scores``); at ``temperature`` T each sentence is drawn
with a probability in proportion to exp(score / T), by adding T times a Gumbel variate to its score.  The
variate is a function of seed, key and position, so a retried task draws the same sentence, and T = 0 takes the
best.  Equal scores go to the earlier sentence.  Only (key, position, score) is aggregated, one value a
temperature, and partially before the exchange; the text cuts its own sentence out afterwards.

``reply`` quotes that sentence, without personal data, between an opening in the memo's language and the next
step of the category.  ``triage`` is a table of rules over what the memo shows; the first that fits decides.
``harden`` names and removes what must not reach a model.

NULL text: no completion, no findings, a reply without a quote, the category's own triage.  An empty text has an
empty completion.  Keys must be unique.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardmart.functions import text as TX
from cardmart.operators.lexicon import argmax_label, hit_counts
from cardmart.operators.text_agg import SCORE_DIGITS, sentence_at, sentence_scores

# ------------------------------------------------------------------------------------------ completion


def uniform(seed: int, *parts: Column) -> Column:
    """A number between 0 and 1, neither included, from a hash of the seed and the parts."""
    name = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 32))


def complete(df: DataFrame, id_col: str, text_col: str, temperatures: Mapping[str, float], max_tokens: int = 60, seed: int = 7) -> DataFrame:
    """``id_col`` and one completion of at most ``max_tokens`` tokens for each named temperature."""
    if min(temperatures.values()) < 0:
        raise ValueError("a temperature is zero or more")
    scored = sentence_scores(df, [id_col], id_col, text_col)
    gumbel = -F.log(-F.log(uniform(seed, F.col(id_col), F.col("pos"))))

    def drawn(t: float) -> Column:
        score = F.round(F.col("score") + F.lit(float(t)) * gumbel, SCORE_DIGITS) if t else F.col("score")
        return F.max_by("pos", F.struct(score, -F.col("pos")))

    won = scored.groupBy(id_col).agg(*[drawn(t).alias(f"__at_{name}") for name, t in temperatures.items()])
    return df.select(id_col, text_col).join(won, id_col, "left").select(id_col, *[
        F.when(F.col(text_col).isNotNull(), F.coalesce(TX.truncate_tokens(sentence_at(text_col, F.col(f"__at_{name}")), max_tokens), F.lit("")))
        .alias(name) for name in temperatures])


# ------------------------------------------------------------------------------------------ hardened prompts

#: What must not reach a model: name, pattern, replacement.  They are replaced in this order.
SENSITIVE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+", "[email]"),
    ("key", r"[0-9a-f]{32,}", "[key]"),
    ("card_number", r"[0-9]{13,}", "[number]"),
    ("address", r"[0-9]{1,3}([.][0-9]{1,3}){3}", "[address]"),
    ("phone", r"[+][0-9][0-9 ()-]{7,}[0-9]", "[phone]"),
]
SYMBOLS = "#*$%&|<>"
#: A text is unreadable where one in so many of its characters is a symbol.
UNREADABLE = 20


def redact(text: str | Column) -> Column:
    out = F.col(text) if isinstance(text, str) else text
    for _, pattern, put in SENSITIVE:
        out = F.regexp_replace(out, pattern, put)
    return out


def unreadable(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    n = F.length(text)
    return F.coalesce((n > 0) & ((n - F.length(F.translate(text, SYMBOLS, ""))) * UNREADABLE >= n), F.lit(False))


def findings(text: str | Column) -> Column:
    """Names of what the text holds, in the order of the rules: an instruction, sensitive values, symbols."""
    text = F.col(text) if isinstance(text, str) else text
    found = [F.when(text.rlike(TX.INJECTION_PATTERN), "instruction"), *[F.when(text.rlike(p), name) for name, p, _ in SENSITIVE],
             F.when(unreadable(text), "symbols")]
    return F.when(text.isNotNull(), F.array_compact(F.array(*found)))


def harden(text: str | Column, tag: str = "memo") -> Column:
    """The text as data: sensitive values replaced, instructions marked as quotations, in delimiters."""
    return TX.as_data(F.regexp_replace(redact(text), TX.INJECTION_PATTERN, "[quoted: $1]"), tag)


# ------------------------------------------------------------------------------------------ replies

OPENINGS = {"en": "Thank you for your message.", "fr": "Merci de votre message.", "de": "Vielen Dank für Ihre Nachricht.",
            "es": "Gracias por su mensaje."}


def reply(df: DataFrame, id_col: str, text_col: str, category: str, merchant: str, quote_tokens: int = 25, temperature: float = 0.0) -> DataFrame:
    """``id_col`` and ``draft_reply``: opening, what the memo says, next step of the category."""
    quote = complete(df, id_col, text_col, {"__quote": temperature}, quote_tokens)
    langs = hit_counts(df.select(id_col, text_col), [id_col], text_col, TX.STOPWORDS)
    lang = F.coalesce(argmax_label([F.col(x) for x in TX.LANGS], TX.LANGS), F.lit(TX.LANGS[0]))
    opening = F.element_at(F.create_map(*[F.lit(x) for kv in OPENINGS.items() for x in kv]), lang)
    said = F.when(F.col("__quote") != "", F.concat(F.lit(' You wrote: "'), redact("__quote"), F.lit('".')))
    step = None
    for name, template in TX.REPLY_TEMPLATES.items():
        here = TX.prompt(template, merchant)
        step = F.when(F.col(category) == name, here) if step is None else step.when(F.col(category) == name, here)
    step = step.otherwise(TX.prompt("We are reviewing the charge at {0}.", merchant))
    return (df.select(id_col, category, merchant).join(quote, id_col).join(langs, id_col)
            .select(id_col, F.concat(opening, F.coalesce(said, F.lit("")), F.lit(" "), step).alias("draft_reply")))


# ------------------------------------------------------------------------------------------ triage

#: Severity of a category where the text itself gives no reason for another.
SEVERITY = {"FRAUD": "HIGH", "UNRECOGNIZED": "HIGH", "GOODS_NOT_RECEIVED": "MEDIUM", "DUPLICATE": "MEDIUM", "DEFECTIVE": "MEDIUM"}
#: Abusive words from which on a memo goes to a senior agent.
ABUSIVE = 2


def triage(df: DataFrame, id_col: str, text_col: str, category: str, abuse: Sequence[str] = TX.ABUSE_TERMS, home: str = "en") -> DataFrame:
    """``id_col``, the rule that fits first, ``severity``, ``refund_recommended`` and ``recommended_action``.

    A card number in the text, abuse, an unreadable text and a text in another language than ``home`` come
    before the category's own severity and action.  A refund is recommended by the category, unless the text is
    unreadable.
    """
    seen = df.select(id_col, text_col, F.col(category).alias("__category"), unreadable(text_col).alias("__unreadable"),
                     F.coalesce(F.col(text_col).rlike(dict((n, p) for n, p, _ in SENSITIVE)["card_number"]), F.lit(False)).alias("__number"))
    carried = ["__category", "__unreadable", "__number"]
    h = hit_counts(seen, [id_col], text_col, {"__abuse": abuse, **TX.STOPWORDS}, carry=carried)
    lang = argmax_label([F.col(x) for x in TX.LANGS], TX.LANGS)
    cat = F.col("__category")
    by_category = [F.when(cat == k, v) for k, v in SEVERITY.items()]
    action = [F.when(cat == k, v) for k, v in TX.ACTIONS.items()]
    rules = [
        ("card_number", F.col("__number"), F.lit("HIGH"), F.lit("Mask the card number and tell security")),
        ("abuse", F.col("__abuse") >= ABUSIVE, F.lit("HIGH"), F.lit("Pass to a senior agent")),
        ("unreadable", F.col("__unreadable"), F.lit("LOW"), F.lit("Ask for a readable statement")),
        ("language", F.coalesce(lang != home, F.lit(False)), F.lit("MEDIUM"), F.concat(F.lit("Pass to the desk for "), lang)),
        ("category", F.lit(True), F.coalesce(*by_category, F.lit("LOW")), F.coalesce(*action, F.lit("Manual review"))),
    ]
    first = F.coalesce(*[F.when(fits, F.struct(F.lit(name).alias("rule"), severity.alias("severity"), act.alias("recommended_action")))
                         for name, fits, severity, act in rules])
    refund = F.coalesce(cat.isin(*TX.REFUND_LABELS), F.lit(False)) & ~F.col("__unreadable")
    return h.withColumn("__t", first).select(id_col, "__t.rule", "__t.severity", refund.alias("refund_recommended"), "__t.recommended_action")


# ------------------------------------------------------------------------------------------ chat prompts


def chat_history(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 history: int = 3, asking: str = "user") -> DataFrame:
    """P20: for every turn of ``asking``, a prompt of it and the ``history`` turns before it, in order.

    Each turn is sent to the turns that may quote it, so rows meet by (conversation, turn), at most
    ``history + 1`` of them while turn numbers are unique, and no conversation meets in one task.  Rows without a conversation
    or turn are left out; a NULL text is an empty line.
    """
    line = F.concat(F.lit("["), F.coalesce(F.col(role), F.lit("-")), F.lit("] "), F.coalesce(F.col(text), F.lit("")))
    sent = (turns.where(F.col(conversation).isNotNull() & F.col(turn).isNotNull())
            .select(F.col(conversation).alias("__c"), F.col(turn).alias("__t"), F.coalesce(F.col(role) == asking, F.lit(False)).alias("__ask"),
                    line.alias("__line"), F.explode(F.sequence(F.lit(0), F.lit(history))).alias("__ahead"))
            .withColumn("__to", F.col("__t") + F.col("__ahead")))
    met = sent.groupBy("__c", "__to").agg(
        F.max((F.col("__ahead") == 0) & F.col("__ask")).alias("__own"),
        F.array_sort(F.collect_list(F.struct("__t", "__line"))).alias("__lines"))
    return met.where("__own").select(F.col("__c").alias(conversation), F.col("__to").alias(turn), F.size("__lines").cast("long").alias("n_turns"),
                                     F.array_join(F.transform("__lines", lambda x: x["__line"]), "\n").alias("prompt"))
