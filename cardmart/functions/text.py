"""Text operators as native column expressions.

The source pipeline calls hosted language models; here each function has a
fixed signature and a deterministic, documented rule that runs inside the
JVM (regex extraction, higher-order array functions, ``CASE``), so it stays in
whole-stage code generation and needs no Python worker.  ``ai_map`` (T15) is
the one plug-in point for a real model.

Shared definitions (identical in the DuckDB oracle):

* token  -- a run of ``[A-Za-z0-9]`` or any single other non-blank character;
* word   -- a run of ``[a-z]`` in the lower-cased text;
* lexicon hit -- a word that is in the lexicon (each occurrence counts).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r]"
WORD_PATTERN = r"[a-z]+"
# Named tokenizers for token_count(model, text): all use the same rule here;
# the name is kept so callers can route a real tokenizer through T15.
TOKENIZERS = {"default": TOKEN_PATTERN, "words": r"[A-Za-z0-9]+"}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column, tokenizer: str = "default") -> Column:
    return F.regexp_extract_all(_c(text), F.lit(TOKENIZERS[tokenizer]), 0)


def token_count(text: str | Column, tokenizer: str = "default") -> Column:
    """Number of tokens (NULL text -> NULL)."""
    return F.size(tokens(text, tokenizer)).cast("long") * F.when(_c(text).isNotNull(), 1)


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 0)


def lexicon_hits(word_array: Column, lexicon: Sequence[str]) -> Column:
    """Occurrences of lexicon words in an array of words."""
    lex = sorted(set(lexicon))
    return F.size(F.filter(word_array, lambda w: w.isin(*lex)))


# --- T01 / T02 sentiment ---------------------------------------------------------------------

# FIXED VALUES: sentiment lexicons (English, French, German, Spanish).
POSITIVE = ["good", "great", "excellent", "happy", "thanks", "thank", "resolved", "pleased",
            "satisfied", "helpful", "fair", "best", "better", "well", "bien", "merci", "bon",
            "gut", "danke", "gracias", "bueno", "mejor"]
NEGATIVE = ["bad", "never", "not", "no", "refused", "fraud", "damaged", "defective", "wrong",
            "unfamiliar", "angry", "poor", "worst", "terrible", "trash", "pathetic", "disgusting",
            "worthless", "stupid", "pas", "ne", "nicht", "kein", "nunca"]


def sentiment_label(text: str | Column, positive: Sequence[str] = POSITIVE,
                    negative: Sequence[str] = NEGATIVE) -> Column:
    """positive / negative by the sign of (positive - negative) hits; 0 with any hit is
    mixed; no hit is neutral."""
    w = words(text)
    pos, neg = lexicon_hits(w, positive), lexicon_hits(w, negative)
    return F.when(_c(text).isNull(), F.lit(None).cast("string")).otherwise(
        sentiment_rule(pos, neg))


def sentiment_rule(pos: Column, neg: Column) -> Column:
    """Label from positive / negative hit counts."""
    return (F.when(pos > neg, "positive").when(pos < neg, "negative")
            .when(pos + neg > 0, "mixed").otherwise("neutral"))


def sentiment(text: str | Column, positive: Sequence[str] = POSITIVE,
              negative: Sequence[str] = NEGATIVE) -> Column:
    """``{categories: [{name: 'overall', sentiment}]}`` as a struct."""
    item = F.struct(F.lit("overall").alias("name"),
                    sentiment_label(text, positive, negative).alias("sentiment"))
    return F.struct(F.array(item).alias("categories"))


# --- T04 language detection / glossary translation -------------------------------------------

# FIXED VALUES: function words per language, used to detect the language.
STOPWORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with",
           "this", "are", "at", "from", "by", "as", "be"],
    "fr": ["le", "la", "les", "de", "des", "et", "que", "qui", "une", "un", "du", "pour", "est",
           "dans", "sur", "pas", "par", "au", "avec", "elle"],
    "de": ["der", "die", "und", "das", "den", "zu", "von", "ein", "mit", "sich", "auf", "ist",
           "nicht", "dem", "im", "als", "eine", "des", "wird", "auch"],
    "es": ["el", "la", "que", "de", "y", "los", "las", "del", "se", "por", "un", "una", "para",
           "con", "no", "su", "es", "en", "al", "lo"],
}
LANGS = ["en", "fr", "de", "es"]


def detect_language(text: str | Column) -> Column:
    """Language with the most stop-word hits; ties to the first of en, fr, de, es;
    no hit -> NULL."""
    w = words(text)
    hits = {lang: lexicon_hits(w, STOPWORDS[lang]) for lang in LANGS}
    best = F.greatest(*hits.values())
    out = F.when(best <= 0, F.lit(None).cast("string"))
    for lang in LANGS:
        out = out.when(hits[lang] == best, lang)
    return out


# FIXED VALUES: a small en->es / en->fr glossary of card-dispute vocabulary.
GLOSSARY = {
    ("en", "es"): {"card": "tarjeta", "charge": "cargo", "refund": "reembolso",
                   "merchant": "comercio", "customer": "cliente", "order": "pedido",
                   "never": "nunca", "received": "recibido", "the": "el", "and": "y"},
    ("en", "fr"): {"card": "carte", "charge": "débit", "refund": "remboursement",
                   "merchant": "commerçant", "customer": "client", "order": "commande",
                   "never": "jamais", "received": "reçu", "the": "le", "and": "et"},
}


def translate(text: str | Column, source: str, target: str) -> Column:
    """Glossary substitution word by word (whitespace kept as single spaces).

    ``source`` '' means detect; text in another language than the glossary's
    source is returned unchanged.  Free translation needs a model (T15).
    """
    gl = GLOSSARY.get(("en" if source == "" else source, target), {})
    m = F.create_map(*[F.lit(x) for kv in sorted(gl.items()) for x in kv])
    parts = F.split(_c(text), r"\s+")
    swapped = F.array_join(F.transform(
        parts, lambda p: F.coalesce(F.try_element_at(m, F.lower(p)), p)), " ")
    if source == "":
        return F.when(detect_language(text) == "en", swapped).otherwise(_c(text))
    return swapped


# --- T05 extract answer ------------------------------------------------------------------------

# FIXED VALUES: answer slots -- question keyword -> pattern; the answer is group 1,
# fenced by non-digits so a reason code is not read out of an amount.
SLOTS = [
    ("amount", r"(?:^|[^0-9.])([0-9]+\.[0-9]{2})(?:[^0-9]|$)"),
    ("email", r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"),
    ("date", r"(?:^|[^0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[^0-9]|$)"),
    ("reason", r"(?:^|[^0-9.])([0-9]{2}\.[0-9])(?:[^0-9]|$)"),
    ("currency", r"(?:^|[^A-Z])(USD|GBP|EUR|CAD|AUD|JPY|INR)(?:[^A-Z]|$)"),
]


def slot_for(question: str) -> str | None:
    """Slot that a question asks for, or ``None`` for a question outside all slots."""
    q = question.lower()
    for name, _ in SLOTS:
        if name in q:
            return name
    if "why" in q:
        return "reason"
    if "when" in q:
        return "date"
    if "much" in q:
        return "amount"
    return "email" if "contact" in q else None


def extract_answer(text: str | Column, question: str) -> Column:
    """``[{answer, score}]`` -- the first match of the question's slot pattern,
    score 1.0; no match, or a question outside all slots, is an empty array."""
    none = F.array().cast("array<struct<answer:string,score:double>>")
    slot = slot_for(question)
    if slot is None:
        return F.when(_c(text).isNotNull(), none)
    pattern = dict(SLOTS)[slot]
    m = F.regexp_extract(_c(text), pattern, 1)
    item = F.struct(m.alias("answer"), F.lit(1.0).alias("score"))
    return F.when(m == "", none) \
        .otherwise(F.array(item))


def top_answer(text: str | Column, question: str) -> Column:
    """``EXTRACT_ANSWER(...)[0]:answer::string``: NULL when nothing matched."""
    return F.try_element_at(extract_answer(text, question), F.lit(1)).getField("answer")


# --- T07 classification -------------------------------------------------------------------------

# FIXED VALUES: keywords of the dispute taxonomy (used when labels carry no description).
DISPUTE_KEYWORDS = {
    "FRAUD": ["fraud", "fraudulent", "stolen", "unauthorized", "recognize", "possession"],
    "GOODS_NOT_RECEIVED": ["delivered", "delivery", "received", "tracking", "carrier", "shipped"],
    "DUPLICATE": ["duplicate", "twice", "identical", "double", "captured"],
    "SUBSCRIPTION": ["subscription", "cancelled", "canceled", "recurring", "billed", "renewal"],
    "DEFECTIVE": ["defective", "damaged", "broken", "photos", "return"],
    "REFUND_NOT_PROCESSED": ["refund", "credit", "processed", "appeared"],
    "AMOUNT_MISMATCH": ["quoted", "price", "total", "mismatch", "incorrect"],
    "UNRECOGNIZED": ["unfamiliar", "descriptor", "unknown", "proof"],
}
# FIXED VALUES: words ignored when keywords are taken from a label description.
DESCRIPTION_STOPWORDS = ["the", "a", "an", "of", "or", "and", "to", "for", "is", "was", "but",
                         "by", "on", "in", "with", "not", "that", "this", "it", "be", "as"]


def keywords_from_labels(labels: Sequence[str | Mapping[str, str]]) -> dict[str, list[str]]:
    """Labels may be plain strings or ``{label, description}``; a description's words
    become that label's keywords (richer categories -> better recall)."""
    out: dict[str, list[str]] = {}
    for lab in labels:
        if isinstance(lab, Mapping):
            name = lab["label"]
            desc = re.findall(WORD_PATTERN, lab.get("description", "").lower())
            kws = [w for w in desc if w not in DESCRIPTION_STOPWORDS]
            out[name] = sorted(set(kws + DISPUTE_KEYWORDS.get(name, [])))
        else:
            out[lab] = DISPUTE_KEYWORDS.get(lab, [lab.lower()])
    return out


def classify_label(text: str | Column, labels: Sequence[str | Mapping[str, str]],
                   keywords: Mapping[str, Sequence[str]] | None = None) -> Column:
    """T07 (a): the label with the most keyword hits; tie -> first label in order;
    no hit -> NULL."""
    kw = dict(keywords) if keywords is not None else keywords_from_labels(labels)
    names = [lab["label"] if isinstance(lab, Mapping) else lab for lab in labels]
    w = words(text)
    hits = [lexicon_hits(w, kw[n]) for n in names]
    best = F.greatest(*hits) if len(hits) > 1 else hits[0]
    out = F.when(best <= 0, F.lit(None).cast("string"))
    for n, h in zip(names, hits):
        out = out.when(h == best, F.lit(n))
    return out


def classify(text: str | Column, labels: Sequence[str | Mapping[str, str]],
             keywords: Mapping[str, Sequence[str]] | None = None) -> Column:
    """``{labels: [label]}`` (empty array when nothing matched)."""
    lab = classify_label(text, labels, keywords)
    return F.struct(F.when(lab.isNull(), F.array().cast("array<string>"))
                    .otherwise(F.array(lab)).alias("labels"))


# --- T09 natural-language filter ---------------------------------------------------------------

# Topics that a filter instruction can name, with the terms looked for.
FRAUD_TERMS = ["fraud", "fraudulent", "stolen", "unauthorized", "recognize", "unfamiliar",
               "unknown", "scam", "suspicious"]
ABUSE_TERMS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid",
               "trash", "worthless"]
TOPICS = {"fraud": FRAUD_TERMS, "abus": ABUSE_TERMS, "insult": ABUSE_TERMS}


def terms_for(instruction: str) -> list[str]:
    """Terms of all topics that an instruction names; an instruction without a known topic is an error."""
    found = sorted({t for name, terms in TOPICS.items() if name in instruction.lower() for t in terms})
    if not found:
        raise ValueError(f"no known topic in the instruction: {instruction!r}")
    return found


def ai_filter(text: str | Column, terms: Sequence[str] = FRAUD_TERMS,
              threshold: float = 0.001) -> Column:
    """Topic-term hits / words >= threshold (double division; zero words -> false)."""
    w = words(text)
    return filter_rule(lexicon_hits(w, terms), F.size(w), threshold)


def filter_rule(hits: Column, n_words: Column, threshold: float) -> Column:
    """hits / words >= threshold in double; zero words -> false."""
    return F.coalesce(F.when(n_words > 0, (hits.cast("double") / n_words.cast("double"))
                             >= F.lit(threshold)), F.lit(False))


# --- P20 prompt templates / T10 replies / T13 truncation ---------------------------------------

def prompt(template: str, *args: str | Column) -> Column:
    """P20: ``PROMPT('... {0} ...', col)`` -- literal pieces and arguments concatenated;
    a NULL argument makes the prompt NULL."""
    pieces = re.split(r"(\{[0-9]+\})", template)
    cols = []
    for p in pieces:
        m = re.fullmatch(r"\{([0-9]+)\}", p)
        if m:
            cols.append(_c(args[int(m.group(1))]))
        elif p:
            cols.append(F.lit(p))
    return F.concat(*cols)


# FIXED VALUES: reply templates by dispute category ({0} = merchant name).
REPLY_TEMPLATES = {
    "FRAUD": "We have blocked further charges and opened a fraud review of the charge at {0}.",
    "GOODS_NOT_RECEIVED": "We have asked {0} for proof of delivery and will update you.",
    "DUPLICATE": "We are checking with {0} whether the charge was captured twice.",
    "SUBSCRIPTION": "We have asked {0} to confirm the cancellation of your subscription.",
    "DEFECTIVE": "We have asked {0} to respond about the condition of the item.",
    "REFUND_NOT_PROCESSED": "We have asked {0} for the status of the promised credit.",
    "AMOUNT_MISMATCH": "We have asked {0} for the receipt of the amount charged.",
    "UNRECOGNIZED": "We have asked {0} for proof of the transaction.",
}
REPLY_OPENING = "Thank you for contacting us about your dispute. "
REPLY_CLOSING = " We will be in touch within ten business days."


def draft_reply(category: str | Column, merchant_name: str | Column) -> Column:
    """A polite, non-committal reply rendered from the category's template."""
    out = None
    for cat, tpl in REPLY_TEMPLATES.items():
        body = prompt(REPLY_OPENING + tpl + REPLY_CLOSING, merchant_name)
        out = F.when(_c(category) == cat, body) if out is None else out.when(_c(category) == cat, body)
    generic = prompt(REPLY_OPENING + "We are reviewing the charge at {0}." + REPLY_CLOSING,
                     merchant_name)
    return out.otherwise(generic)


def truncate_tokens(text: str | Column, max_tokens: int) -> Column:
    """T13 ``max_tokens``: the first ``max_tokens`` tokens joined by single spaces."""
    return F.array_join(F.slice(tokens(text), 1, max_tokens), " ")


# --- T14 structured triage ---------------------------------------------------------------------

# Triage rules (parameters).
SEVERITY_TERMS = ["fraud", "fraudulent", "stolen", "unauthorized", "chargeback", "never",
                  "refused", "damaged"]
REFUND_LABELS = ["DUPLICATE", "REFUND_NOT_PROCESSED", "DEFECTIVE", "GOODS_NOT_RECEIVED",
                 "AMOUNT_MISMATCH"]
ACTIONS = {
    "FRAUD": "Block card and file chargeback",
    "UNRECOGNIZED": "Request transaction proof from merchant",
    "GOODS_NOT_RECEIVED": "Request proof of delivery",
    "DUPLICATE": "Reverse duplicate capture",
    "SUBSCRIPTION": "Request cancellation evidence",
    "DEFECTIVE": "Request merchant response on return",
    "REFUND_NOT_PROCESSED": "Chase merchant credit",
    "AMOUNT_MISMATCH": "Request itemised receipt",
}
TRIAGE_SCHEMA = "struct<severity:string,refund_recommended:boolean,recommended_action:string>"


def triage(text: str | Column, label: str | Column) -> Column:
    """``{severity, refund_recommended, recommended_action}``.

    severity HIGH with >= 3 severity-term hits, MEDIUM with >= 1, else LOW;
    refund recommended for labels in ``REFUND_LABELS``; action by label.
    """
    return triage_rule(lexicon_hits(words(text), SEVERITY_TERMS), label)


def triage_rule(severity_hits: Column, label: str | Column) -> Column:
    """The triage struct from the severity-term hit count and the predicted label."""
    hits = severity_hits
    sev = F.when(hits >= 3, "HIGH").when(hits >= 1, "MEDIUM").otherwise("LOW")
    lab = _c(label)
    refund = F.coalesce(lab.isin(*REFUND_LABELS), F.lit(False))
    act = None
    for k, v in ACTIONS.items():
        act = F.when(lab == k, v) if act is None else act.when(lab == k, v)
    act = act.otherwise("Manual review")
    return F.struct(sev.alias("severity"), refund.alias("refund_recommended"),
                    act.alias("recommended_action"))


def parse_triage(json_text: str | Column) -> Column:
    """Model output (JSON text) -> typed struct; malformed JSON -> NULL fields."""
    return F.from_json(_c(json_text), TRIAGE_SCHEMA, {"mode": "PERMISSIVE"})


# --- T16 prompt hardening ------------------------------------------------------------------------

# FIXED VALUES: patterns of instructions embedded in data.
INJECTION_PATTERN = (r"(?i)(ignore (all |any |the )?(previous|prior|above) instructions"
                     r"|disregard (all |any |the )?(previous|prior|above)"
                     r"|you are now|system prompt|new instructions:|act as an? )")


def injection_flag(text: str | Column) -> Column:
    """The text contains an instruction-like phrase (it is still passed as data)."""
    return F.coalesce(_c(text).rlike(INJECTION_PATTERN), F.lit(False))


def as_data(text: str | Column, tag: str = "memo") -> Column:
    """Wrap text in delimiters, neutralising any closing delimiter inside it."""
    close = f"</{tag}>"
    return F.concat(F.lit(f"<{tag}>"), F.replace(_c(text), F.lit(close), F.lit(f"</ {tag}>")),
                    F.lit(close))
