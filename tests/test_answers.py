"""Classification, answers, filters, paths and profiles against plain Python."""

import math
import random
import re
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardmart.functions import variant as VA
from cardmart.operators import answers as AN, bayes as NB, instruct as IN, profile as P
from cardmart.operators.quality import differing_buckets, parity, parity_by_bucket


def words(text):
    return re.findall("[a-z]+", text.lower())


# ---------------------------------------------------------------- T07

def bayes_by_hand(labels, examples, text, alpha=1.0):
    counts = {name: Counter(words(d)) for name, d in NB.described(labels).items()}
    texts = dict.fromkeys(counts, 1)
    for t, y in examples:
        if t is not None and y in counts:
            counts[y].update(words(t))
            texts[y] += 1
    known = set().union(*counts.values())
    score = {y: math.log(texts[y] / sum(texts.values())) + sum(
        math.log((c[w] + alpha) / (sum(c.values()) + alpha * len(known))) for w in words(text) if w in known) for y, c in counts.items()}
    return max(counts, key=lambda y: score[y])


def test_bayes_against_plain_counts(spark):
    rng = random.Random(5)
    vocabulary = {"a": "red blue green one two", "b": "cat dog bird two three", "LONG_NAME": "x y z three one"}
    labels = ["LONG_NAME", {"label": "a", "description": "colours: red"}, {"label": "b", "description": "animals"}]
    make = lambda y: " ".join(rng.choices(vocabulary[y].split(), k=rng.randrange(1, 9)))
    examples = [(make(y), y) for y in ("a", "b", "LONG_NAME") for _ in range(12)] + [(None, "a"), ("red", "other"), ("", "b")]
    texts = [make(rng.choice("ab")) for _ in range(60)] + ["", "unknown words only", None, "RED, red!", "long name", "animals"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    ex = spark.createDataFrame(examples, "text string, label string")
    for used in ([], examples):
        model = NB.fit(spark, labels, ex if used else None)
        got = {r["id"]: r for r in NB.classify(df, ["id"], "text", model).collect()}
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert got[i]["predicted"] == (None if t is None else bayes_by_hand(labels, used, t)), (i, t)
    assert got[len(texts) - 5]["n_known"] == 0
    label = df.limit(1).select(NB.labels_object(F.lit("a")).alias("c")).select(VA.path("c:labels[0]::string")).first()[0]
    assert label == "a"


def test_examples_raise_held_out_accuracy(spark):
    from cardmart.plans.catalog import QUERIES, load_all
    load_all()
    got = {r["task"]: r for r in QUERIES["a08_accuracy_bayes"](spark, "/root/testdata/sf0.001").collect()}
    assert got["lang_examples"]["accuracy_pct"] >= got["lang_described"]["accuracy_pct"]
    assert got["toxic_examples"]["accuracy_pct"] > got["toxic_described"]["accuracy_pct"]


# ---------------------------------------------------------------- T05

def test_answers_against_plain_bm25(spark):
    texts = ["The quick fox ran. A slow fox slept! Nothing here", "fox fox fox\nthe dog met a fox. dog", None, "", "...", "no such word",
             "Refund of $12.50 was promised. The amount is $99.00 for the fox"]
    question = "What is said about the fox and a dog?"
    terms = AN.question_terms(question)
    assert terms == ["fox", "dog"]
    parts = [[s for s in re.split(r"[.!?]+\s+|[.!?]+$|\n+", t) if words(s)] if t is not None else None for t in texts]
    every = [words(s) for p in parts if p for s in p]
    mean = sum(map(len, every)) / len(every)
    weight = {t: math.log(1 + (len(every) - k + 0.5) / (k + 0.5)) for t in terms for k in [sum(t in s for s in every)]}

    def score(sentence):
        w = words(sentence)
        return round(sum(weight[t] * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / mean)) for t in terms), 4)

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r["id"]: r["answers"] for r in AN.answers(df, "text", question, k=2).collect()}
    for i, p in enumerate(parts):
        if p is None:
            assert got[i] is None
            continue
        want = sorted(((-score(s), k) for k, s in enumerate(p) if score(s) > 0))[:2]
        assert [a["score"] for a in got[i]] == pytest.approx([-s for s, _ in want], abs=1e-4)
        for a, (_, k) in zip(got[i], want):
            assert a["answer"] in p[k] and words(a["answer"])[0] in terms and words(a["answer"])[-1] in terms
    amounts = {r["id"]: r["answers"] for r in AN.answers(df, "text", "What is the amount for the fox?").collect()}
    assert [a["answer"].lstrip("$") for a in amounts[6]] == ["99.00"] and amounts[0] == []
    none = [r["answers"] for r in AN.answers(df, "text", "what is the?").collect()]
    assert sorted(none, key=str) == sorted([None if t is None else [] for t in texts], key=str)


# ---------------------------------------------------------------- T09

def test_instructions_find_their_own_words(spark):
    rng = random.Random(3)
    plain = [" ".join(rng.choices("one two three four five six".split(), k=12)) + "." for _ in range(200)]
    loans = [f"{plain[i]} The lender charged interest on the loan." for i in range(12)]
    ships = [f"{plain[i]} The vessel left the harbour with cargo." for i in range(12)]
    hidden = ["The lender charged interest.", "A vessel in the harbour with cargo."]
    rows = plain[:150] + loans + ships + hidden + [None, ""]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    kept = {}
    for about in ("Keep texts about a loan", "Find any text that mentions a vessel"):
        got = {r["id"]: r for r in IN.filter_by_instruction(df, "text", about).collect()}
        assert not got[len(rows) - 2]["keep"] and got[len(rows) - 2]["score"] is None
        kept[about] = {i for i, r in got.items() if r["keep"]}
    a, b = kept.values()
    assert a == {*range(150, 162), 174} and b == {*range(162, 174), 175}  # the last of each does not hold the asked word, or only company
    assert not any(r["keep"] for r in IN.filter_by_instruction(df, "text", "the of and").collect())
    assert not any(r["keep"] for r in IN.filter_by_instruction(df, "text", "keep texts about zebras").collect())


# ---------------------------------------------------------------- P18

def test_paths(spark):
    rows = [(1, '{"a":[{"b":1,"c d":"x"},{"b":"two"}],"n":null}'), (2, "no json"), (3, None), (4, "[1,[2,3]]"), (5, "{}")]
    v = spark.createDataFrame(rows, "id int, t string").select("id", VA.json("t").alias("v"))
    got = v.select("id", VA.path("v:a[0].b::int").alias("b0"), VA.path("v:a[1].b::int").alias("b1"), VA.path('v:a[0]."c d"::string').alias("odd"),
                   VA.path("v[1][0]::int").alias("deep"), VA.path("v:n::string").alias("n")).orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [(1, None, "x", None, None), (None,) * 5, (None,) * 5, (None, None, None, 2, None), (None,) * 5]
    items = VA.elements(v, "v").select("id", "pos", "key").orderBy("id", "pos").collect()
    assert [tuple(r) for r in items] == [(1, 0, "a"), (1, 1, "n"), (4, 0, None), (4, 1, None)]
    for bad in ("v", "v:", "v:a..b", "v:a[x]"):
        with pytest.raises(ValueError):
            VA.path(bad)


# ---------------------------------------------------------------- Q08

def test_exact_quantiles(spark):
    rng = random.Random(8)
    rows = [("a", Decimal(rng.randrange(-10 ** 9, 10 ** 9)) / 100) for _ in range(997)] + [("b", Decimal("5.25"))] * 40
    rows += [("c", Decimal(k)) for k in (1, 2)] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x decimal(12,2)").repartition(3)
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = P.exact_quantiles(df, "x", shares, "g", bins=16)
    for g in "abc":
        own = sorted(x for y, x in rows if y == g and x is not None)
        assert got[g] == [own[max(1, math.ceil(s * len(own))) - 1] for s in shares]
    assert "d" not in got


def test_heavy_values_are_complete_and_exact(spark):
    rng = random.Random(9)
    rows = [(f"v{int(rng.paretovariate(0.7))}",) for _ in range(5000)] + [(None,)] * 50
    df = spark.createDataFrame(rows, "m string").repartition(7)
    n = Counter(r[0] for r in rows if r[0])
    for share in (0.3, 0.05, 0.01):
        got = {r["m"]: r["n"] for r in P.heavy_values(df, "m", share).collect()}
        assert got == {m: k for m, k in n.items() if k > 5000 * share}
    assert P.heavy_values(df.limit(0), "m", 0.1).count() == 0


def test_heavy_values_of_tasks_without_any(spark):
    """Every value is as frequent as the others, so that the counters of a task end empty."""
    df = spark.range(0, 2000, 1, 2).select((F.col("id") % 1000).cast("string").alias("m"))
    assert P.heavy_values(df, "m", 0.01).count() == 0
    one = df.unionByName(spark.range(100).select(F.lit("big").alias("m")))
    assert [tuple(r) for r in P.heavy_values(one, "m", 0.01).collect()] == [("big", 100, 2100)]


# ---------------------------------------------------------------- X02

def test_parity_by_bucket_compares_only_what_differs(spark):
    rows = [(i, f"v{i % 50}", Decimal(i)) for i in range(3000)]
    a = spark.createDataFrame(rows, "id long, v string, x decimal(12,2)").repartition(4)
    b = spark.createDataFrame(rows[::-1], "id long, v string, x decimal(12,2)").repartition(3)
    same = parity_by_bucket(a, b, ["id"])
    assert [x.count() for x in same] == [0, 0]
    plan = same[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(id" not in plan and "Except" not in plan  # equal builds: no rows are shuffled
    changed = [(i, "other" if i in (7, 2000) else v, x) for i, v, x in rows if i != 11] + [rows[5]]
    c = spark.createDataFrame(changed, "id long, v string, x decimal(12,2)")
    assert 1 <= len(differing_buckets(a, c, ["id"])) <= 4
    for got, want in zip(parity_by_bucket(a, c, ["id"]), parity(a, c)):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_parity_counts_both_sides_in_one_shuffle(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y"), (3, "y"), (3, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (3, "y"), (4, "z")], "id int, v string")
    only_a, only_b = parity(a, b)
    assert sorted(map(tuple, only_a.collect())) == [(1, "x"), (3, "y"), (3, "y")]
    assert sorted(map(tuple, only_b.collect()), key=str) == [(2, None), (4, "z")]
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = only_a.unionByName(only_b)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning") == 2  # the second is the one reused
