"""Edge cases and brute-force checks of the training-data operators."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardmart.llm import fingerprint, kneser_ney, mixing, neardup, packing, quality, sharding, toxicity, urlfilter, warc
from cardmart.llm.common import Scratch, WordHash

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# ------------------------------------------------------------ 1

def water(budget, children):
    """Budgets of (name, cap, weight) children, by filling one after the other."""
    left, open_, out = budget, list(children), {}
    while open_:
        total = sum(w for _, _, w in open_)
        full = [c for c in open_ if c[1] * total <= left * c[2]]
        if not full:
            return out | {n: min(int(left * w // total), cap) for n, cap, w in open_}
        first = min(full, key=lambda c: c[1] / c[2])
        out[first[0]] = first[1]
        left -= first[1]
        open_.remove(first)
    return out


def test_mixing_budgets_against_recursive_filling(spark):
    rng = random.Random(3)
    for total in (0, 50, 900, 10 ** 6):
        leaves = [(d, lang, s, rng.choice([0, 5, 40, 300])) for d in ("note", "article") for lang in ("en", "de", None)
                  for s in ("src0", "src1", "src9")]
        got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in rows_of(mixing.leaf_budgets(
            spark.createDataFrame(leaves, "domain string, lang string, source string, supply long"), total, max_epochs=2))}
        weight = lambda level, v: mixing.WEIGHTS[level].get(v, 1)

        def fill(budget, rows, depth):
            if depth == 3:
                return {rows[0][:3]: budget}
            by = defaultdict(list)
            for r in rows:
                by[r[depth]].append(r)
            caps = [(v, 2 * sum(r[3] for r in g), weight(mixing.LEVELS[depth], v)) for v, g in by.items()]
            dealt = water(budget, caps)
            return {k: x for v, g in by.items() for k, x in fill(dealt[v], g, depth + 1).items()}

        want = fill(min(total, 2 * sum(x[3] for x in leaves)), leaves, 0)
        assert sum(got.values()) <= total
        for k, v in want.items():
            assert abs(got[k] - v) <= 3, (k, v, got[k])  # rounding down at three levels


def test_mixing_takes_a_prefix_of_the_seeded_order(make_docs, odd_rows, no_docs):
    docs = make_docs([(i, "w " * (i % 17 + 1)) for i in range(400)])
    got = rows_of(mixing.mix(docs, budget_share=0.5))
    leaves = defaultdict(list)
    for r in got:
        place = hashlib.md5(f"{mixing.SEED}|{r['whole_epochs']}|{r['doc_id']}|{r['text_md5']}".encode()).hexdigest()
        leaves[r["domain"], r["lang"], r["source"]].append((place, r))
    for rows in leaves.values():
        budget, run = rows[0][1]["leaf_budget"], 0
        if rows[0][1]["whole_epochs"]:
            assert all(r["epochs"] == 1 for _, r in rows)
            continue
        for _, r in sorted(rows, key=lambda x: x[0]):
            run += r["n_tokens"]
            assert r["in_prefix"] == (run <= budget)
    odd = rows_of(mixing.mix(make_docs(odd_rows), budget_share=1.0))
    assert len(odd) == len(odd_rows)
    assert mixing.mix(no_docs).count() == 0


# ------------------------------------------------------------ 2

def base_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = Counter(zip(words, words[1:], words[2:]))
    hit = {p for i in range(len(words) - 2) if wins[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def test_quality_counts_and_guards(make_docs, odd_rows, no_docs):
    rows = odd_rows + [(20, "a b c a b c\n x y \nx y\n x y ")]
    got = quality.judge_documents(make_docs(rows))
    assert set(got.columns) > {"score", "shard", "n_words"}  # extra columns stay
    for r in rows_of(got):
        q, c = r[quality.QUALITY], r[quality.QUALITY]["counts"]
        want = base_rules(r["text"])
        assert (c["n_words"], c["word_chars"], c["n_symbols"], c["n_dup_lines"], c["n_repeat_words"]) == want
        assert q["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (q["base_failed"] and q["kept"])
        assert sum(c["classes"]) == c["n_chars"]  # every code point in one class
        assert (q["class_distance"] is None) == (c["n_chars"] == 0) and (r["lang"] in quality.COMMON_WORDS or q["word_distance"] is None)
    assert quality.judge_documents(no_docs).count() == 0


def test_quality_judges_every_language(spark):
    """Junk goes whatever its language is called, null and very rare ones included; clean text stays."""
    clean = lambda i: " ".join(f"{chr(97 + (i * 7 + k) % 26)}{chr(97 + k % 24)}um." for k in range(90))
    wide = lambda i: " ".join("\u6587\u5b57" + chr(0x4E00 + (i * 31 + k) % 900) for k in range(90))
    junk = " ".join(f"#{k}$%&" + "9" * (k % 5 + 3) for k in range(90))
    names = ["en", "ja", None]
    rows = [(n * 1000 + i, clean(i), lang) for n, lang in enumerate(names) for i in range(400)]
    rows += [(5000 + i, wide(i), "zh") for i in range(400)] + [(9000 + n, junk, lang) for n, lang in enumerate(names + ["zh", "rare"])]
    rows += [(9900, clean(5), "few"), (9901, "\U0001F600\u00e9\u6587a", "zh")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r[quality.QUALITY] for r in quality.judge_documents(df).collect()}
    assert len(got) == len(rows)
    assert not any(got[9000 + n]["kept"] or got[9000 + n]["base_failed"] for n in range(5))
    assert got[9901]["counts"]["classes"] == [0, 0, 0, 0, 0, 3, 1]
    assert all(q["kept"] for k, q in got.items() if k < 9000 and q["word_distance"] is None) and got[9900]["kept"]
    # A reference is the sum over the documents of the language; the rare ones take the whole table's.
    sums = lambda ks: [sum(x) for x in zip(*(got[k]["counts"]["classes"] for k in ks))]
    for k, lang in ((9001, "ja"), (9002, None), (9004, "rare")):
        ref = sums(got if lang == "rare" else [i for i, _, x in rows if x == lang])
        p, r = ([x / sum(v) for x in v] for v in (got[k]["counts"]["classes"], ref))
        part = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
        assert got[k]["class_distance"] == pytest.approx(math.sqrt((part(p, r) + part(r, p)) / 2), abs=1e-6)


def test_quality_separates_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    q = F.col(quality.QUALITY)
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    got = quality.judge_documents(docs).where(~q["base_failed"]).groupBy("quality").agg(F.avg(q["kept"].cast("int")).alias("k"))
    kept = {r["quality"]: r["k"] for r in got.collect()}
    assert kept[1] > 0.99 and kept[0] < 0.5


# ------------------------------------------------------------ 3

def check_packing(pieces, texts):
    t = Tokenizer.from_file(JSON)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc_id, text in texts.items():
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and (seq[0]["tier"] == 1024 or at == seq[0]["tier"])
    return by_seq


def test_packing_covers_every_id_once(make_docs, odd_rows, no_docs):
    rows = [r for r in odd_rows if r[0] is not None and r[0] != 5]
    got = rows_of(packing.pack_documents(make_docs(rows), JSON, RANKS, public_tokenizers.PATTERN))
    check_packing(got, dict(rows))
    assert packing.pack_documents(no_docs, JSON, RANKS, public_tokenizers.PATTERN).count() == 0


def test_packing_pads_little_and_balances_steps(sf):
    docs = sf("documents")
    got = rows_of(packing.pack_documents(docs.coalesce(1), JSON, RANKS, public_tokenizers.PATTERN))
    seqs = check_packing(got, {r["doc_id"]: r["text"] for r in docs.collect()})
    padding = sum(1024 - n for s in seqs.values() if (n := sum(p["length"] for p in s)) & (n - 1))
    assert padding < 0.02 * sum(p["length"] for p in got)
    steps = Counter(s[0]["step"] for s in seqs.values())
    assert max(steps.values()) - min(steps.values()) <= 4


# ------------------------------------------------------------ 4

def test_fingerprints_of_next_and_edited(make_docs, odd_rows, no_docs):
    rows = [r for r in odd_rows if r[0] != 5]
    rows = [r for i, r in enumerate(rows) if r[0] is not None or i == rows.index((None, None))]
    got = {r["doc_id"]: r for r in rows_of(fingerprint.fingerprint_documents(make_docs(rows), partitions=4))}
    memo = WordHash()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for name, t in (("sketch", text), ("edited_sketch", edited), ("next_sketch", after)):
            assert r[name] == fingerprint.sketch(t, memo).view(np.int64).tolist()
    assert fingerprint.fingerprint_documents(no_docs).count() == 0
    assert len(got) == len(rows)


def test_sketches_merge_and_estimate_containment(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(20_000)]
    memo = WordHash()
    a, b = " ".join(words), " ".join(words[:2_000] + [f"v{i}" for i in range(2_000)])
    sk = lambda t: fingerprint.sketch(t, memo).view(np.int64).tolist()
    df = spark.createDataFrame([(sk(a), sk(b), sk(a + " " + b))], "a array<bigint>, b array<bigint>, both array<bigint>")
    r = df.select(fingerprint.containment(F.col("a"), F.col("b")).alias("c"),
                  fingerprint.merge(F.col("a"), F.col("b")).alias("m"), "both").first()
    assert abs(r["c"] - 0.5) < 0.08
    assert len(set(r["both"]) ^ set(r["m"])) <= 4  # only the shingles across the seam


def test_likeness_of_short_texts(spark):
    """Texts inside a long one: the estimate rests on hashes below the threshold, and nothing else stands in for them."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(4_000)]
    memo = WordHash()
    sk = lambda t: fingerprint.sketch(t, memo).view(np.int64).tolist()
    limit = int(fingerprint.FRACTION * 2 ** 64)
    shorts = [" ".join(words[i:i + n]) for n in (5, 8, 12, 20, 40) for i in range(0, 3_000, 50)]
    rows = [(sk(t), sk(" ".join(words)), i) for i, t in enumerate(shorts)] + [([], [], -1), ([], sk("a b c"), -2), (sk("a b c"), sk("a b c"), -3)]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, i int")
    got = {r["i"]: (r["c"], r["j"], r["a"]) for r in df.select(
        "i", "a", fingerprint.containment(F.col("a"), F.col("b")).alias("c"), fingerprint.jaccard(F.col("a"), F.col("b")).alias("j")).collect()}
    for i in range(len(shorts)):
        assert got[i][0] == (1.0 if 0 <= got[i][2][0] < limit else 0.0)
    assert got[-1][:2] == (1.0, 1.0) and got[-2][:2] == (0.0, 0.0) and got[-3][:2] == (1.0, 1.0)


def test_rows_are_dealt_by_binary_search(spark, make_docs):
    rows = [(i * 7 - 500, f"text {i}") for i in range(700)]
    dealt = fingerprint.with_next(make_docs(rows), 60)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan and "lambda" not in plan
    got = dealt.collect()
    assert sorted(r["doc_id"] for r in got if not r["tail"]) == sorted(i for i, _ in rows)
    by_part = defaultdict(list)
    for r in got:
        by_part[r["part"]].append((r["tail"], r["doc_id"]))
    order = [max(i for t, i in by_part[p] if not t) for p in sorted(by_part)]
    assert order == sorted(order) and len(by_part) > 40
    assert all(sum(t for t, _ in v) == 1 for v in by_part.values())


# ------------------------------------------------------------ 5

def test_warc_round_trip(spark, scratch):
    big, other = "<p>" + "x" * 200, "<p>" + "y" * 5000
    rows = [(i, f"http://h.example/{i}\n", f"<html>{i} " + "some words " * 30) for i in range(40)]
    rows += [(50, None, big), (49, "u", big), (None, "u", big), (60, "u", None), (61, "u", ""), (62, "u", "short"),
             (63, "u", "short"), (70, "u", other), (70, "u", other), (None, None, None)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, size int").repartition(2)
    s = Scratch(spark, "test")
    got = rows_of(warc.archive_pages(spark, pages, s))
    assert len(got) == len(rows)
    assert Counter((r["page_id"], r["payload_digest"]) for r in got) == Counter(
        (i, hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows)
    kind = {(r["page_id"], r["payload_bytes"]): (r["record_type"], r["refers_to"]) for r in got}
    assert kind[49, len(big)] == ("response", None) and kind[50, len(big)] == ("revisit", 49)
    assert kind[None, len(big)] == ("revisit", 49) and kind[63, 5] == ("response", None)
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_archives_begin_with_their_dictionary(spark, sf):
    s = Scratch(spark, "test")
    assert warc.archive_pages(spark, sf("pages").coalesce(1), s).count() == sf("pages").count()
    files = spark.read.format("binaryFile").load(s.path("archives")).collect()
    assert files and all(bytes(f["content"][:4]) == b"\x5d\x2a\x4d\x18" for f in files)


def test_archive_records_are_frames_of_their_own():
    records = [f"WARC/1.1\r\nN: {i}\r\nContent-Length: 4\r\n\r\nab{i:02d}\r\n\r\n".encode() + b"" for i in range(60)]
    data = warc.build_archive([r for r in records])
    assert [h["N"] for h, _ in warc.parse_archive(data)] == [str(i) for i in range(60)]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.parse_archive(data[:-3]))


# ------------------------------------------------------------ 6

def test_language_model_against_brute_force(make_docs, odd_rows, no_docs):
    import math

    rng = random.Random(5)
    rows = odd_rows + [(100 + i, " ".join(rng.choice("a b c d e f g h I J".split()) for _ in range(rng.randrange(60))))
                       for i in range(80)]
    docs = make_docs(rows)
    model = kneser_ney.fit(docs.where(~kneser_ney.held_out()))
    got = defaultdict(list)
    for r in rows_of(kneser_ney.score(docs, model)):
        got[r["doc_id"]].append(r)
    tk = lambda t: (t or "").encode().lower().split() + [0]
    train = [tk(t) for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    uni, bi = Counter(w for x in train for w in x), Counter(p for x in train for p in zip(["<s>"] + x[:-1], x))
    ctx, kinds, types = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, v), c in bi.items():
        ctx[u] += c
        kinds[u][min(c, 3) - 1] += 1
        types[v] += 1
    of = lambda counts: (0, *kneser_ney.discounts([Counter(counts.values())[i] for i in (1, 2, 3, 4)]))
    d, e, n, v, t = of(bi), of(types), sum(uni.values()), len(uni), sum(types.values())
    spare = sum(e[min(x, 3)] for x in types.values()) / t

    def prob(u, w):
        low = spare / (v + 1) + (max(types[w] - e[min(types[w], 3)], 0) / t if w in types else 0)
        if not ctx[u]:
            return low
        c = bi[u, w]
        return max(c - d[min(c, 3)], 0) / ctx[u] + sum(a * b for a, b in zip(d[1:], kinds[u])) / ctx[u] * low

    assert abs(sum(prob(next(iter(uni)), w) for w in uni) + prob(next(iter(uni)), "unknown") - 1) < 1e-9
    for i, text in rows:
        ws = tk(text)
        want = sum(math.log10(prob(u, w)) for u, w in zip(["<s>"] + ws[:-1], ws))
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in ws)
        assert any(abs(r["score"] - want) < 1e-6 * abs(want) and abs(r["base_score"] - base) < 1e-6 * abs(base)
                   and (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in uni for w in ws), n)
                   for r in got[i])
    empty = kneser_ney.fit(no_docs)
    assert {r["score"] for r in rows_of(kneser_ney.score(docs, empty))} == {0.0}
    assert kneser_ney.score(no_docs, model).count() == 0


# ------------------------------------------------------------ 7

def test_shards_are_even_and_keep_equal_texts_together(sf, make_docs, odd_rows, no_docs):
    docs = sf("documents")
    texts = [r["text"] for r in docs.collect()][:120]
    rows = list(enumerate(texts * 5))
    got = rows_of(sharding.shard_documents(make_docs(rows)))
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len(texts[r["doc_id"] % 120].encode()) + 1
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"] % 120].encode())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(sizes.values()) / sharding.SHARDS
    assert max(sizes.values()) < 1.25 * mean
    shard = {r["doc_id"]: r["shard"] for r in got}
    together = sum(shard[i] == shard[i + 120 * k] for i in range(120) for k in range(1, 5))
    assert together > 0.5 * 480  # by chance an eighth
    odd = rows_of(sharding.shard_documents(make_docs(odd_rows)))
    assert len(odd) == len(odd_rows)
    assert sharding.shard_documents(no_docs).count() == 0


def test_every_group_that_fits_a_shard_is_whole(make_docs):
    def shards_of(rows):
        sizes, found = Counter(), defaultdict(set)
        for r in rows_of(sharding.shard_documents(make_docs(rows))):
            sizes[r["shard"]] += r["size"]
            found[r["text_crc32"]].add(r["shard"])
        mean = sum(sizes.values()) / sharding.SHARDS
        assert len(sizes) == sharding.SHARDS and max(sizes.values()) < 1.02 * mean and min(sizes.values()) > 0.98 * mean
        return {t: len(x) for t, x in found.items()}

    # 4,000 rows of equal size: groups of 0.3, 0.7 and 1 shard, 200 pairs, 50 groups of 6, the rest unlinked.
    texts = ["a" * 50] * 150 + ["b" * 50] * 350 + ["c" * 50] * 500
    texts += [f"pair {i:045d}" for i in range(200)] * 2 + [f"six  {i:045d}" for i in range(50)] * 6
    texts += [f"lone {i:045d}" for i in range(4000 - len(texts))]
    assert set(shards_of(list(enumerate(texts))).values()) == {1}
    # All linked: nothing unlinked can make room.
    texts = ["a" * 50] * 300 + ["b" * 50] * 300 + [f"five {i:045d}" for i in range(680)] * 5
    assert set(shards_of(list(enumerate(texts))).values()) == {1}
    # A group of 1.5 shards is the only one that is split.
    texts = ["a" * 50] * 750 + [f"pair {i:045d}" for i in range(1625)] * 2
    got = shards_of(list(enumerate(texts)))
    assert got.pop(zlib.crc32(b"a" * 50)) > 1 and set(got.values()) == {1}


def test_labels_end_when_no_move_is_left(spark):
    star = [(f"n{i}", f"h{i % 40}") for i in range(4000)]
    names = sorted({x for p in star for x in p})
    nodes = spark.createDataFrame([(x, 1, zlib.crc32(x.encode()) % 8) for x in names], "node string, size long, shard int")
    loads = Counter(zlib.crc32(x.encode()) % 8 for x in names)
    quotas = sharding.Quotas([loads[s] + 500 for s in range(8)], [(s, k, 5) for s in range(8) for k in range(100)], 0.05)
    shard = {r["node"]: r["shard"] for r in sharding.propagate(nodes, spark.createDataFrame(star, "a string, b string"), 8, quotas).collect()}
    assert all(shard[a] == shard[b] for a, b in star)
    assert max(quotas.loads) <= quotas.capacity and sum(quotas.loads) == len(names) + 4000


# ------------------------------------------------------------ 8

def brute_segments(scores):
    """Maximal segments by recursion: the best stretch, then left and right of it."""
    best = None
    for i in range(len(scores)):
        for j in range(i, len(scores)):
            s = sum(scores[i:j + 1])
            if s > 1e-9 and (best is None or s > best[0] + 1e-9 or abs(s - best[0]) <= 1e-9 and j - i < best[2] - best[1]):
                best = (s, i, j)
    if best is None:
        return []
    s, i, j = best
    return brute_segments(scores[:i]) + [(s, i, j)] + [(t, a + j + 1, b + j + 1) for t, a, b in brute_segments(scores[j + 1:])]


def test_maximal_segments_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        gains = {i: rng.uniform(0.5, 3) for i in range(25) if rng.random() < 0.3}
        scores = [gains.get(i, 0.0) - 0.41 for i in range(25)]
        got = toxicity.maximal_segments([(i, g) for i, g in sorted(gains.items()) if g > 0.41], 0.41)
        want = brute_segments(scores)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_toxicity_calibration_against_brute_force(spark, make_docs):
    random.seed(11)
    common, bad = [f"w{i}" for i in range(60)], ["scumbag", "moronic", "trashy"]
    texts = [random.choices(common, k=random.randint(1, 60)) for _ in range(600)]
    for i, t in enumerate(texts):
        for _ in range(random.choice([3, 5]) if i % 3 == 0 else random.random() < 0.1):
            t.insert(random.randint(0, len(t)), random.choice(bad))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(0, " ".join(texts[0])), (1, "zzz later copy of an id")]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    docs = make_docs(rows)
    used = toxicity.training_rows(docs, labels).collect()
    chosen = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted((r["text"], r["toxic"]) for r in used) == sorted(
        (min(t for j, t in rows if j == i), int(i % 3 == 0)) for i in chosen)
    assert toxicity.training_rows(docs, labels, 5).count() == 5
    model = toxicity.fit(docs, labels)
    assert model.weights

    def word_score(w):
        x = max(model.weights.get(w, 0.0), model.weights.get(w[:toxicity.STEM] + "~", 0.0) if len(w) >= toxicity.STEM else 0.0)
        return (x if x > model.drift else 0.0) - model.drift

    innocent = [[word_score(w) for w in r["text"].split()] for r in used if not r["toxic"]]
    least = min(model.weights.values()) - model.drift
    every = [x for t in innocent for x in t]
    assert abs(sum(math.exp(model.lam * x) for x in every) + 0.5 * math.exp(model.lam * least) - len(every) - 0.5) < 1e-6 * len(every)

    def best(t):
        return max((sum(t[i:j]) for i in range(len(t)) for j in range(i + 1, len(t) + 1)), default=0.0)

    found = [(len(t), best(t)) for t in innocent]

    def likelihood(k):  # with half an observation of the smallest score in a text of one word
        return sum((math.log(k) if b > 0 else 0.0) - k * n * math.exp(-model.lam * (b if b > 0 else least)) for n, b in found) + (
            0.5 * math.log(k) - k * math.exp(-model.lam * least))

    assert all(likelihood(model.k) > likelihood(model.k * f) for f in (0.97, 0.99, 1.01, 1.03))


def test_toxicity_on_held_out_labels(spark, make_docs, odd_rows, no_docs):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    r = toxicity.with_score(held, model, "s").select("toxic", (F.col("s") >= toxicity.THRESHOLD).cast("int").alias("p")).toPandas()
    assert (r.toxic == r.p).mean() > 0.96
    odd = rows_of(toxicity.with_score(make_docs(odd_rows), model, "s"))
    assert len(odd) == len(odd_rows) and all(0 <= x["s"] <= 1 for x in odd)
    assert all(x["s"] == 0 for x in odd if not x["text"])
    nothing = toxicity.fit(docs.limit(0), labels)
    assert {x["s"] for x in rows_of(toxicity.with_score(make_docs(odd_rows), nothing, "s"))} == {0.0}
    assert toxicity.with_score(no_docs, model, "s").count() == 0


# ------------------------------------------------------------ 9

def components_by_hand(texts, percent=80):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_against_all_pairs(make_docs, odd_rows, no_docs):
    rng = random.Random(9)
    rows = [r for r in odd_rows if r[0] not in (None, 5, 6, 11)]
    passage = " ".join(f"p{i}" for i in range(40))
    for g in range(12):  # families of edited copies, so that chains and borders arise
        words = [f"g{g}w{rng.randrange(300)}" for _ in range(rng.choice([5, 30, 120, 400]))]
        for k in range(12):
            w = list(words)
            for _ in range(rng.randrange(0, max(1, len(w) // 18) + 1)):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
            rows.append((100 + g * 20 + k, " ".join(w) + (" " + passage if k % 3 == 0 else "")))
    got = rows_of(neardup.near_duplicates(make_docs(rows)))
    want = components_by_hand(dict(rows))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert neardup.near_duplicates(no_docs).count() == 0
    odd = rows_of(neardup.near_duplicates(make_docs(odd_rows)))
    assert len(odd) == len(odd_rows)
    assert all(r["component_id"] is None and r["kept"] for r in odd if r["doc_id"] is None)
    assert {r["component_id"] for r in odd if r["doc_id"] in (4, 5)} == {4}


def test_super_minhash_matches_a_plain_version_and_estimates_similarity():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    a, b = np.unique(base[:300]), np.unique(base[100:])
    together = neardup.super_minhash([a, b, a[:3]])
    alone = [neardup.super_minhash([x])[0] for x in (a, b, a[:3])]
    assert (together == np.array(alone)).all()  # early stopping does not depend on the batch
    assert abs((together[0] == together[1]).mean() - 0.5) < 0.12


# ------------------------------------------------------------ 10

def test_url_rules_against_plain_strings(spark):
    urls = ["http://a.net/x", "https://A.NET", "http://net/y?q=/", "http://en.example.net/en/1", "http://example.net/enx",
            "http://x.example.com/de/1", "http://example.com/fr/de/", "http://b.org/fr/", "http://notexample.com/de/",
            "http://x.com/a.net/b", None, "", "no url", "http://ads-x.example.com/q", "http://é.org/fr/é",
            "http://h.com/tag/", "http://h.com/a/search", "x://h?a.net/", "http://h.net#/", "http://a.net:80/"] * 2
    urls.append("http://h.com/" + "y" * 50_000)
    pages = spark.createDataFrame([(i, u, "a", "b") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in rows_of(urlfilter.judge_urls(pages))}
    for i, u in enumerate(urls):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host = m[1].translate(str.maketrans(urlfilter.UPPER, urlfilter.LOWER)) if m else ""
        path = m[2] if m else ""
        fit = [(len(r), r, v) for r, v in urlfilter.SITE_RULES
               if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (max(fit)[1] if fit else None)
        if fit:
            assert got[i]["verdict"] == max(fit)[2]
    assert urlfilter.judge_urls(pages.limit(0)).count() == 0


def test_automaton_against_regular_expressions():
    rng = random.Random(8)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "."]) for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/.") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    hit = urlfilter.ShiftAnd.compile(globs).match([t.encode() for t in texts])
    for g, glob in enumerate(globs):
        parts = re.findall(r"\*\*|.", glob)
        rx = re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in parts), re.S)
        assert [bool(rx.fullmatch(t)) for t in texts] == hit[:, g].tolist(), glob
