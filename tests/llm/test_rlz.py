"""Repeated passages against a plain search of all windows."""

import hashlib
import random

import numpy as np

from cardmart.llm import rlz
from cardmart.llm.common import WordHash


def by_hand(rows):
    """(doc_id, text) -> (n_words, n_removed, hash of the words left), in order of ids; ids must tell texts apart."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0])):
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - rlz.WINDOW + 1):
            window = tuple(words[s:s + rlz.WINDOW])
            if window in seen:
                gone.update(range(s, s + rlz.WINDOW))
            seen.add(window)
        left = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i, text] = (len(words), len(gone), hashlib.sha256(left).hexdigest(), left.decode())
    return out


def frame(spark, rows):
    data = [(i, t, "x", "y", 3, "z") for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, doc string, tie string, keys int, `a.b` string").repartition(4)


def check(spark, rows):
    want = by_hand(rows)
    got = rlz.remove_repeats(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=repr) == sorted(
        ((i, *want[i, t][:3]) for i, t in rows), key=repr)
    short = {(r["doc_id"], r["text"]) for r in rlz.shorten_documents(frame(spark, rows)).collect()}
    assert short == {(i, w[3]) for (i, _), w in want.items() if w[1]}


def prose(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_planted_passages(spark):
    rng = random.Random(4)
    passages = [prose(rng, n) for n in (19, 20, 21, 30, 60, 300, 700)]
    rows = [(i, " ".join([prose(rng, rng.randrange(0, 60)), rng.choice(passages), prose(rng, rng.randrange(0, 400)),
                          rng.choice(passages), prose(rng, rng.randrange(0, 5))])) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # a group of copies
    line = prose(rng, 12)  # shorter than a window, in every surrounding
    rows += [(300 + i, f"{prose(rng, 30)} {line} {prose(rng, 9, 2)} {prose(rng, 30)}") for i in range(80)]
    check(spark, rows)


def test_small_vocabulary_and_runs(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(0, 900), 2)) for i in range(25)]
    rows += [(50, "a " * 1500), (51, "a b " * 700), (52, "b a " * 30), (53, "a " * 19), (54, "a " * 20), (55, "a " * 21)]
    rows += [(60, " ".join(f"x{i % 37}" for i in range(2000))), (61, " ".join(f"x{i % 37}" for i in range(5, 400)))]
    check(spark, rows)


def test_odd_rows(spark, odd_rows):
    one_text_per_id = [r for r in odd_rows if r[0] is not None] + [(None, odd_rows[5][1] + " and more")]
    check(spark, one_text_per_id)
    assert rlz.remove_repeats(frame(spark, [])).collect() == []
    # Rows that share an id: the first by hash keeps its words, the others lose what they share.
    text = prose(random.Random(1), 50)
    got = rlz.remove_repeats(frame(spark, [(7, text), (7, text + " tail"), (7, text), (None, text), (None, None), (None, text)])).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in got if r["doc_id"] is None) == [(0, 0), (50, 0), (50, 0)]
    assert sorted((r["n_words"], r["n_removed"]) for r in got if r["doc_id"] == 7) == [(50, 50), (50, 50), (51, 50)]


def test_factors_are_greedy_and_windows_complete():
    rng = np.random.default_rng(3)
    memo = WordHash()
    for size in (2, 3, 40):
        for _ in range(60):
            block = rlz.hashed([b"%d" % x for x in rng.integers(0, size, rng.integers(0, 120))], memo)
            words = rlz.hashed([b"%d" % x for x in rng.integers(0, size, rng.integers(0, 80))], memo)
            if len(block) > 50:
                at = rng.integers(0, len(block) - 40)
                words = np.concatenate([words, block[at:at + rng.integers(8, 40)], words[:10], block[3:30]])
            index = rlz.Block(block)
            end = 0
            for start, length in rlz.factor(words, index, None):
                assert start >= end
                end = start + length
                in_block = {tuple(block[i:i + length]) for i in range(len(block) - length + 1)}
                assert tuple(words[start:end]) in in_block
                longer = {tuple(block[i:i + length + 1]) for i in range(len(block) - length)}
                assert end == len(words) or tuple(words[start:end + 1]) not in longer
            windows = {tuple(block[i:i + 20]) for i in range(len(block) - 19)}
            want = {s for s in range(len(words) - 19) if tuple(words[s:s + 20]) in windows}
            got = {s for a, b in rlz.repeated_starts(words, index, None) for s in range(a, b + 1)}
            assert got == want
