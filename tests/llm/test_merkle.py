"""The manifest against a recursive tree, its proofs against a plain check."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

from cardmart.llm import merkle

FIELDS = "doc_id long, source string, lang string, n_chars long, text string, tree string, idx int, `a.b` string"
low = str.maketrans(merkle.UPPER, merkle.LOWER)


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row[:5]))


def tree(nodes):
    """Root, and of every node its siblings and places on the way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 8 * 8:i // 8 * 8 + 8]
            paths[k].append((i % 8, run[:i % 8] + run[i % 8 + 1:]))
        nodes, at = [h("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)], [i // 8 for i in at]
    return nodes[0], paths


def by_hand(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in order:
        langs[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[x] = tree([leaf(r) for r in langs[x]])
    root, above = tree([trees[x][0] for x in order])
    out = []
    for k, x in enumerate(order):
        for r, path in zip(langs[x], trees[x][1]):
            path = path + above[k]
            tampered = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0
            folded = leaf((*r[:4], r[4].translate(low)) if tampered and r[4] is not None else r)
            for at, others in path:
                folded = h("".join([*others[:at], folded, *others[at:]]))
            out.append((r[0], leaf(r), trees[x][0], root, h("".join(s for _, others in path for s in others)), folded, folded == root))
    return out


def check(spark, rows):
    got = merkle.manifest(spark.createDataFrame([(*r, "x", 5, "y") for r in rows], FIELDS).repartition(5)).drop("tampered").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(by_hand(rows), key=repr)
    return got


def test_sizes_around_the_runs_and_blocks(spark):
    rng = random.Random(2)
    rows = []
    for lang, n in (("de", 1), ("en", 1200), ("", 8), (None, 9), ("fr", 64), ("ja", 65), ("é", 512), ("zz", 513)):
        rows += [(len(rows) + k, f"s{k % 3}", lang, k, f"Text {rng.random()} OF ÄÖ {k}") for k in range(n)]
    got = check(spark, rows)
    bad = {r["doc_id"] for r in got if not r["verified"]}
    assert bad == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 0}


def test_one_language_one_leaf_and_none(spark):
    check(spark, [(1, "s", "en", 3, "abc")])
    check(spark, [(k, None, "en", None, None) for k in range(20)])
    check(spark, [(k, "s", f"l{k}", 1, "A") for k in range(30)])
    assert merkle.manifest(spark.createDataFrame([], FIELDS)).collect() == []


def test_odd_rows(spark, odd_rows):
    rows = [(i, "s", ("en", None)[k % 2], None if t is None else len(t), t) for k, (i, t) in enumerate(odd_rows)]
    check(spark, rows + rows[:4] * 200)


def test_an_altered_leaf_is_found():
    found = merkle.sweep_up([h(str(i)) for i in range(77)], merkle.levels_of(77))
    paths = {k: path for k, path, _ in merkle.sweep_down(found, 3, (), "")}
    root = found[merkle.levels_of(77), 0]
    assert all(merkle.fold(h(str(k)), paths[k]) == root for k in range(77))
    assert merkle.fold(h("other"), paths[5]) != root
