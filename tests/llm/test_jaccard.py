"""Shingle classes against brute force; bounds that never prune a link; components."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import jaccard
from terrafold.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, k):
    ws = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)} if len(ws) >= k else ({tuple(ws)} if ws else set())


def brute(texts, k, percent):
    sets = {d: shingles(t, k) for d, t in texts.items()}
    up = {d: d for d in sets}
    find = lambda x: x if up[x] == x else find(up[x])
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed, n=12):
    rng = np.random.default_rng(seed)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    texts, passage = {}, fresh(30)
    for g in range(n):
        base = fresh(int(rng.integers(5, 150))) + (passage if g % 2 else [])
        for c in range(int(rng.integers(1, 12))):
            own = list(base)
            for _ in range(int(rng.integers(0, 5))):
                at = int(rng.integers(0, len(own)))
                own[at : at + int(rng.integers(0, 2))] = fresh(1)
            texts[g * 100 + c] = " ".join(own)
    base = fresh(60)
    for i in range(40):  # a chain: each near the next, the ends far apart
        texts[5000 + i] = " ".join(base)
        base[i] = f"c{i}"
    texts |= {9000: None, 9001: "", 9002: " \n", 9003: "One two", 9004: "one TWO", 9005: "one", 9006: "a b c d", 9007: "A b c d", 9008: "z " * 500, 9009: "Z " * 90, 9010: "É a b c"}
    return texts


@pytest.mark.parametrize(("k", "percent", "block"), [(4, 85, 4096), (5, 80, 4096), (4, 85, 6), (2, 60, 5)])
def test_against_brute_force(spark, k, percent, block):
    texts = corpus(k + percent + block)
    df = spark.createDataFrame([(d, t, 0) for d, t in texts.items()], "doc_id long, text string, n int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.shingle_classes(df, k, percent, 20, block).collect()}
    assert got == brute(texts, k, percent)


def test_repeated_and_null_ids(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(3, a), (1, a), (1, a), (None, a), (None, b), (4, None), (None, None)]
    got = jaccard.shingle_classes(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85, 20).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(map(tuple, got), key=key) == sorted([(3, 3, 1), (1, 3, 1), (1, 3, 1), (None, 3, 1), (None, 3, None), (4, 0, 4), (None, 0, None)], key=key)
    assert jaccard.shingle_classes(spark.createDataFrame([], "doc_id long, text string"), 4, 85, 20).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 2**32))
def test_linked_sets_share_a_signature(both, own_a, own_b, seed):
    rng = np.random.default_rng(seed)
    tokens = rng.integers(0, 2**63, both + own_a + own_b, dtype=np.uint64)
    a, b = np.unique(tokens[: both + own_a]), np.unique(np.concatenate([tokens[:both], tokens[both + own_a :]]))
    shape = jaccard.Shape(4, 85)
    linked = 100 * both >= 85 * (both + own_a + own_b)
    signatures, whose = shape.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    if linked:
        assert set(signatures[whose == 0].tolist()) & set(signatures[whose == 1].tolist())
        assert both >= int(shape.needed(np.int64(len(a)), np.int64(len(b))))
        x, y = jaccard.Tree([a]).root, jaccard.Tree([b]).root
        assert jaccard.overlap_bound(x, y) >= both


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, int(x)) for x in rng.integers(201, 260, 80)] + [(5, 3), (3, 9), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {b: 200 for a, b in edges if a == 200} | {200: 200, 3: 3, 5: 3, 9: 3}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
