"""SimHash against plain counts and all pairs."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import simhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text, k=3):
    ws = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    grams = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] if len(ws) >= k else ([" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(prints, near=3):
    """The least of each class, of different fingerprints."""
    up = {p: p for p in prints}
    find = lambda x: x if up[x] == x else find(up[x])
    own = sorted(up)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if (a ^ b).bit_count() <= near and find(a) != find(b):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {p: find(p) for p in own}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=120), min_size=1, max_size=20), st.integers(0, 2**64 - 1))
def test_xxh64(pieces, seed):
    data = np.frombuffer(b"".join(pieces) + b" " * 8, np.uint8)
    lengths = np.array([len(p) for p in pieces])
    got = simhash.xxh64(data, np.cumsum(lengths) - lengths, lengths, seed)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, seed) for p in pieces]


def corpus(seed):
    rng = np.random.default_rng(seed)
    fresh = lambda n: [f"W{x}é" for x in rng.integers(0, 10**6, n)]
    texts = {}
    for g in range(12):
        base = fresh(int(rng.integers(1, 400)))
        for c in range(int(rng.integers(1, 10))):
            own = list(base)
            for _ in range(int(rng.integers(0, 3))):
                own[int(rng.integers(0, len(own)))] = fresh(1)[0]
            texts[g * 100 + c] = " \n".join(own)
    texts |= {9000: None, 9001: "", 9002: " \n", 9003: "One two", 9004: "one TWO", 9005: "one", 9006: "a b c d e", 9007: "z " * 5000, 9008: "x" * 3000 + " y z w"}
    return texts


@pytest.mark.parametrize(("seed", "k", "near", "most"), [(1, 3, 3, 4096), (2, 3, 3, 2), (3, 2, 2, 1), (4, 3, 0, 4096)])
def test_near_duplicates(spark, seed, k, near, most):
    texts = corpus(seed)
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in texts.items()], "doc_id long, text string, fingerprint string, key int").repartition(4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df, k, near, most).collect()}
    prints = {d: fingerprint(t, k) for d, t in texts.items()}
    label = classes(set(prints.values()), near)
    least = {}
    for d in sorted(prints):
        least.setdefault(label[prints[d]], d)
    assert got == {d: (f"{p:016x}", least[label[p]]) for d, p in prints.items()}


@pytest.mark.parametrize("most", [1, 20, 4096])
def test_links_of_crowded_signatures(spark, most):
    """Clouds around a centre, far beyond what one task may compare, join as all pairs do."""
    rng = np.random.default_rng(most)
    prints = set()
    for _ in range(3):
        centre = int(rng.integers(0, 2**63)) * 2
        for _ in range(120):
            prints.add(centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 6)), replace=False)))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(3)
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_links(df, 3, most).collect()]
    assert all(0 < (a ^ b).bit_count() for a, b in links)
    up = {p: p for p in prints}
    find = lambda x: x if up[x] == x else find(up[x])
    for a, b in links:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    want = classes(prints)
    assert {p: find(p) for p in prints} == want
    assert len(set(want.values())) > 3


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 63), st.integers(0, 31))
def test_dense_groups(seed, i, j):
    """Fingerprints that share both signatures, numbered by the 18 bits that are left."""
    rng = np.random.default_rng(seed)
    half, bit, quarter, spare = i >> 5, i & 31, j >> 4, j & 15
    free = [32 * half + bit, 32 * (1 - half) + 16 * quarter + spare, *(32 * (1 - half) + 16 * (1 - quarter) + b for b in range(16))]
    base = int(rng.integers(0, 2**63))
    prints = {base ^ sum(1 << int(b) for b in rng.choice(free, int(rng.integers(0, 6)), replace=False)) for _ in range(60)}
    signed = np.array([p - 2**64 if p >= 2**63 else p for p in sorted(prints)])
    batch = pa.record_batch([pa.array(np.full(len(signed), i)), pa.array(np.full(len(signed), half << 10 | bit << 5 | j)), pa.array(signed)], ["key", "sub", "fingerprint"])
    up = {p: p for p in prints}
    find = lambda x: x if up[x] == x else find(up[x])
    for out in simhash._dense(3, 0)(iter([batch])):
        for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True):
            p, q = find(a % 2**64), find(b % 2**64)
            up[max(p, q)] = min(p, q)
    assert {p: find(p) for p in prints} == classes(prints)


def test_rows(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (4, None), (None, None)]
    key = lambda r: str(tuple(r))
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    same, other, zero = f"{fingerprint('a b c d'):016x}", f"{fingerprint('q r s t u'):016x}", "0" * 16
    assert sorted(map(tuple, got), key=key) == sorted([(3, same, 1), (1, same, 1), (1, same, 1), (None, same, 1), (None, other, None), (4, zero, 4), (None, zero, 4)], key=key)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
