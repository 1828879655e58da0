"""Repeated byte strings against brute force."""

import hashlib

import numpy as np
import pytest

from terrafold.llm import common, suffix


def brute(texts, length):
    out, seen = {}, set()
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[d] = (len(raw), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = np.random.default_rng(seed)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    long, short = fresh(400), fresh(45)
    texts = {i: fresh(int(rng.integers(0, 60))) + long[int(rng.integers(0, 50)) : 400 - int(rng.integers(0, 50))] + fresh(20) + short for i in range(25)}
    for i in range(20):
        own = list(texts[i])
        for at in rng.integers(0, len(own), 4):
            own[at] = "Z"
        texts[50 + i] = "".join(own)
    return texts | {100 + i: texts[3] for i in range(8)} | {200: None, 201: "", 202: "ab" * 200, 203: "a" * 300, 204: fresh(30) + fresh(0) + long[:60] + long[:60], 205: short, 206: "ab" * 150 + "c", -4: "x" + long}


@pytest.mark.parametrize(("length", "width", "seed"), [(20, 22, 1), (20, 8, 2), (100, 22, 3)])
def test_against_brute_force(spark, monkeypatch, length, width, seed):
    monkeypatch.setattr("terrafold.llm.common.SLICE_BYTES", 2000)
    texts = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in texts.items()], "doc_id long, text string, mark int").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(suffix.remove_repeated_bytes(df, length, width)).collect()}
    assert got == brute(texts, length)


def test_repeated_and_null_ids(spark):
    a = "abcdefghijklmnopqrstuvwxyz" * 2
    rows = [(1, a[:40]), (1, a[:40]), (None, a), (2, a[:40]), (None, None)]
    got = suffix.remove_repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 30, 20).collect()
    assert sorted((r.doc_id or 0, bytes(r.kept).decode(), list(r.starts)) for r in got) == [(0, "", []), (0, a, []), (1, a[:40], []), (1, a[:40], []), (2, "", [0])]
    assert suffix.remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string"), 20, 20).count() == 0


def test_twin_rows_lose_only_repeats(spark):
    rng = np.random.default_rng(5)
    fresh = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    texts = {i: fresh(20_000) for i in range(3)}
    texts[3] = fresh(5000) + texts[0][1000:1400] + fresh(5000)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = [tuple(r) for r in suffix.digests(suffix.remove_repeated_bytes(df.unionByName(df).repartition(3), 100, 22)).collect()]
    assert sorted(got) == sorted(2 * [(d, *x) for d, x in brute(texts, 100).items()])


@pytest.mark.parametrize("seed", [1, 2])
def test_crowded_grams(spark, monkeypatch, seed):
    """Strings of crowds go another way, with the same result, and no gram's group grows beyond CROWD."""
    monkeypatch.setattr(suffix, "CROWD", 3)
    texts = corpus(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    crowds = []
    monkeypatch.setattr(suffix, "stored", lambda x, own=suffix.stored: (out := own(x), crowds.append(out) if "over" in out.columns else None)[0])
    got = {r.doc_id: tuple(r)[1:] for r in suffix.digests(suffix.remove_repeated_bytes(df, 20, 22)).collect()}
    assert got == brute(texts, 20)
    assert crowds and crowds[0].count()


@pytest.mark.parametrize("span", [1, 2, 50, 255, 256, 257, 300])
def test_least_places(span):
    """The last of the least values, by a plain search, for spans of small and of large offsets; in a byte for each place up to 256."""
    values = np.random.default_rng(span).integers(0, 60, 1000).astype(np.uint64)
    plain = [i + span - 1 - int(np.argmin(values[i : i + span][::-1])) for i in range(len(values) - span + 1)]
    assert common.least_places(values, span).tolist() == plain


def test_fingerprints_of_several_arrays():
    data = np.frombuffer(b"abcabcab", np.uint8)
    a, b = suffix.fingerprints(data, (np.array([0, 1]), np.array([3, 4])), (np.array([3, 3]), np.array([6, 3])))
    assert a[0] == b[0] and len({*a.tolist(), *b.tolist()}) == 3


@pytest.mark.parametrize("span", [1, 2, 3, 50, 300])
def test_least_places_of_equals_and_few(span):
    """Values that are all equal, of few kinds, rising and falling, and fewer than a span."""
    rng = np.random.default_rng(7)
    for n in (0, 1, 49, 50, 51, 400):
        for values in (np.zeros(n), rng.integers(0, 2, n), np.arange(n), np.arange(n)[::-1], rng.integers(0, 2**63, n)):
            values = values.astype(np.uint64)
            plain = [i + span - 1 - int(np.argmin(values[i : i + span][::-1])) for i in range(n - span + 1)]
            assert common.least_places(values, span).tolist() == plain


def test_texts_are_sketched_by_slices_of_a_size(spark):
    """A slice is no longer than asked unless one text is; the sketch is the same."""
    docs = spark.createDataFrame([(str(i % 7) * 300,) for i in range(40)] + [("x" * 5000,)], "text string").coalesce(1)

    def hashes(batch, data, offsets, most):
        assert len(data) <= most or batch.num_rows == 1
        return np.unique(data).astype(np.uint64)

    every = [suffix.sketch(docs, lambda *found: np.concatenate([np.unique(found[1][a:b]).astype(np.uint64) for a, b in zip(found[2], found[2][1:], strict=False)]), 10, most=most) for most in (1000, 1 << 18)]
    assert (every[0] == every[1]).all()
    suffix.sketch(docs, lambda *found: hashes(*found, 1000), 10, most=1000)
