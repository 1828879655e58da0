"""Substring removal against brute force, and a sketch that only ever overestimates."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold.llm import sketch, substring

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(texts, k):
    out = {}
    split = {d: WORD.findall(t or "") for d, t in texts.items()}
    starts = {}
    for d in sorted(split):
        for i in range(len(split[d]) - k + 1):
            starts.setdefault(tuple(split[d][i : i + k]), d)
    for d, ws in split.items():
        gone = {i + j for i in range(len(ws) - k + 1) if starts[tuple(ws[i : i + k])] < d for j in range(k)}
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[d] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus():
    rng = np.random.default_rng(11)
    fresh = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    passage, line = fresh(12), fresh(5)
    texts = {i: f"{fresh(int(rng.integers(0, 9)))} {passage}\n{fresh(3)} {line} x" for i in range(40)}
    texts |= {100 + i: texts[3] for i in range(30)}
    texts |= {200: None, 201: "", 202: " \n", 203: "z " * 300, 204: "z " * 40 + fresh(4), 205: passage.split(" ", 1)[1], 206: passage + " Ab  c d " + passage, 207: passage.upper(), -5: fresh(2) + " " + line + " x y"}
    return texts


@pytest.mark.parametrize(("k", "width"), [(5, 22), (5, 6), (8, 22)])
def test_against_brute_force(spark, monkeypatch, k, width):
    monkeypatch.setattr(substring, "STRETCH", 200)
    monkeypatch.setattr(sketch, "STRETCH", 200)
    monkeypatch.setattr("terrafold.llm.common.SLICE_BYTES", 300)
    texts = corpus()
    df = spark.createDataFrame([(d, t, 1) for d, t in texts.items()], "doc_id long, text string, mark int").repartition(5)
    result = substring.remove_repeats(df, k, width)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.digests(result).collect()}
    assert got == brute(texts, k)
    unchanged = {r.doc_id: r.text for r in result.collect() if not r.n_removed}
    assert all(t == (texts[d] or "") for d, t in unchanged.items())


def test_repeated_and_null_ids(spark):
    passage = " ".join(f"p{i}" for i in range(10))
    rows = [(1, passage), (1, passage), (1, "a " + passage), (None, passage), (2, passage + " b"), (2, "c"), (None, None)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 5, 20).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_removed) for r in got) == sorted([(1, passage, 0), (1, passage, 0), (1, "a " + passage, 0), (0, passage, 0), (2, "b", 10), (2, "c", 0), (0, "", 0)])
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 5, 20).count() == 0


def test_sketch_loses_none(spark):
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 30, 200))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    offsets[-1] -= 1
    h = substring.grams_of(data, offsets, 3)
    values, n = np.unique(h, return_counts=True)
    bits = sketch.sketch(df, lambda _, d, o: substring.grams_of(d, o, 3), 20)
    maybe = sketch.estimated_repeated(bits, values, 20)
    assert maybe[n > 1].all() and maybe[n == 1].mean() < 0.05
    x = np.unique(rng.integers(0, 1 << 18, 500))
    assert (sketch._offsets(sketch._deltas(x)) == x).all()


def test_null_ids_are_no_copies(spark):
    """60000 x 4000 chances in 2**25 that a null doc_id's key falls on a copy's bit."""
    passage = " ".join(f"p{i}" for i in range(10))
    copies = spark.range(1, 4002).selectExpr("id AS doc_id", f"'{passage}' AS text")
    nulls = spark.range(60000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat('n', id, ' a b c d e') AS text")
    got = substring.remove_repeats(copies.unionByName(nulls), 5, 20).groupBy(F.col("doc_id").isNull().alias("unknown")).agg(F.count_if(F.col("n_removed") > 0).alias("n"), F.min(F.length("text")).alias("least"))
    assert {r.unknown: (r.n, r.least) for r in got.collect()} == {False: (4000, 0), True: (0, 12)}
