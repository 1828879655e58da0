"""Each stage of the pipeline on nulls, repeated rows, ties, empty tables, long texts and columns with clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terrafold.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that stages use within.
CLASH = ("key", "left", "empty", "first_id", "component_id", "kept", "n_words", "ids", "piece", "length")
STAGE = dict(corpus_pipeline.STAGES)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    vocab = "river garden letter morning village winter bread silver teacher harbour quiet green walking along between stone window market children story northern evening light careful music".split()
    return " ".join(rng.choice(vocab) + rng.choice(vocab) for _ in range(n))


def frame(spark, rows):
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASH}).repartition(3)


def ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())


@pytest.mark.parametrize("name", list(STAGE))
def test_empty(spark, name):
    out = STAGE[name](spark, frame(spark, []).limit(0), "")
    assert out.count() == 0
    if name != "best_fit_packing":
        assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")


def test_quality_rules(spark):
    good = prose(1, 120)
    rows = [(1, good), (1, good), (None, good), (2, None), (3, ""), (4, "a b"), (5, good + " " + prose(2, 60_000))]
    assert ids(STAGE["quality_rules"](spark, frame(spark, rows), "")) == [(False, 1), (False, 1), (False, 5), (True, 0)]


def test_jaccard_join(spark):
    a, b, long = prose(3, 100), prose(4, 100), prose(5, 50_000)
    rows = [(7, a), (3, a), (3, a), (9, a + " more"), (None, a), (None, b), (None, b + " x"), (4, None), (5, ""), (6, None), (11, long), (12, long + " end")]
    # one row of each class, the least doc_id; wordless rows are classes of their own; a row without a doc_id stays where it reaches none with one
    assert ids(STAGE["jaccard_join"](spark, frame(spark, rows), "")) == [(False, 3), (False, 4), (False, 5), (False, 6), (False, 11), (True, 0)]


def test_substring_dedup(spark):
    passage, own, long = prose(6, 70), prose(7, 30), prose(8, 40_000)
    rows = [(1, passage), (2, passage), (2, passage), (3, own + "\n" + passage), (3, own + "\n" + passage), (None, passage), (4, None), (5, ""), (6, long), (7, passage + " " + long)]
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.text, r.n_chars) for r in STAGE["substring_dedup"](spark, frame(spark, rows), "").collect())
    assert [g[0] for g in got] == [(False, 1), (False, 3), (False, 3), (False, 4), (False, 5), (False, 6), (True, 0)]
    assert got[1][1:] == got[2][1:] == (own, len(own)) and got[0][1] == got[6][1] == passage and got[3][1:] == (None, None)


def test_best_fit_packing(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, None), (3, ""), (4, prose(9, 9000))]
    out = STAGE["best_fit_packing"](spark, frame(spark, rows), "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out if r.piece == 0) == [(False, 1), (False, 1), (False, 2), (False, 3), (False, 4), (True, 0)]
    own = sorted((r.piece, r.start, r.length) for r in out if r.doc_id == 4)
    assert [p for p, *_ in own] == list(range(len(own))) and all(s == 2048 * p for p, s, _ in own) and all(n == 2048 for *_, n in own[:-1])
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        spots.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:], strict=False)) and spots[0][0] == 0 and sum(spots[-1]) <= 2048
    assert common.SLICE_BYTES > 0
