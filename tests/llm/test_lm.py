"""The language model: gradients, proper probabilities, exact counts, and gains on held-out text."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from terrafold.llm import lm

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture
def small(monkeypatch):
    for name, value in {"WIDTH": 4, "CLASSES": 3, "LANES": 2}.items():
        monkeypatch.setattr(lm, name, value)


def test_gradients(small):
    rng = np.random.default_rng(0)
    model = lm.Model(np.array([9.0, 5, 7, 3, 2, 2, 1, 1]))
    model.flat = model.flat.astype(np.float64)
    big = lm.Model(np.array([9.0, 5, 7, 3, 2, 2, 1, 1]), model.flat + rng.normal(0, 0.2, len(model.flat)))
    inputs, targets, h = rng.integers(0, 8, (5, 3)), rng.integers(0, 8, (5, 3)), rng.normal(0, 0.5, (3, 4))
    back = big.blank()
    big.window(inputs, targets, h, back)
    for i in rng.choice(len(big.flat), 60, replace=False):
        old, around = big.flat[i], []
        for step in (1e-5, -1e-5):
            big.flat[i] = old + step
            around.append(big.window(inputs, targets, h, big.blank())[0])
        big.flat[i] = old
        assert math.isclose((around[0] - around[1]) / 2e-5, back.flat[i], rel_tol=1e-4, abs_tol=1e-6)


def test_softmax_is_proper_and_windows_carry(small, monkeypatch):
    rng = np.random.default_rng(1)
    model = lm.Model(rng.integers(1, 50, 20).astype(float))
    model.flat += rng.normal(0, 0.3, len(model.flat)).astype(np.float32)
    logs, _ = model.losses(np.repeat(rng.normal(0, 1, (1, 4)).astype(np.float32), 20, axis=0), np.arange(20))
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-5)
    tokens = rng.integers(0, 20, 700)
    first = np.array([0, 300, 301, 700])
    long = model.score(tokens, first)
    monkeypatch.setattr(lm, "SCORE_WINDOW", 7)
    monkeypatch.setattr(lm, "SCORE_LANES", 2)
    assert np.allclose(model.score(tokens, first), long, rtol=1e-4)


def corpus(n=300):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(40)]
    texts = {}
    for d in range(n):
        at, own = int(rng.integers(0, 40)), []
        for _ in range(int(rng.integers(5, 120))):
            own.append(words[at] if rng.random() < 0.95 else f"rare{rng.integers(0, 10**6)}")
            at = (at * 7 + 3) % 40 if rng.random() < 0.9 else int(rng.integers(0, 40))
        texts[d] = " ".join(own)
    return texts | {1000: None, 1001: "", 1002: "W1 w1\tÉ é", 1003: "w2 " * 30_000, 1004: "new1 new1 new2"}


def test_documents(spark):
    texts = corpus()
    df = spark.createDataFrame([(d, t, 0.5) for d, t in texts.items()], "doc_id long, text string, score double").repartition(5)
    got = {r.doc_id: r for r in lm.score_documents(df).collect()}
    assert got.keys() == texts.keys()
    tokens = {d: [*WORD.findall("".join(c.lower() if c.isascii() else c for c in t or "")), None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    count = Counter(x for d, ts in tokens.items() if not held[d] for x in ts)
    n, v = sum(count.values()), len(count)
    for d, ts in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ts), sum(count[x] > 0 for x in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts), rel_tol=1e-9)
        assert r.score < 0
    out = [r for d, r in got.items() if held[d] and d < 1000]
    assert len(out) > 10 and sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)
    assert lm.score_documents(df.limit(0)).count() == 0


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(3, "a b"), (3, "a b"), (None, "a"), (None, None)], "doc_id long, text string")
    got = lm.score_documents(df).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.train_tokens) for r in got) == [(0, 1, 9), (0, 2, 9), (3, 3, 9), (3, 3, 9)]


def test_words_are_found_by_slots():
    """Hashes that share a slot, the first and last ones, and those that are not there; also in an empty vocabulary."""
    rng = np.random.default_rng(3)
    hashes = np.unique(np.concatenate([rng.integers(0, 2**64, 3000, np.uint64), np.arange(5, 25, 2, dtype=np.uint64), 2**64 - 1 - np.arange(0, 20, 2, dtype=np.uint64)]))
    vocabulary = lm.Vocabulary(hashes, np.arange(len(hashes)) + 1, 10**9, len(hashes))
    asked = np.concatenate([hashes, hashes + np.uint64(1), hashes - np.uint64(1), np.arange(40, dtype=np.uint64)])
    at, there = vocabulary.look_up(asked)
    assert (there == np.isin(asked, hashes)).all() and (vocabulary.hashes[at[there]] == asked[there]).all()
    none = lm.Vocabulary(hashes[:0], np.zeros(0, np.int64), 0, 0)
    assert not none.look_up(asked)[1].any() and (none.numbers(asked) == lm.UNKNOWN).all()


def test_texts_in_few_lanes_score_as_alone(monkeypatch):
    """Texts that follow each other in a lane start from nothing, whatever their lengths."""
    rng = np.random.default_rng(4)
    model = lm.Model(rng.integers(1, 50, 300).astype(float))
    model.flat += rng.normal(0, 0.5, len(model.flat)).astype(np.float32)
    n = np.array([1, 400, 1, 3, 64, 65, 63, 200, 128, 1, 7])
    first = np.concatenate([[0], np.cumsum(n)])
    tokens = rng.integers(0, 300, first[-1])
    alone = [model.score(tokens[a:b], np.array([0, b - a]))[0] for a, b in zip(first, first[1:], strict=False)]
    for lanes in (1, 2, 512):
        monkeypatch.setattr(lm, "SCORE_LANES", lanes)
        assert np.allclose(model.score(tokens, first), alone, rtol=1e-4)
        assert max(len(h) for h in _state_rows(model, tokens, first, monkeypatch)) <= lm.SCORE_WINDOW * max(1, -(-len(tokens) // 400))


def _state_rows(model, tokens, first, monkeypatch):
    got, losses = [], lm.Model.losses
    with monkeypatch.context() as m:
        m.setattr(lm.Model, "losses", lambda self, h, t, back=None: (got.append(h), losses(self, h, t, back))[1])
        model.score(tokens, first)
    # every step but those at the ends of lanes has all lanes: short texts do not stand beside a long one with idle lanes
    lanes = min(lm.SCORE_LANES, -(-len(tokens) // 400))
    assert sum(len(h) for h in got) == len(tokens) and len(got) <= -(-(len(tokens) // lanes + 400) // lm.SCORE_WINDOW)
    return got


def test_all_training_documents_train(spark, monkeypatch):
    """Every training token reaches a replica once, also of a few documents; a phrase of one document is learned."""
    window = lm.Model.window

    model = lm.Model(np.ones(40))
    got = []
    monkeypatch.setattr(lm.Model, "window", lambda self, x, y, h, back: (got.append(y.ravel()), window(self, x, y, h, back))[1])
    for n in (1, 5, 63, 64, 1000, 1031):
        got.clear()
        model.train(np.arange(n) % 40)
        targets = np.bincount(np.concatenate(got), minlength=40)
        assert (targets >= np.bincount(np.arange(n) % 40, minlength=40)).all() and targets.sum() < n + lm.LANES
    monkeypatch.undo()
    docs = spark.createDataFrame([(i, "one two three four five six seven eight") for i in range(8)], "doc_id long, text string")
    vocabulary = lm.count_words(docs)
    assert (lm.fit(docs, vocabulary).flat != lm.Model(vocabulary.frequency).flat).any()


def test_great_numbers_and_classes_of_one_word(small):
    """A step from numbers of any size stays within float32; words of a class are one block; the one word of a class is certain and has no gradient."""
    rng = np.random.default_rng(5)
    model = lm.Model(np.array([9.0, 5, 7, 3, 2, 2, 1, 1]))
    assert np.diff(model.starts)[0] == 1 and all(block.flags.c_contiguous and np.shares_memory(block, model.flat) for block in model.of_class)
    model.flat += rng.normal(0, 0.3, len(model.flat)).astype(np.float32)
    h, out = np.zeros((2, 4), np.float32), np.empty((2, 4), np.float32)
    with np.errstate(all="raise"):
        model.step(np.full((3, 2, 4), 1000, np.float32), h, model.turned(model.u), np.empty((3, 2, 4), np.float32), out)
    assert np.isfinite(out).all()
    # the same by plain softmaxes, from states of usual size and of a hundred times that
    for scale in (1, 100):
        states, target, back = (scale * rng.normal(0, 1, (40, 4))).astype(np.float32), rng.integers(0, 8, 40), model.blank()
        s = np.append(states, np.ones((40, 1)), axis=1).astype(np.float64)
        want = []
        for row, t in zip(s, target, strict=True):
            c = model.class_of[t]
            logs = [x - np.log(np.exp(x - x.max()).sum()) - x.max() for x in (row @ model.classes, row @ model.of_class[c])]
            want.append(logs[0][c] + logs[1][t - model.starts[c]])
        assert np.allclose(model.losses(states, target)[0], want, rtol=1e-4, atol=1e-4)
        assert np.allclose(model.losses(states, target, back)[0], want, rtol=1e-4, atol=1e-4)
        assert (back.of_class[0] == 0).all() and np.isfinite(back.flat).all()


def test_step_is_the_plain_one(small):
    """Gates by exponentials and divisions are the usual gates."""
    rng = np.random.default_rng(6)
    model = lm.Model(np.array([9.0, 5, 7, 3]))
    x, h, out = rng.normal(0, 2, (5, 12)), rng.normal(0, 1, (5, 4)), np.empty((5, 4))
    z, r = (1 / (1 + np.exp(-(x + h @ model.u)[:, i : i + 4])) for i in (0, 4))
    new = np.tanh(x[:, 8:] + r * (h @ model.u[:, 8:]))
    turned = model.turned(x)
    model.step(turned, h, model.turned(model.u), np.empty((3, 5, 4)), out)
    assert np.allclose(out, new + z * (h - new)) and np.allclose(1 / turned[:2], [z, r])


def test_rows_are_summed_by_word():
    """Words that occur once, some times and often, also of one word alone."""
    rng = np.random.default_rng(7)
    for count in ([1], [40], [1, 1, 1], [lm.OFTEN, lm.OFTEN - 1, 2], sorted(rng.integers(1, 30, 50).tolist(), reverse=True)):
        count = np.array(count)
        word = rng.permutation(np.repeat(np.arange(len(count)), count))
        rows = rng.normal(0, 1, (len(word), 6))
        got = lm._sums(rows, np.argsort(word, kind="stable"), np.cumsum(count) - count, count)
        assert np.allclose(got, [rows[word == k].sum(axis=0) for k in range(len(count))])


def test_texts_are_numbered_once(spark):
    """Numbers of all words of every document, held-out ones too, and the occurrences of the others, by plain counting."""
    texts = {d: t or "" for d, t in corpus(40).items() if d != 1003}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    vocabulary = lm.count_words(df)
    kept = np.argsort(-vocabulary.counts, kind="stable")[:30]  # the others are rare
    few = lm.Vocabulary(vocabulary.hashes[kept], vocabulary.counts[kept], vocabulary.train_tokens, vocabulary.distinct)
    rows = lm.number_words(df, few).collect()
    docs = {r.doc_id: r for r in rows if r.bucket is None}
    assert docs.keys() == texts.keys() and len({(r.part, r.place) for r in docs.values()}) == len(docs)
    own = {d: lm.token_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for d, t in texts.items()}
    want = Counter()
    for d, h in own.items():
        r, train = docs[d], zlib.crc32(str(d).encode()) % 7 != 2
        assert (r.train, r.n, r.known) == (train, len(h), int(np.isin(h, few.hashes).sum()))
        assert np.frombuffer(r.ids, np.uint16).tolist() == few.numbers(h).tolist()
        want.update({(r.part, r.place, x): (1 if train else -1) for x in set(h.tolist()) - set(few.hashes.tolist())})
        for key in [k for k in want if k[:2] == (r.part, r.place)]:
            want[key] *= int((h == key[2]).sum())
    got = {}
    for r in rows:
        if r.bucket is not None:
            got |= {(r.part, p, h): n for h, p, n in zip(np.frombuffer(r.a, np.uint64).tolist(), np.frombuffer(r.b, np.int32).tolist(), np.frombuffer(r.c, np.int32).tolist(), strict=True)}
    assert got == dict(want)


def test_replicas_do_not_follow_partitions(spark, monkeypatch):
    """Where a session deals rows to more partitions than asked for, the same number of replicas trains."""
    docs = spark.createDataFrame([(i, "one two three four five six seven eight") for i in range(40)], "doc_id long, text string")
    vocabulary = lm.count_words(docs)
    once = lm.fit(docs, vocabulary).flat
    deal = type(docs).repartition
    monkeypatch.setattr(type(docs), "repartition", lambda self, n, *cols: deal(self, 20 if cols and isinstance(n, int) else n, *cols))
    assert (lm.fit(docs, vocabulary).flat == once).all()
