"""Packing: ids against the library, gapless sequences, and optimal counts on small cases."""

import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import common, packing, tokens

VOCAB = common.vocabulary("word_bpe_49k.json")
ODD = ["<|endoftext|>x <|ENDOFTEXT|>", "don't I'M é É ΣΑΣ Σ", "a b\x1cc　d 12.5 x²", "", None, "<|startoftext|>", "word, Word. WORD.,", "漢字 かな 𝄞 ‍", "x" * 3000]


def optimum(sizes, room):
    if not sizes:
        return 0
    top, rest = sizes[0], sizes[1:]
    best = len(sizes)
    for k in range(len(rest) + 1):
        for pick in combinations(range(len(rest)), k):
            if top + sum(rest[i] for i in pick) <= room:
                best = min(best, 1 + optimum([x for i, x in enumerate(rest) if i not in pick], room))
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_optimal_on_small_cases(sizes):
    runs = packing.pack(dict(Counter(sizes)), 20)
    got = Counter()
    for own, times in runs:
        assert sum(own) <= 20 and times > 0
        got.update({x: own.count(x) * times for x in set(own)})
    assert got == Counter(sizes)
    n = sum(t for _, t in runs)
    best = optimum(sorted(sizes, reverse=True), 20)
    assert packing.lower_bound(dict(Counter(sizes)), 20) <= best == n


def least(counts, room):
    """The optimum by a search over states, a sequence at a time."""

    @cache
    def rest(state):
        if not state:
            return 0
        (top, n), small = state[-1], state[:-1]
        start = (*small, (top, n - 1)) if n > 1 else small
        best = 1 << 30

        def fill(i, own, room):
            nonlocal best
            if i == len(own):
                best = min(best, 1 + rest(tuple((x, k) for x, k in own if k)))
                return
            x, k = own[i]
            for take in range(min(k, room // x), -1, -1):
                fill(i + 1, (*own[:i], (x, k - take), *own[i + 1 :]), room - take * x)

        fill(0, start, room - top)
        return best

    return rest(tuple(sorted(counts.items())))


def test_optimal_with_many_equal_lengths():
    rng = np.random.default_rng(5)
    # the last two have nodes whose first dominated fillings stand before the ones that are needed
    cases = [({9: 6, 4: 3, 11: 2}, 30), ({9: 3, 5: 4, 3: 2, 6: 5, 8: 2}, 20), ({5: 3, 10: 1, 7: 3, 8: 6, 4: 1}, 20), ({16: 5, 9: 3, 13: 6, 11: 2}, 37)]
    for _ in range(1500):
        room = int(rng.integers(8, 41))
        lengths = rng.choice(np.arange(2, room + 1), int(rng.integers(1, 6)), replace=False)
        cases.append(({int(x): int(rng.integers(1, 6)) for x in lengths}, room))
    for counts, room in cases:
        runs = packing.pack(counts, room)
        assert sum((Counter({x: n * t for x, n in Counter(own).items()}) for own, t in runs), Counter()) == Counter(counts)
        assert all(sum(own) <= room for own, _ in runs)
        assert sum(t for _, t in runs) == least(counts, room), (counts, room)


def test_dominated_fillings_do_not_end_a_node():
    """Fillings behind a dominated one are still tried."""
    assert list(packing.completions({5: 3, 7: 3, 8: 6, 4: 1}, 10, 9))[:3] == [(5, 5), None, (8,)]
    counts = {5: 3, 10: 1, 7: 3, 8: 6, 4: 1}
    worst = [((x,), n) for x, n in counts.items()]
    assert sum(t for _, t in packing.search(counts, 20, worst, 0, 10**6)) == 5
    # of two tries, the better is kept
    assert sum(t for _, t in packing.pack(counts, 20, 1)) <= sum(t for _, t in packing.best_fit(counts, 20))


def test_search_beats_best_fit():
    sizes = Counter({6: 4, 5: 2, 4: 2, 3: 8, 2: 6})
    assert sum(t for _, t in packing.pack(dict(sizes), 12)) == packing.lower_bound(dict(sizes), 12)


def check(rows, texts, size):
    full = tokens.tokenizer(VOCAB)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert len(by_doc) == len(texts)
    for i, t in texts.items():
        ids = [*full.encode(t or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // size)))
        for r in own:
            part = ids[size * r.piece : size * (r.piece + 1)]
            assert (r.start, r.length, r.ids_crc32) == (size * r.piece, len(part), zlib.crc32(np.array(part, "<u4").tobytes())), i
            assert r.ids is None or list(r.ids) == part
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size


def test_documents(spark):
    rng = np.random.default_rng(3)
    texts = {i: t for i, t in enumerate(ODD)} | {100 + i: " ".join(rng.choice(["alpha", "Beta,", "gamma.", "δέλτα"], rng.integers(0, 90))) for i in range(60)}
    df = spark.createDataFrame([(i, t, 5) for i, t in texts.items()], "doc_id long, text string, offset int").repartition(5)
    for size in (16, 2048):
        check(packing.pack_documents(df, size, ids=True).collect(), texts, size)
    assert packing.pack_documents(df.limit(0)).count() == 0
    twice = packing.pack_documents(df.filter("doc_id = 100").union(df.filter("doc_id = 100"))).collect()
    assert len(twice) == 2 and len({(r.sequence_id, r.offset) for r in twice}) == 2
