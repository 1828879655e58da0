"""The prefix trie against brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from terrafold.llm import trie


def brute(sequences):
    """Rows from {conv_id: [(role, text)]}."""
    nodes = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            nodes[tuple(sequences[c][:d])].append(c)
    out = []
    for path, members in nodes.items():
        sub = [p for p in nodes if p[: len(path)] == path]
        leaf = [p for p in sub if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in sub if p)
        ends = ",".join(str(c) for c in members if len(sequences[c]) == len(path))
        kids = sum(len(p) == len(path) + 1 for p in sub)
        out.append((members[0], len(path), nodes[path[:-1]][0] if path else None, len(members), kids, len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def sequence(rows, conv):
    own = [r for r in rows if r[0] == conv]
    key = lambda r: hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}:{r[3] or ''}".encode()).hexdigest()
    own.sort(key=lambda r: (r[1] is not None, r[1] or 0, key(r)))
    return [(r[2] or "", r[3] or "") for r in own]


def rebuilt(rows):
    own = {c: sequence(rows, c) for c in {r[0] for r in rows if r[0] is not None}}
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = own.get(base, [])[:h] + s[h:]
    return out


SCHEMA = "conv_id long, turn long, role string, text string, depth int, step int, key int, node int"


def built(spark, rows):
    df = spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(df.select("conv_id"), trie.spliced(trie.steps_of(df)))
    return sorted(map(tuple, got.collect()), key=lambda r: (r[1], r[0]))


def test_random(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in [*range(-103, -97), *range(0, 40), *range(100, 130), *range(300, 303)]:
        if c == 300:
            continue  # an absent base
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ("user", "assistant")[t % 2], f"é{rng.integers(0, 2)}" * int(rng.integers(1, 3))))
    rows += [(1000, None, "user", "late"), (1000, 3, None, None), (1000, 3, None, None), (1000, 3, "a", "b"), (None, 1, "user", "x")]
    assert built(spark, rows) == brute(rebuilt(rows))


@pytest.mark.parametrize("n", [1, 3])
def test_long_copies(spark, n):
    """Copies of one long conversation need no round of their own; others leave it late."""
    whole = [(t, "user", f"t{t}") for t in range(30)]
    rows = [(100 * c, *r) for c in range(n) for r in whole]
    assert built(spark, rows) == brute(rebuilt(rows))
    rows += [(1000, *r) for r in whole[:11]] + [(1100, *r) for r in [*whole[:9], (9, "user", "other"), (10, "user", "more")]]
    assert built(spark, rows) == brute(rebuilt(rows))


def test_turnless_and_empty(spark):
    rows = [(c, 0, "user", "x") for c in range(201, 260)]
    assert any(not s for s in rebuilt(rows).values())
    assert built(spark, rows) == brute(rebuilt(rows))
    assert built(spark, []) == []
