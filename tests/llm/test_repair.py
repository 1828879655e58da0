"""Conversation repair against all edits, on small conversations."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import repair

BLANK, END = re.compile("[^\x20\x09-\x0d]"), re.compile("[.!?][\x20\x09-\x0d]*\\Z")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def ordered(rows, conv):
    own = [r[1:] for r in rows if r[0] == conv]
    return sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        out.append("blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen else "truncated" if not END.search(text) else "")
        seen.add((role, text))
    return out


def least(rows, found):
    """The cheapest edits by a plain search over states, with the least letters of equals: forwards, keeping all of them."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def offer(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def inserted(table):
        for _ in range(4):
            for state, (cost, letters, out) in list(table.items()):
                to = follow[state]
                offer(table, to, (cost + 2, letters + "I", (*out, ("user" if to == "u" else "assistant", ""))))
        return table

    best = inserted(best)
    for (_, role, text), fault in zip(rows, found, strict=True):
        now = {}
        for state, (cost, letters, out) in best.items():
            offer(now, state, (cost + 3, letters + "D", out))
            if fault in ("", "truncated"):
                more = int(fault == "truncated")
                to = follow[state]
                if role[:1] == to or (state == "" and role[:1] == "s"):
                    offer(now, role[:1], (cost + more, letters + "K", (*out, (role, text))))
                offer(now, to, (cost + 2 + more, letters + "R", (*out, ("user" if to == "u" else "assistant", text))))
        best = inserted(now)
    return min(v for s, v in best.items() if s in ("", "a"))


def expected(rows, conv):
    own = ordered(rows, conv)
    found = faults(own)
    cost, audit, out = least(own, found)
    turns = [t for t, *_ in own if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


SYMBOL = {"s": 1, "u": 2, "a": 3, "x": 0}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "truncated", "blank", "duplicate"])), max_size=14))
def test_audit(rows):
    codes = {"": 0, "truncated": 4, "blank": 8, "duplicate": 12}
    cost, audit = repair.Automaton().audit(bytes(SYMBOL[i] + codes[f] for i, f in rows))
    want = least([(0, i, "") for i, _ in rows], [f for _, f in rows])
    assert (cost, audit) == want[:2]


def test_few_states():
    """The lazily built automaton stays small however much it reads."""
    rng = np.random.default_rng(1)
    automaton = repair.Automaton()
    for _ in range(300):
        automaton.audit(rng.integers(0, 16, 400, dtype=np.uint8).tobytes())
    assert len(automaton.vectors) < 60


def rows_of(seed):
    rng = np.random.default_rng(seed)
    says = ["Hi.", "what now?  ", "cut off", " ", "", "Hi.", " ", "é. x", "a. b!", None]
    rows = []
    for c in range(60):
        for t in range(int(rng.integers(1, 25))):
            role = ["system", "user", "assistant", "tool", None, "User"][int(rng.choice(6, p=[0.1, 0.4, 0.38, 0.04, 0.04, 0.04]))]
            rows.append((c, None if rng.random() < 0.05 else int(t * rng.integers(1, 3)), role, says[int(rng.integers(0, len(says)))]))
    rows += [(None, 1, "user", "x."), (None, 2, "assistant", "y"), (900, None, "user", "x."), (901, 2**62, "user", "a."), (901, -(2**62) - 5, "assistant", "b.")]
    return rows


def test_against_search(spark):
    rows = rows_of(3)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, symbol int, audit string").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in repair.digests(df, repair.damaged(df)).collect()}
    after = damage(rows)
    assert got == {c: expected(after, c) for c in {r[0] for r in rows}}


def test_conversation_over_many_tasks(spark):
    """One conversation in several ranges, with turns on their edges said twice."""
    rng = np.random.default_rng(8)
    rows = [(1, t // 3, ("user", "assistant")[t % 2], f"t{rng.integers(0, 400)}" + ".?"[t % 2]) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r)[1:] for r in repair.digests(df, df).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [expected(rows, 1)]


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audits(empty).count() == 0
    assert repair.digests(empty, empty).count() == 0
    one = spark.createDataFrame([(5, 1, "user", "x")], empty.schema)
    zeros = (5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert [tuple(r) for r in repair.digests(one, empty).collect()] == [zeros]
