"""Conversation structure repair by lazy weighted determinisation.

A conversation's rows become symbols: the initial of the role and the fault of
the row. Edits (Keep, Rerole, Delete, Insert) turn them into roles that a small
automaton accepts, `(s?(ua)+)?`. What is left to pay from each of its four states
is a vector of costs; with its least cost taken out, few such vectors occur.

Each normalised vector is a state of a deterministic automaton, which is built
lazily: a transition (state, symbol) is worked out when it is first met, and then
read from a table. The scan goes from a conversation's last row to its first and
adds up what the transitions took out: that is the cost. The trace goes back over
it, along arcs that are tight (they cost just what the vectors say), always by
the least letter: that is the audit.

Only symbols, one byte a row, meet in the task that audits a conversation; they
come in pieces from ranges of sorted rows, so a conversation may span many
tasks. Texts stream past their audit, one row at a time.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import SPACES, small_batches, stored

#: What edits cost; a truncated row that stays costs one more.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Faults of a row, above the two bits of its role's initial.
NO_FAULT, SHORT, BLANK, TWICE = 0, 4, 8, 12
INITIALS = " sua"
#: States: nothing yet, after the system's, the user's, the assistant's. What a role inserted or changed leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {(START, 1): SYSTEM, (START, 2): USER, (SYSTEM, 2): USER, (USER, 3): ASSISTANT, (ASSISTANT, 2): USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 20
LONGEST = 2**63 - 1
AUDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPAIRED = "conv_id long, position long, edit string, role string, text string"


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """costs, where roles may be inserted first."""
    for _ in range(4):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


class Automaton:
    """Vectors of costs, less their least, as states; transitions and traces are worked out when they are first met."""

    def __init__(self) -> None:
        self.number: dict[tuple[int, ...], int] = {}
        self.vectors: list[tuple[int, ...]] = []
        #: By state and symbol: the state before it, and what was taken out.
        self.to: list[list[int]] = []
        self.paid: list[list[int]] = []
        #: By state, symbol and the automaton's state there: the letters up to the symbol's own, and the state after it.
        self.traces: dict[int, tuple[str, int]] = {}
        self.end = self._state(_inserted([0, FAR, FAR, 0]))[0]

    def _state(self, costs: tuple[int, ...]) -> tuple[int, int]:
        least = min(costs)
        vector = tuple(c - least for c in costs)
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
            self.to.append([-1] * 16)
            self.paid.append([0] * 16)
        return self.number[vector], least

    @staticmethod
    def _arcs(symbol: int, q: int) -> Iterator[tuple[str, int, int]]:
        """Edits that take the symbol in state q, by letter: cost and the next state."""
        yield "D", DELETE, q
        fault = symbol & 12
        if fault in (NO_FAULT, SHORT):
            more = TRUNCATED if fault == SHORT else 0
            if (q, symbol & 3) in KEPT:
                yield "K", more, KEPT[q, symbol & 3]
            yield "R", REROLE + more, NEXT[q]

    def _step(self, state: int, symbol: int) -> int:
        after = self.vectors[state]
        found, taken = self._state(_inserted([min(c + after[p] for _, c, p in self._arcs(symbol, q)) for q in range(4)]))
        self.to[state][symbol], self.paid[state][symbol] = found, taken
        return found

    def _trace(self, state: int, symbol: int, q: int) -> tuple[str, int]:
        after, now, taken = self.vectors[state], self.vectors[self.to[state][symbol]], self.paid[state][symbol]
        letters = ""
        while True:
            left = now[q] + taken
            tight = {x: p for x, c, p in self._arcs(symbol, q) if c + after[p] == left}
            if now[NEXT[q]] + INSERT == now[q]:
                tight["I"] = NEXT[q]
            letter = min(tight)
            letters, q = letters + letter, tight[letter]
            if letter != "I":
                return letters, q

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """The least cost of repairing symbols, and the least string of edits of that cost."""
        state, cost, to, paid, seen = self.end, 0, self.to, self.paid, array("i")
        for x in reversed(symbols):
            seen.append(state)
            found = to[state][x]
            if found < 0:
                found = self._step(state, x)
            cost += paid[state][x]
            state = found
        cost += self.vectors[state][START]
        q, out, traces = START, [], self.traces
        for i, x in enumerate(symbols):
            key = seen[len(symbols) - 1 - i] << 6 | x << 2 | q
            step = traces.get(key)
            if step is None:
                step = traces[key] = self._trace(key >> 6, x, q)
            out.append(step[0])
            q = step[1]
        while q not in (START, ASSISTANT):
            out.append("I")
            q = NEXT[q]
        return cost, "".join(out)


def _symbol() -> Column:
    """A row's symbol, as far as the row alone tells it."""
    tail = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(tail == "", BLANK).when(~F.substring(tail, -1, 1).isin(".", "!", "?"), SHORT).otherwise(NO_FAULT)
    initial = F.substring("role", 1, 1)
    own = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return (own + fault).alias("symbol")


def _rows(turns: DataFrame) -> DataFrame:
    """Null roles and texts are empty. Rows go by turn, nulls first, then role, then the SHA-256 of the text."""
    empty = F.lit("")
    rows = small_batches(turns).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    return rows.withColumn("digest", F.sha2("text", 256))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The symbols of sorted rows, a piece for each conversation and batch, with its turns."""
    names = ["conv_id", "part", "piece", "symbols", "turns", "first", "last"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    part, piece = TaskContext.get().partitionId(), 0
    for batch in batches:
        out: list[list] = []
        own: list = [None]
        before = object()
        for conv, turn, symbol, seen, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol", "seen", "n")), strict=True):
            if conv != before:
                own = [conv, part, piece, bytearray(), 0, None, None]
                out.append(own)
                before, piece = conv, piece + 1
            again = symbol if symbol & 12 == BLANK else symbol & 3 | TWICE
            own[3] += bytes([again if seen else symbol]) + bytes([again]) * (n - 1)
            if turn is not None:
                own[4] += turn != own[6]
                own[5], own[6] = turn if own[5] is None else own[5], turn
        yield pa.record_batch([pa.array([bytes(r[i]) if i == 3 else r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """AUDITS of pieces, which are sorted by conversation and place."""
    automaton = Automaton()
    names = [x.split()[0] for x in AUDITS.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def close(conv: int | None, symbols: bytes, turns: int, first: int | None, last: int | None) -> tuple:
        x = np.frombuffer(symbols, np.uint8)
        fault, role = x & 12, x & 3
        a, b = role[:-1], role[1:]
        legal = ((a == 1) & (b == 2)) | ((a == 2) & (b == 3)) | ((a == 3) & (b == 2))
        gaps = 0 if first is None else min(last - first + 1 - turns, LONGEST)
        return conv, gaps, *(int((fault == f).sum()) for f in (BLANK, TWICE, SHORT)), int((~legal).sum()), *automaton.audit(symbols)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    conv, held, turns, first, last = object(), bytearray(), 0, None, None
    for batch in batches:
        out = []
        for own, symbols, n, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "symbols", "turns", "first", "last")), strict=True):
            if own != conv:
                if held:
                    out.append(close(conv, bytes(held), turns, first, last))
                conv, held, turns, first, last = own, bytearray(), 0, None, None
            held += symbols
            if low is not None:
                turns += n - (low == last)
                first, last = low if first is None else first, high
        if out:
            yield batch_of(out)
    if held:
        yield batch_of([close(conv, bytes(held), turns, first, last)])


def audits(turns: DataFrame) -> DataFrame:
    """AUDITS: the faults of each conversation (conv_id, turn, role, text), and its cheapest repair as one letter an edit.

    Null roles and texts are empty; a null conv_id is a conversation of its own. Rows go by turn, nulls first; rows
    that share a turn go by role, then by the SHA-256 of their text. Repeated rows all count: the first may stay, the
    others are duplicates. Roles of other initials than s, u, a can only be changed or deleted. gaps is at most
    2**63 - 1. Other columns are ignored; an empty table gives no rows. Texts are not gathered, whatever their
    length: a task holds some ten bytes for each row of its longest conversation, whose audit is one value anyway.
    """
    key = ["conv_id", "role", "digest"]
    rows = _rows(turns).select(*key, "turn", _symbol())
    counted = stored(rows.groupBy(*key, "turn", "symbol").agg(F.count("*").alias("n")))
    # only what is said at several turns needs to know its first; written, so that the join may split a crowded key
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = stored(counted.groupBy(*key).agg(F.min(place).alias("least"), F.max(place).alias("most")).filter("least < most").select(*(F.col(c).alias(f"said_{c}") for c in key), "least"))
    same = [F.col(c).eqNullSafe(F.col(f"said_{c}")) for c in key]
    marked = counted.join(said, same[0] & same[1] & same[2], "left").select("conv_id", "turn", "role", "digest", "symbol", "n", F.coalesce(place > F.col("least"), F.lit(False)).alias("seen"))
    order = ["conv_id", "turn", "role", "digest"]
    ranged = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "symbol", "seen", "n")
    pieces = ranged.mapInArrow(_pieces, "conv_id long, part int, piece long, symbols binary, turns long, first long, last long")
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(_audited, AUDITS)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """REPAIRED from rows that follow their conversation's audit."""
    names = [x.split()[0] for x in REPAIRED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    conv, audit, at, q, place = None, "", 0, START, 0
    for batch in batches:
        out: list[tuple] = []

        def put(edit: str, role: str, text: str, out: list[tuple] = out) -> None:
            nonlocal place
            out.append((conv, place, edit, role, text))
            place += 1

        def insert() -> None:
            nonlocal at, q
            while at < len(audit) and audit[at] == "I":
                q, at = NEXT[q], at + 1
                put("I", NAMES[q], "")

        for own, side, edits, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "side", "audit", "role", "text")), strict=True):
            if side == 0:
                conv, audit, at, q, place = own, edits, 0, START, 0
            else:
                if audit[at] == "K":
                    q = KEPT[q, INITIALS.index(role[0])]
                    put("K", role, text)
                elif audit[at] == "R":
                    q = NEXT[q]
                    put("R", NAMES[q], text)
                at += 1
            insert()
        if out:
            yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """REPAIRED: the rows that are left of each conversation after its audit's edits (K, R or I), numbered from 0.

    The rows of a conversation stand together and in order, in one partition: they stream past their audit. turns
    must be the rows that were audited.
    """
    none = F.lit(None)
    rows = _rows(turns).select("conv_id", F.lit(1).alias("side"), "turn", "role", "digest", "text", none.cast("string").alias("audit"))
    heads = audited.select("conv_id", F.lit(0).alias("side"), none.cast("long").alias("turn"), *(none.cast("string").alias(c) for c in ("role", "digest", "text")), "audit")
    both = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "side", "turn", "role", "digest")
    return both.select("conv_id", "side", "audit", "role", "text").mapInArrow(_applied, REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each conversation's `role:text` lines, row by row."""
    conv, digest = None, None
    for batch in batches:
        out = []
        for own, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text")), strict=True):
            if place == 0:
                if digest:
                    out.append((conv, digest.hexdigest()))
                conv, digest = own, hashlib.sha256()
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
        if out:
            yield pa.record_batch([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())], ["conv_id", "sha256"])
    if digest:
        yield pa.record_batch([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["conv_id", "sha256"])


def damaged(turns: DataFrame) -> DataFrame:
    """turns with one row in twenty lost, emptied, without its ends of sentences, said twice, or said by the user."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    own = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    spoken = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    return own.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), spoken.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def digests(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """AUDITS and the repaired conversation's hash, for every conv_id of ids; zeros and empty texts for one without turns."""
    audited = stored(audits(turns))
    found = repaired(turns, audited).mapInArrow(_hashed, "conv_id long, sha256 string").withColumnRenamed("conv_id", "hashed")
    every = ids.select(F.col("conv_id").cast("long").alias("id")).distinct()
    joined = every.join(audited, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id").join(found, F.col("id").eqNullSafe(F.col("hashed")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
