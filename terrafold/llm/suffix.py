"""Removal of repeated byte strings by distributed difference-cover naming.

A byte goes if a string of LENGTH bytes that covers it also starts earlier. Which
strings are equal is found on names, not by comparing all of them:

Anchors. Of the grams (51 bytes) in a string of 100 bytes, the one with the
smallest hash is the string's anchor, so equal strings have equal anchors at equal
places, and an anchor stands for a range of strings. A count-min sketch says which
anchor grams may occur twice; runs of those are all that takes part.

Difference cover. What lies between the anchors of a run is a phrase, and phrases
have names. Triples of names at the places of a run that are 1 or 2 modulo 3 (the last
two as one fingerprint) are sorted, and their ranks name them; the names' own triples are sorted again, so that
a name spans nine phrases. The remaining places have their own phrase's name and
the name after it. Of any two places one of three such keys compares them. Places
that agree in a key, and in the bytes before them, have equal strings: all but the
first of them are covered, whole.

Remainder. Anchors that no other equals so are those at the edges of what is
repeated. Where their gram still occurs twice, the strings around them travel to
their gram's partition and are compared one by one, by 96-bit hashes. Strings of grams
with more than CROWD such anchors go by their own hashes instead, and neighbours in sorted
order are compared as they stream by, so no group is ever held.

Names of single phrases and of left contexts are 64-bit fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import _BYTE, _P, in_filter, key_filter, least_places, mix, powers, release, runs, ship, slices, stored, text_bytes, texts, windows
from terrafold.llm.sketch import WIDTH_BITS, estimated_repeated, sketch
from terrafold.llm.substring import _CHECK, Copies, _by_document, _doc_keys, _marks

RESULT = "doc_id long, n_bytes long, kept binary, starts array<int>, ends array<int>"
#: Edge anchors of one gram that are compared in one piece.
CROWD = 1000
#: Bytes of text that are sketched at once: their hashes stay in a processor's cache.
SCAN_BYTES = 1 << 16
_PLACES = "doc long, mark long, at long, rid long, idx int, n0 long, n12 long, left long, ok boolean, gram long"
#: A place, how far before it its first string starts, and how far before it its last one, in one number.
_FAR, _NEAR = 24, 12
_LOW, _HIGH = f"CAST((at >> {_FAR}) - ((at >> {_NEAR}) & 4095) AS INT) AS low", f"CAST((at >> {_FAR}) - (at & 4095) AS INT) AS high"


class Anchors:
    """The anchors of a slice of texts: owner, place, first and last string, and gram; places count from the slice's start."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        gram = length // 2 + 1
        span = length - gram + 1
        n = np.maximum(np.diff(offsets) - length + 1, 0)
        first = np.cumsum(n) - n
        h = windows(_BYTE[data], gram) if n.any() else np.zeros(0, np.uint64)
        place = least_places(h, span)
        starts = runs(offsets[:-1], n)
        at = place[starts] if len(starts) else starts
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        if len(at):
            new[first[n > 0]] = True
        one = np.flatnonzero(new)
        self.at, self.low = at[one], starts[one]
        self.high = starts[np.append(one[1:], len(at)) - 1] if len(one) else starts
        self.owner = np.searchsorted(offsets, self.low, "right") - 1
        self.gram = h[self.at] if len(one) else np.zeros(0, np.uint64)


def fingerprints(data: np.ndarray, *strings: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Of each array of strings, given by their starts and ends."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_P, len(data)), out=total[1:])
    down = powers(pow(_P, -1, 2**64), len(data) + 1)
    return [mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)) for starts, ends in strings]


def _then(x: np.ndarray, same: np.ndarray, by: int) -> np.ndarray:
    """x of the place by further on in the same run, else 0."""
    out = np.zeros_like(x)
    if len(x) > by:
        out[:-by] = np.where(same[by:] == same[:-by], x[by:], 0)
    return out


def named(df: DataFrame, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """df with the rank of each row's columns among all different ones, in their place, from a distributed sort; and the table that it reads."""
    others = [c for c in df.columns if c not in columns]
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in others) + ", sorted_part int, sorted_rank long"

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, rank = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array([batch.column(c).to_numpy() for c in columns])
            new = np.ones(x.shape[1], bool)
            new[1:] = (x[:, 1:] != x[:, :-1]).any(axis=0)
            new[0] = last is None or (x[:, 0] != last).any()
            own = rank + np.cumsum(new)
            last, rank = x[:, -1], int(own[-1])
            yield pa.record_batch([*(batch.column(c) for c in others), pa.array(np.full(len(own), part), pa.int32()), pa.array(own)], [*others, "sorted_part", "sorted_rank"])

    ranked = stored(df.repartitionByRange(*columns).sortWithinPartitions(*columns).mapInArrow(ranks, schema))
    tops = ranked.groupBy("sorted_part").agg(F.max("sorted_rank").alias("top"))  # a row for each partition of the sort
    starts = tops.select("sorted_part", F.coalesce(F.sum("top").over(Window.orderBy("sorted_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    return ranked.join(F.broadcast(starts), "sorted_part").withColumn(name, F.col("sorted_rank") + F.col("start")).drop("sorted_part", "sorted_rank", "start"), ranked


def _keys(rows: pa.Table) -> pa.RecordBatch:
    """The two keys of every place of whole runs that are sorted by place, each place followed by its rank."""
    x = {c: rows.column(c).fill_null(False if c == "ok" else 0).combine_chunks().to_numpy(zero_copy_only=False) for c in rows.schema.names}
    place = x["rank"] == 0
    number = np.cumsum(place) - 1
    rank = np.zeros(int(place.sum()), np.int64)
    rank[number[~place]] = x["rank"][~place]
    x = {c: v[place] for c, v in x.items()}
    rest, run, left, n0, n1 = x["idx"] % 3, x["rid"], x["left"].view(np.uint64), x["n0"].view(np.uint64), _then(x["n0"], x["rid"], 1).view(np.uint64)
    r0, r1, r2 = rank.view(np.uint64), _then(rank, run, 1).view(np.uint64), _then(rank, run, 2).view(np.uint64)
    a, b, c = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
    # of places that are 1 or 2: the rank; 0 or 1: the phrase and the next rank; 0 or 2: two phrases and the rank after
    kinds = ((r0, (1, 2)), (mix(n0 * a + r1) + np.uint64(1), (0, 1)), (mix(mix(n0 * a + n1) * b + r2) + np.uint64(2), (0, 2)))
    out = []
    for k, (value, own) in enumerate(kinds):
        i = np.flatnonzero(x["ok"].astype(bool) & np.isin(rest, own))
        k1 = mix(value[i] * b + left[i] + np.uint64(k))
        k2 = mix(left[i] * c + mix(value[i] + np.uint64(k + 7)))
        out.append((k1, k2, x["doc"][i], x["mark"][i], x["at"][i]))
    k1, k2, *me = (np.concatenate(v) for v in zip(*out, strict=True))
    return pa.record_batch([pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), *map(pa.array, me)], ["k1", "k2", "doc", "mark", "at"])


def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All but the first place of each key, by comparing neighbours in sorted order."""
    last: tuple | None = None  # the key now open, and the first place that has it
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, doc, mark, at = (batch.column(c).to_numpy() for c in ("k1", "k2", "doc", "mark", "at"))
        new = np.ones(len(k1), bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        new[0] = last is None or (k1[0], k2[0]) != last[:2]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(k1)), -1))
        lead = [np.where(begin < 0, 0 if last is None else last[2 + j], v[np.maximum(begin, 0)]) for j, v in enumerate((doc, mark, at))]
        i = np.flatnonzero((doc != lead[0]) | (mark != lead[1]) | (at != lead[2]))
        last = (k1[-1], k2[-1], *(v[-1] for v in lead))
        yield pa.record_batch([pa.array(v[i]) for v in (doc, mark, at)], ["doc", "mark", "at"])


def covered_places(places: DataFrame) -> DataFrame:
    """doc, mark, at of the anchors whose strings all start earlier too, by difference-cover names, stored; some come twice."""
    first, first_table = named(places.filter("idx % 3 <> 0").select("rid", "idx", "n0", "n12"), ["n0", "n12"], "r0")
    next_ = Window.partitionBy("rid", F.col("idx") % 3).orderBy("idx")
    triples = first.withColumns({"r1": F.coalesce(F.lead("r0", 1).over(next_), F.lit(0)), "r2": F.coalesce(F.lead("r0", 2).over(next_), F.lit(0))})
    ranks, ranks_table = named(triples, ["r0", "r1", "r2"], "rank")
    release(first_table)
    own = ["rid", "idx", "rank", "doc", "mark", "at", "n0", "left", "ok"]
    both = places.withColumn("rank", F.lit(0).cast("long")).select(*own).unionByName(ranks, allowMissingColumns=True)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of a run that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rid = batch.column("rid").to_numpy()
            cut = int(np.searchsorted(rid, rid[-1], "left"))
            if held and (cut or held[0].column("rid")[0].as_py() != rid[0]):
                yield _keys(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            elif cut:
                yield _keys(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield _keys(pa.Table.from_batches(held))

    keys = both.repartition("rid").sortWithinPartitions("rid", "idx", "rank").mapInArrow(merged, "k1 long, k2 long, doc long, mark long, at long")
    covered = stored(keys.repartition("k1").sortWithinPartitions("k1", "k2", "doc", "mark", "at").mapInArrow(later, "doc long, mark long, at long"))
    release(ranks_table)
    return covered


def remove_repeated_bytes(docs: DataFrame, length: int = 100, width: int = WIDTH_BITS) -> DataFrame:
    """RESULT: each row's bytes without those that a repeated string of length bytes covers, and the runs removed.

    Earlier means a smaller doc_id, or the same document and an earlier start; overlapping strings count, and all are
    judged on the input. Rows that share a doc_id but not a text are ordered by a hash of their texts; equal rows
    give equal results. Rows with a null doc_id lose nothing and cover nothing. Null and empty texts have no bytes.
    An empty table gives no rows; other columns are ignored. Texts shorter than length stay whole.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    settled = Copies(rows, twins=True)
    any_twins = bool(settled.twins.array.any())
    copies = spark.sparkContext.broadcast(settled)

    def original(batch: pa.RecordBatch) -> np.ndarray:
        return ~copies.value(batch.column("key").to_numpy()) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)

    def grams(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        a = Anchors(data, offsets, length)
        return a.gram[original(batch)[a.owner]]

    seen = ship(spark, sketch(rows, grams, width, most=SCAN_BYTES))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            a = Anchors(data, offsets, length)
            use = estimated_repeated(seen.value, a.gram, width) & original(batch)[a.owner] if len(a.at) else np.zeros(0, bool)
            i = np.flatnonzero(use)
            if not len(i):
                continue
            owner, at, low, high = a.owner[i], a.at[i], a.low[i], a.high[i]
            new = np.ones(len(i), bool)
            new[1:] = (i[1:] != i[:-1] + 1) | (owner[1:] != owner[:-1])
            run = np.cumsum(new) - 1
            idx = np.arange(len(i)) - np.flatnonzero(new)[run]
            follows = np.append(~new[1:], False)
            end = np.where(follows, np.append(at[1:], 0), high + length)
            name, left = fingerprints(data, (at, end), (low, at))
            name = name.view(np.int64)
            left = mix(left + ((at - low) * 1000 + at - high).astype(np.uint64)).view(np.int64)
            # nine phrases, or the rest of the run, reach the end of the last string
            reach = np.zeros(len(i), np.int64)
            for k in range(9):
                reach += _then(end - at, run, k) if k else end - at
            last = np.append(np.flatnonzero(new)[1:], len(i))[run]
            ok = (reach >= high + length - at) | (last - np.arange(len(i)) <= 9)
            base = offsets[owner]
            marks = _marks(batch.column("key").to_numpy()).astype(np.int64)
            first_run = run[np.searchsorted(owner, owner, "left")]
            doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)[owner]
            rid = mix(_doc_keys(doc, marks[owner]).view(np.uint64) + (run - first_run).astype(np.uint64)).view(np.int64)
            packed = (at - base) << _FAR | (at - low) << _NEAR | (at - high)
            columns = [pa.array(doc), pa.array(marks[owner]), pa.array(packed), pa.array(rid), pa.array(idx, pa.int32()), pa.array(name), pa.array(mix(_then(name, run, 1).view(np.uint64) * np.uint64(_CHECK) + _then(name, run, 2).view(np.uint64)).view(np.int64)), pa.array(left), pa.array(ok), pa.array(a.gram[i].view(np.int64))]
            yield pa.record_batch(columns, [c.split()[0] for c in _PLACES.split(", ")])

    def twin(wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(copies.value.twins, batch.column("key").to_numpy()) == wanted))

    once = rows
    if any_twins:  # a row that comes more than once has its places once
        twins, others = (rows.mapInArrow(partial(twin, wanted), rows.schema) for wanted in (True, False))
        once = others.unionByName(twins.filter("doc_id is not null").dropDuplicates(["key"]))
    found = stored(once.mapInArrow(places, _PLACES))
    seen.destroy()
    covered = covered_places(found)
    rest = stored(found.select("doc", "mark", "at", "gram").join(covered, ["doc", "mark", "at"], "left_anti"))
    release(found)
    me = F.struct("doc", "mark", "at")
    twice = rest.groupBy("gram").agg(F.min(me).alias("a"), F.max(me).alias("b"), F.count("*").alias("n")).filter("a < b").select("gram", (F.col("n") > CROWD).alias("crowd"))
    edges = rest.join(twice, "gram").selectExpr("doc", "mark", "gram", _LOW, _HIGH, "crowd").groupBy("doc", "mark").agg(F.collect_list(F.struct("gram", "low", "high", "crowd")).alias("edges"))
    whole = covered.selectExpr("doc", "mark", _LOW, _HIGH).groupBy("doc", "mark").agg(F.collect_list(F.struct("low", "high")).alias("whole"))
    lists = stored(edges.join(whole, ["doc", "mark"], "full_outer").select(F.col("doc").alias("doc_id"), "mark", "edges", "whole"))
    release(covered, rest)
    keyed = lists.select("doc_id", "mark").mapInArrow(lambda batches: (pa.record_batch([pa.array(_doc_keys(b.column(0).to_numpy(), b.column(1).to_numpy()))], ["key"]) for b in batches), "key long")
    sent = ship(spark, key_filter(keyed))

    def split(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys = batch.column("key").to_numpy()
        marks = _marks(keys).astype(np.int64)
        return marks, in_filter(sent.value, _doc_keys(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), marks)) & original(batch)

    def travelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, go = split(batch)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text"), pa.array(marks)], ["doc_id", "text", "mark"]).filter(pa.array(go))

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes around each edge anchor whose gram is no crowd's."""
        for batch in batches:
            out = []
            for doc, text, mark, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "mark", "edges")), strict=True):
                raw = text.encode()
                out += [(e["gram"], doc, mark, e["low"], raw[e["low"] : e["high"] + length]) for e in own or () if not e["crowd"]]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], ["gram", "doc", "mark", "low", "bytes"])

    def hashed(held: list[tuple]) -> tuple[np.ndarray, ...]:
        """Two hashes, document, mark and start of every string in (doc, mark, low, bytes)."""
        data = np.frombuffer(b"".join(h[3] for h in held), np.uint8)
        n = np.array([len(h[3]) for h in held])
        starts = runs(np.cumsum(n) - n, n - length + 1)
        owner = np.repeat(np.arange(len(held)), n - length + 1)
        values = _BYTE[data]
        h, check = windows(values, length)[starts], windows(values, length, _CHECK)[starts] >> np.uint64(32)
        doc, mark, low = (np.array([x[j] for x in held], np.int64)[owner] for j in range(3))
        return h, check, doc, mark, low + starts - (np.cumsum(n) - n)[owner]

    def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Strings around edge anchors of crowds: the first of each stretch, open, and those that it covers."""
        held: list[tuple] = []
        size = 0

        def close() -> pa.RecordBatch:
            h, check, *me = hashed(held)
            held.clear()
            order = np.lexsort((me[2], me[1], me[0], check, h))
            h, check, me = h[order], check[order], [x[order] for x in me]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            over = np.any([x != x[lead] for x in me], axis=0)
            go = np.flatnonzero(new | over)
            return pa.record_batch([*(pa.array(x[go].view(np.int64)) for x in (h, check, *me)), pa.array(over[go])], ["k1", "k2", "doc", "mark", "at", "over"])

        for batch in batches:
            for doc, text, mark, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "mark", "edges")), strict=True):
                raw = text.encode()
                for e in own:
                    if e["crowd"]:
                        held.append((doc, mark, e["low"], raw[e["low"] : e["high"] + length]))
                        size += len(held[-1][3])
                        if size > 1 << 20:
                            yield close()
                            size = 0
        if held:
            yield close()

    def starts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark, at = (batch.column(c).to_numpy() for c in ("doc", "mark", "at"))
            order = np.lexsort((at, mark, doc))
            yield _by_document(doc[order], mark[order], at[order].astype(np.int32))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Starts of strings that an earlier one equals; equal strings share their anchor's gram."""
        held: list[tuple] = []
        size, gram = 0, None

        def close() -> pa.RecordBatch:
            h, check, doc, mark, position = hashed(held)
            order = np.lexsort((position, mark, doc, check, h))
            same = np.zeros(len(order), bool)
            a, b = order[1:], order[:-1]
            same[1:] = (h[a] == h[b]) & (check[a] == check[b]) & ((doc[a] != doc[b]) | (mark[a] != mark[b]) | (position[a] != position[b]))
            # equal rows of one place: later ones follow the first
            twin = np.zeros(len(order), bool)
            twin[1:] = (h[a] == h[b]) & (doc[a] == doc[b]) & (mark[a] == mark[b]) & (position[a] == position[b])
            lead = np.maximum.accumulate(np.where(twin, 0, np.arange(len(order))))
            hit = order[same[lead]]
            held.clear()
            return _by_document(doc[hit], mark[hit], position[hit])

        for batch in batches:
            for g, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != gram and size > 1 << 20:
                    yield close()
                    size = 0
                gram = g
                held.append(tuple(own))
                size += len(own[3])
        if held:
            yield close()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, own, lists_ in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "whole", "positions")), strict=True):
                raw = np.frombuffer(text.encode(), np.uint8)
                steps = np.zeros(len(raw) + 1, np.int64)
                at = np.frombuffer(b"".join(lists_ or ()), np.int32)
                low = np.concatenate([np.array([w["low"] for w in own or ()], np.int64), at])
                high = np.concatenate([np.array([w["high"] for w in own or ()], np.int64), at])
                np.add.at(steps, low, 1)
                np.add.at(steps, high + length, -1)
                gone = np.cumsum(steps[:-1]) > 0
                edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                out.append((doc, len(raw), raw[~gone].tobytes(), edge[::2], edge[1::2]))
            yield _result(out)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that lose nothing, and exact copies, which lose all if they hold a string."""
        none, at_zero = np.zeros(0, np.int32), np.zeros(1, np.int32)
        for batch in batches:
            _, go = split(batch)
            valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            copy = copies.value(batch.column("key").to_numpy()) & valid
            rest, copy = batch.filter(pa.array(~go)), copy[~go].tolist()
            data, offsets = text_bytes(rest.column("text"))
            raw, out = data.tobytes(), []
            for doc, a, b, c in zip(rest.column("doc_id").to_pylist(), offsets.tolist(), offsets[1:].tolist(), copy, strict=False):
                lost = c and b - a >= length
                out.append((doc, b - a, b"" if lost else raw[a:b], at_zero if lost else none, np.array([b - a], np.int32) if lost else none))
            yield _result(out)

    bytes_ = rows.mapInArrow(travelling, "doc_id long, text string, mark long")
    together = stored(bytes_.join(lists, ["doc_id", "mark"], "left"))
    sorted_edges = together.filter("edges is not null").select("doc_id", "text", "mark", "edges").mapInArrow(strings, "gram long, doc long, mark long, low int, bytes binary").repartition("gram").sortWithinPartitions("gram")
    crowds = stored(together.filter("exists(edges, e -> e.crowd)").select("doc_id", "text", "mark", "edges").mapInArrow(crowded, "k1 long, k2 long, doc long, mark long, at long, over boolean"))
    first = crowds.filter("not over").repartition("k1").sortWithinPartitions("k1", "k2", "doc", "mark", "at").mapInArrow(later, "doc long, mark long, at long")
    found_crowds = crowds.filter("over").select("doc", "mark", "at").unionByName(first).mapInArrow(starts_of, "doc_id long, mark long, positions binary")
    hits = sorted_edges.mapInArrow(compared, "doc_id long, mark long, positions binary").unionByName(found_crowds).groupBy("doc_id", "mark").agg(F.collect_list("positions").alias("positions"))
    final = together.select("doc_id", "text", "mark", "whole").join(hits, ["doc_id", "mark"], "left").mapInArrow(cut, RESULT)
    return rows.mapInArrow(alone, RESULT).unionByName(final)


def _result(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    return pa.record_batch([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], [c.split()[0] for c in RESULT.split(", ")])


def digests(result: DataFrame) -> DataFrame:
    """Counts, and the digest of the remaining bytes."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept").to_pylist()
            n = batch.column("n_bytes").to_numpy()
            spans = batch.column("starts").value_lengths().to_numpy().astype(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n - np.array([len(k) for k in kept], np.int64)), pa.array(spans), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return result.mapInArrow(each, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
