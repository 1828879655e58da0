"""Best-fit packing by bin completion.

Documents become pieces of at most one sequence's length. How many pieces there
are of each length is all that packing has to know, so the search runs on that
histogram, which has as many entries as a sequence has tokens, whatever the
input: a bin completion branch-and-bound. At each node it takes the largest
length left and enumerates the undominated fillings around it, least waste
first, as far as the bound still allows waste, and applies
a filling as often as the lengths last, or once. States that were met with no more
sequences used are not entered again. Best fit decreasing is the first
incumbent; the search stops at the lower bound, or after a documented number of
fillings (a parameter), and returns the best solution found.

Pieces are numbered among those of their length: their number within a task,
plus what earlier tasks hold of that length. A piece's sequence and place follow
from its length and number by arithmetic, so pieces never meet in a group.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrafold.llm.common import runs, slices, stored, texts, vocabulary
from terrafold.llm.tokens import encode_words

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, part int, number long"
#: Fillings that the search may try. The best incumbent is returned at that point.
NODES = 20_000
#: What a filling that is found dominated, and so not tried, counts of one that is tried.
DOMINATED = 1 / 8
#: Nodes of the search that keep their enumeration, and with it its table of sums.
OPEN = 64
#: Full runs of best fit that are searched together with those that leave room.
FULL = 40

Run = tuple[tuple[int, ...], int]  # the lengths in a sequence, and how many such sequences


def best_fit(counts: dict[int, int], size: int) -> list[Run]:
    """Best fit decreasing over a histogram: largest first, each bin takes the largest length that still fits."""
    left, out = dict(counts), []
    lengths = sorted(left)
    while lengths:
        bin_, room, own = [], size, {}
        while True:
            k = bisect_right(lengths, room)
            while k and own.get(lengths[k - 1], 0) >= left[lengths[k - 1]]:
                k -= 1
            if not k:
                break
            x = lengths[k - 1]
            bin_.append(x)
            own[x] = own.get(x, 0) + 1
            room -= x
        times = min(left[x] // n for x, n in own.items())
        out.append((tuple(bin_), times))
        for x, n in own.items():
            left[x] -= n * times
            if not left[x]:
                lengths.remove(x)
    return out


def lower_bound(counts: dict[int, int], size: int) -> int:
    """No packing needs fewer: total length, or large pieces that cannot share plus what they cannot take in."""
    total = sum(x * n for x, n in counts.items())
    best = -(-total // size)
    if not counts:
        return 0
    n, w = np.zeros(size + 2, np.int64), np.zeros(size + 2, np.int64)
    for x, c in counts.items():
        n[x], w[x] = c, c * x
    n, w = np.cumsum(n), np.cumsum(w)
    half = size // 2
    for t in range(1, half + 1):
        alone, large, room = n[size] - n[size - t], n[size - t] - n[half], w[size - t] - w[half]
        small = w[half] - w[t - 1]
        best = max(best, int(alone + large + max(0, -(-(small - (large * size - room)) // size))))
    return best


def completions(left: dict[int, int], room: int, most_waste: int) -> Iterator[tuple[int, ...] | None]:
    """Undominated multisets of the lengths left that fill room but for at most most_waste, least waste first.

    None stands for a filling that is dominated, so that a caller can count those too.

    A filling is dominated if a piece left could be added to it, or take the place of pieces of it that are together
    as long and more than one, or shorter: whatever follows, the other filling does as well. Sums that the lengths
    cannot reach are told by a table of reachable sums, so no branch of the enumeration is in vain.
    """
    lengths = sorted(x for x, n in left.items() if n and x <= room)
    full = (1 << (room + 1)) - 1
    reach = [1]  # bit s: the first so many lengths reach the sum s
    for x in lengths:
        bits, n, step = reach[-1], min(left[x], room // x), 1
        while n:
            take = min(step, n)
            bits |= bits << (take * x) & full
            n, step = n - take, step * 2
        reach.append(bits)

    def fill(i: int, target: int, own: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if not target:
            yield own
            return
        while i and reach[i] >> target & 1:  # fewer lengths reach fewer sums
            i, x = i - 1, lengths[i - 1]
            for n in range(min(left[x], target // x), 0, -1):
                if reach[i] >> (target - n * x) & 1:
                    yield from fill(i, target - n * x, (*own, *[x] * n))

    def dominated(own: tuple[int, ...], waste: int) -> bool:
        sums, inside = 1, set(own)
        for x in own:
            sums |= sums << x
        for y in lengths:
            if own.count(y) < left[y]:
                lowest = max(0, y - waste)  # sums from here to y leave room for y in their place
                alike = sums >> lowest & ((1 << (y - lowest)) - 1) | (y not in inside and sums >> y & 1)
                if alike:
                    return True
        return False

    for waste in range(min(most_waste, room) + 1):
        if reach[-1] >> (room - waste) & 1:
            yield from (None if dominated(own, waste) else own for own in fill(len(lengths), room - waste, ()))


def pack(counts: dict[int, int], size: int, nodes: int = NODES) -> list[Run]:
    """Runs of equal sequences that hold every piece of a histogram of lengths, in as few sequences as found.

    Where best fit does not reach the lower bound, the sequences that it leaves room in, with some full ones, are
    searched anew, then all. The search is complete: what it returns within its limit of nodes is optimal. A node is a
    filling that is tried, as often as the lengths left allow or once (and then again), and counts once more for
    each 64 different lengths that are left; a dominated filling counts as DOMINATED of that. Beyond nodes, the best
    found so far is returned.
    """
    incumbent = best_fit(counts, size)
    bound = lower_bound(counts, size)
    short = [r for r in incumbent if sum(r[0]) < size]
    full = [r for r in incumbent if sum(r[0]) == size]
    for kept, part in ((full[:-FULL], full[-FULL:] + short), ([], incumbent)):
        have = sum(t for _, t in kept)
        if have + sum(t for _, t in part) > bound:
            own: dict[int, int] = {}
            for run, times in part:
                for x in set(run):
                    own[x] = own.get(x, 0) + run.count(x) * times
            found = kept + search(own, size, part, bound - have, nodes)
            incumbent = min(incumbent, found, key=lambda runs: sum(t for _, t in runs))
        if sum(t for _, t in incumbent) == bound:
            break
    return incumbent


def search(counts: dict[int, int], size: int, incumbent: list[Run], bound: int, nodes: int) -> list[Run]:
    """The branch-and-bound of pack, from an incumbent, down to bound at most."""
    best = sum(t for _, t in incumbent)
    bound = max(bound, lower_bound(counts, size))
    total = sum(x * n for x, n in counts.items())
    left = {x: n for x, n in counts.items() if n}
    chosen: list[Run] = []
    used = spare = 0
    expanded = 0.0
    seen: dict[bytes, int] = {}

    def moves() -> Iterator[Run | None]:
        top, rest = max(left), dict(left)
        rest[top] -= 1
        for own in completions(rest, size - top, (best - 1) * size - total - spare):
            if own is None:
                yield None
                continue
            own = (top, *own)
            most = min(left[x] // own.count(x) for x in set(own))
            yield own, most
            if most > 1:
                yield own, 1

    def apply(own: tuple[int, ...], times: int) -> None:
        nonlocal used, spare
        for x in set(own):
            left[x] = left.get(x, 0) - own.count(x) * times
            if not left[x]:
                del left[x]
        used, spare = used + times, spare + (size - sum(own)) * times

    # how many moves of each node are done; all but the last OPEN nodes make the others anew, so they hold no tables meanwhile
    stack = [0] if best > bound else []
    open_: dict[int, Iterator[Run | None]] = {}  # by depth
    over = object()
    while stack and best > bound and expanded < nodes:
        depth = len(stack)
        if depth not in open_:
            open_[depth] = islice(moves(), stack[-1], None)
            open_.pop(depth - OPEN, None)
        move = next(open_[depth], over)
        if move is over:
            del open_[depth]
            stack.pop()
            if chosen:
                own, times = chosen.pop()
                apply(own, -times)
            continue
        stack[-1] += 1
        if move is None:
            expanded += DOMINATED * (1 + len(left) // 64)
            continue
        own, times = move
        expanded += 1 + len(left) // 64
        if spare + (size - sum(own)) * times > (best - 1) * size - total:
            continue
        apply(own, times)
        state = blake2b(np.array(sorted(left.items()), np.int64).tobytes(), digest_size=16).digest()
        if used < best and not left:
            best, incumbent = used, [*chosen, move]
        elif used < best and seen.get(state, best) > used:
            seen[state] = used
            chosen.append(move)
            stack.append(0)
            continue
        apply(own, -times)
    return incumbent


def cut(batches: Iterator[pa.RecordBatch], vocab: str, size: int, end: int, ids_too: bool) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
    for batch, data, offsets in slices(batches):
        ids, first = encode_words(vocab, data, offsets)
        n = np.diff(first) + 1
        flat = np.full(int(n.sum()), end, np.uint32)
        begin = np.concatenate([[0], np.cumsum(n)])
        flat[runs(begin[:-1], n - 1)] = ids
        pieces = -(-n // size)
        doc = np.repeat(np.arange(batch.num_rows), pieces)
        piece = runs(np.zeros(len(pieces), np.int64), pieces)
        start = piece * size
        length = np.minimum(size, n[doc] - start)
        at = begin[doc] + start
        raw = memoryview(flat.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
        order = np.argsort(length, kind="stable")
        s = length[order]
        firsts = np.searchsorted(s, s, "left")
        number = np.empty(len(s), np.int64)
        number[order] = np.arange(len(s)) - firsts + seen[s]
        seen += np.bincount(s, minlength=size + 1)
        held = pa.ListArray.from_arrays(pa.array(np.append(at, begin[-1]), pa.int32()), pa.array(flat.astype(np.int32))) if ids_too else pa.nulls(len(at), pa.list_(pa.int32()))
        yield pa.record_batch(
            [batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), held, pa.array(np.full(len(at), part), pa.int32()), pa.array(number)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "number"],
        )


def placed(runs_: list[Run]) -> dict[str, np.ndarray]:
    """For each run and length, in order of length: the first number it takes, how many per sequence, and where."""
    rows, taken, sequence = [], {}, 0
    for own, times in runs_:
        offset = 0
        for x in sorted(set(own), reverse=True):
            n = own.count(x)
            rows.append((x, taken.get(x, 0), n, sequence, offset))
            taken[x] = taken.get(x, 0) + n * times
            offset += n * x
        sequence += times
    rows.sort()
    return dict(zip(("length", "first", "each", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pack_documents(docs: DataFrame, size: int = 2048, vocab: str | None = None, end: int = 0, ids: bool = False, nodes: int = NODES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (only on request, else null), sequence_id, offset: one row a piece.

    nodes limits the search, see pack. A document is its ids, then end; a null or empty text is end alone. Only documents longer than size are cut.
    Repeated rows are packed each on its own; a null doc_id stays null; an empty table gives no rows; other columns
    are ignored. Pieces are first written to the shared folder, so that their numbers hold whatever is lost later.
    """
    path = vocab or vocabulary("word_bpe_49k.json")
    pieces = stored(texts(docs).mapInArrow(lambda batches: cut(batches, path, size, end, ids), PIECES))
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most size rows
    plan = pieces.sparkSession.sparkContext.broadcast(placed(pack(histogram, size, nodes)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = plan.value
        key = at["length"] << 44 | at["first"]
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            k = np.searchsorted(key, length << 44 | number, "right") - 1
            own = number - at["first"][k]
            each = at["each"][k]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
            yield pa.record_batch([*columns, pa.array(at["sequence"][k] + own // each), pa.array(at["offset"][k] + own % each * length)], [*(c for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")), "sequence_id", "offset"])

    numbered = pieces.join(bases, ["part", "length"]).withColumn("number", F.col("number") + F.col("base"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "number").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, sequence_id long, offset long")
