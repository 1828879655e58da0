"""Substring deduplication behind a count-min prefilter.

Pass one counts windows of words in sketches, one for each stretch of a partition:
rows of counters that only need to tell none, one, and more. Neighbouring windows
share a counter: each is counted under its anchor, the run of four fifths of its words
with the smallest hash. Equal windows have equal anchors, so an anchor's sum over
all partitions, block by block, overestimates the count of each of its windows: one whose anchor any
row of the merged sketch has seen once at most is not repeated, and none that is
repeated is lost. Pass two sends only the windows estimated repeated, one for
each stretch and smallest document, to exact groups by a 96-bit hash. What the
groups find covered travels back to its documents as positions.

Exact copies are settled first, by hashes of whole texts: a copy of a document with a
smaller doc_id loses all its windows and need not be sketched. Which rows are copies
goes to the tasks as two bitmaps of fixed size, one of the copies and one of the rows
that the first would take for copies by chance; rows in the first alone are copies.

The merged sketch is of fixed size (sketch.py, 32 MiB) and is
broadcast as a bitmap; a larger corpus fills it more and sends more windows to
the exact groups, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import _Q, Packed, Words, in_filter, key_filter, least_places, mix, release, runs, ship, slices, stored, texts, windows, words
from terrafold.llm.sketch import WIDTH_BITS, estimated_repeated, sketch

#: Windows that an exact group holds before it keeps the first of equals only.
HELD = 1 << 20
#: Windows in one set of candidates, or positions in one answer; a stretch ends at the next slice of texts.
STRETCH = 200_000
_CHECK = 0xA24BAED4963EE407 | 1
_SENT = "bucket int, hash binary, check binary, doc binary, mark binary, position binary, covered boolean"
_FOUND = "bucket int, doc binary, mark binary, position binary"
_COVERED = "doc_id long, mark long, positions binary, key long"
RESULT = "doc_id long, text string, n_words long, n_removed long, key long"


class Windows:
    """The windows of k words within each text: their owners, how many come before each text, and their anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, k: int) -> None:
        found = Words(data, offsets)
        n = np.maximum(np.diff(found.first) - k + 1, 0)
        self.k, self.before = k, np.concatenate([[0], np.cumsum(n)])
        self.owner = np.repeat(np.arange(len(n)), n)
        self._own, self._words = runs(found.first[:-1], n), found.hashes()
        gram = max(1, 4 * k // 5)
        grams = windows(self._words, gram)
        place = least_places(grams, k - gram + 1)[self._own] if len(self._own) else self._own
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (self.owner[1:] != self.owner[:-1])
        #: Hashes and owners of the anchors, and the anchor of each window.
        self.anchors, self.anchor_owner, self.anchor = grams[place[new]], self.owner[new], np.cumsum(new) - 1

    def hashes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows at."""
        h, check = (windows(self._words, self.k, base)[self._own[at]] for base in (_Q, _CHECK))
        return h, (check >> np.uint64(32)).astype(np.uint32)


def grams_of(data: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of k words within each text."""
    return Words(data, offsets).grams(k)[0]


def _by_document(doc: np.ndarray, mark: np.ndarray, position: np.ndarray) -> pa.RecordBatch:
    """Positions gathered for each document and mark."""
    order = np.lexsort((position, mark, doc))
    doc, mark, position = doc[order], mark[order], position[order].astype(np.int32)
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1])
    first = np.flatnonzero(new)
    raw = position.tobytes()
    cells = [raw[4 * a : 4 * b] for a, b in zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=True)] if len(doc) else []
    return pa.record_batch([pa.array(doc[first]), pa.array(mark[first].astype(np.int64)), pa.array(cells, pa.binary())], ["doc_id", "mark", "positions"])


def _marks(keys: np.ndarray) -> np.ndarray:
    """Tells rows apart that share a doc_id but not a text."""
    return keys.view(np.uint64).astype(np.uint32)


def _doc_keys(doc: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return mix(doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mark.astype(np.uint64)).view(np.int64)


class Copies:
    """Tells which keys are those of exact copies of texts with a smaller doc_id, with what fits two bitmaps."""

    def __init__(self, rows: DataFrame, twins: bool = False) -> None:
        text = ["text_a", "text_b", "size"]
        keys = stored(rows.filter("doc_id is not null").select("doc_id", "key", F.xxhash64("text").alias("text_a"), F.hash("text").alias("text_b"), F.length("text").alias("size")))
        # written, so that the join after it may split a text that very many rows share
        firsts = stored(keys.groupBy(*text).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last"))
        copies = stored(keys.join(firsts, text).filter("doc_id > first").select("key").distinct())
        self.copies = Packed(key_filter(copies))
        like = keys.select("key").mapInArrow(lambda batches: (b.filter(pa.array(in_filter(self.copies, b.column(0).to_numpy()))) for b in batches), "key long")
        self.others = Packed(key_filter(like.join(copies, "key", "left_anti")))
        #: With twins, a bitmap of the keys of rows that come more than once.
        self.twins = Packed(key_filter(keys.groupBy("key").count().filter("count > 1").select("key"))) if twins else None
        release(keys, firsts, copies)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return in_filter(self.copies, keys) & ~in_filter(self.others, keys)


def covered_positions(docs: DataFrame, copies: Broadcast, k: int, width: int = WIDTH_BITS) -> DataFrame:
    """_COVERED, one row a document, stored: starts of windows that also start in a document with a smaller doc_id.

    Of windows that a document repeats within itself, the first may stand for all.
    """
    spark = docs.sparkSession

    def originals(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found = Windows(data, offsets, k)
        return found.anchors[~copies.value(batch.column("key").to_numpy())[found.anchor_owner]]

    sent = ship(spark, sketch(docs.select("text", "key"), originals, width))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            h, check, doc, mark, position = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.lexsort((position, doc, check, h))
            h, check, doc, mark, position = h[order], check[order], doc[order], mark[order], position[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
            first = np.flatnonzero(new)
            least = np.repeat(doc[first], np.diff(np.append(first, len(h))))
            here = doc > least  # covered by a document of this very stretch
            if here.any():
                for part in np.array_split(np.flatnonzero(here), max(1, int(here.sum()) >> 16)):
                    yield row(0 if not len(part) else int(doc[part[0]] % buckets), h[:0], check[:0], doc[part], mark[part], position[part], True)
            again = ~new & ~here
            again[1:] &= (doc[1:] == doc[:-1]) & (mark[1:] == mark[:-1])
            go = np.flatnonzero(~here & ~again)
            bucket = (h[go] >> np.uint64(32)).astype(np.int64) * buckets >> 32
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for part in np.split(np.arange(len(go)), cuts) if len(go) else ():
                at = go[part]
                yield row(int(bucket[part[0]]), h[at], check[at], doc[at], mark[at], position[at], False)

        def row(bucket: int, h: np.ndarray, check: np.ndarray, doc: np.ndarray, mark: np.ndarray, position: np.ndarray, covered: bool) -> pa.RecordBatch:
            cells = [pa.array([x.tobytes()], pa.binary()) for x in (h, check, doc, mark, position.astype(np.int32))]
            return pa.record_batch([pa.array([bucket], pa.int32()), *cells, pa.array([covered])], ["bucket", "hash", "check", "doc", "mark", "position", "covered"])

        for batch, data, offsets in slices(batches):
            found = Windows(data, offsets, k)
            ids = batch.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False) & ~copies.value(batch.column("key").to_numpy())
            repeated = estimated_repeated(sent.value, found.anchors, width) & known[found.anchor_owner]
            maybe = np.flatnonzero(repeated[found.anchor])
            if len(maybe):
                own = found.owner[maybe]
                marks = _marks(batch.column("key").to_numpy())
                held.append((*found.hashes(maybe), ids.fill_null(0).to_numpy(zero_copy_only=False)[own], marks[own], maybe - found.before[own]))
            if sum(len(c[0]) for c in held) >= STRETCH:
                yield from flush()
        yield from flush()

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (np.uint64, np.uint32, np.int64, np.uint32, np.int32)
        bucket, held, found, size = None, [], [], 0

        def fold() -> None:
            """Settles what is held: of equal windows only those of the smallest document so far stay."""
            h, check, doc, mark, position = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((doc, check, h))
            h, check, doc, mark, position = (x[order] for x in (h, check, doc, mark, position))
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
            first = np.flatnonzero(new)
            over = doc > np.repeat(doc[first], np.diff(np.append(first, len(h))))
            found.append((doc[over], mark[over], position[over]))
            held[:] = [tuple(x[~over] for x in (h, check, doc, mark, position))]

        def flush() -> pa.RecordBatch:
            doc, mark, position = (np.concatenate(c) for c in zip(*found, strict=True))
            found.clear()
            bucket = (_doc_keys(doc, mark).view(np.uint64) >> np.uint64(32)).astype(np.int64) * buckets >> 32
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts)).tolist()
            cells = [[x[order[cuts[k] : cuts[k + 1]]].tobytes() for k in full] for x in (doc, mark, position)]
            return pa.record_batch([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in cells)], ["bucket", "doc", "mark", "position"])

        for batch in batches:
            for b, *cells, covered in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                arrays = [np.frombuffer(c, t) for c, t in zip(cells, kinds, strict=True)]
                if covered:
                    found.append(tuple(arrays[2:]))
                    continue
                if b != bucket and held:
                    fold()
                    held, size = [], 0
                bucket = b
                held.append(tuple(arrays))
                size += len(arrays[0])
                if size > HELD:
                    fold()
                    size = len(held[0][0]) // 2  # what is left goes on; the next fold comes after as much again
            if sum(len(f[0]) for f in found) >= STRETCH:
                yield flush()
        if held:
            fold()
        if found:
            yield flush()

    def document(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        out = _by_document(*(np.concatenate(c) for c in zip(*held, strict=True)))
        keys = _doc_keys(out.column("doc_id").to_numpy(), out.column("mark").to_numpy())
        return pa.record_batch([*out.columns, pa.array(keys)], [*out.schema.names, "key"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for b, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and held:
                    yield document(held)
                    held = []
                bucket = b
                held.append([np.frombuffer(c, t) for c, t in zip(cells, (np.int64, np.uint32, np.int32), strict=True)])
        if held:
            yield document(held)

    sent_rows = docs.select("doc_id", "text", "key").mapInArrow(candidates, _SENT)
    found_rows = sent_rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(exact, _FOUND)
    covered = stored(found_rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gathered, _COVERED))
    sent.destroy()
    return covered


def remove_repeats(docs: DataFrame, k: int = 50, width: int = WIDTH_BITS) -> DataFrame:
    """RESULT: every row of docs with the words removed that lie in windows found in a document with a smaller doc_id.

    key is xxhash64(doc_id, text) of the row as it was.

    Words stay as they are; where words went, those kept are joined by one space, other texts stay unchanged. Null
    and empty texts have no words; rows with a null doc_id neither lose words nor cover any; rows that share a
    doc_id do not cover each other. An empty table gives no rows; other columns are ignored.
    """
    rows = texts(docs)
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    spark = docs.sparkSession
    copies = spark.sparkContext.broadcast(Copies(rows))

    covered = covered_positions(rows, copies, k, width)
    sent = ship(spark, key_filter(covered.select("key")))

    def split(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marks of a batch's rows, which are copies, and which others may have lost words."""
        keys = batch.column("key").to_numpy()
        valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)  # the bitmaps know nothing of other rows
        marks, copy = _marks(keys).astype(np.int64), copies.value(keys) & valid
        return marks, copy, in_filter(sent.value, _doc_keys(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), marks)) & valid & ~copy

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows that lose nothing, and copies, which lose all if they have a window."""
        for batch in batches:
            _, copy, may = split(batch)
            rest, copy = batch.filter(pa.array(~may)), copy[~may]
            counts = np.concatenate([np.diff(Words(data, offsets).first) for _, data, offsets in slices([rest])] or [np.zeros(0, np.int64)])
            gone = copy & (counts >= k)
            kept = pc.if_else(pa.array(gone), pa.scalar(""), rest.column("text"))
            yield pa.record_batch([rest.column("doc_id"), kept, pa.array(counts), pa.array(np.where(gone, counts, 0)), rest.column("key")], ["doc_id", "text", "n_words", "n_removed", "key"])

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, _, may = split(batch)
            yield pa.record_batch([*batch.columns, pa.array(marks)], ["doc_id", "text", "key", "mark"]).filter(pa.array(may))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, key, cells in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "key", "positions")), strict=True):
                ws = words(text)
                gone = np.zeros(len(ws), bool)
                if cells:
                    at = np.frombuffer(cells, np.int32)
                    raw = np.frombuffer(text.encode(), np.uint8)
                    h = grams_of(raw, np.array([0, len(raw)]), k)
                    at = np.flatnonzero(np.isin(h, h[at]))
                    steps = np.zeros(len(ws) + 1, np.int64)
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + k, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                kept = [w for w, g in zip(ws, gone.tolist(), strict=True) if not g] if gone.any() else None
                out.append((doc, text if kept is None else " ".join(kept), len(ws), int(gone.sum()), key))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], ["doc_id", "text", "n_words", "n_removed", "key"])

    losing = rows.mapInArrow(hit, "doc_id long, text string, key long, mark long").join(covered.drop("key"), ["doc_id", "mark"], "left")
    return rows.mapInArrow(whole, RESULT).unionByName(losing.mapInArrow(cut, RESULT))


def digests(result: DataFrame) -> DataFrame:
    """Counts, and the digest of the kept words joined by one space."""
    joined = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    return result.select("doc_id", "n_words", "n_removed", F.sha2(joined, 256).alias("kept_sha256"))
