"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last 32 bytes cuts every text into chunks, so equal
passages give equal chunks wherever they stand. Chunks found more than once are
encoded once, in the partition that their key falls to, and joined back to
where they occur; the rest of a text is encoded where it is read. Only
documents that hold shared chunks travel, as token ids.

A cut may fall inside what the vocabulary would merge. Each join of two
encoded pieces is therefore repaired: a window of whole units around it is
encoded again, and grows unit by unit until what it gives at both ends is
exactly what the pieces have there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import _BYTE, _P, Words, in_filter, key_filter, mix, powers, runs, ship, slices, text_bytes, texts, vocabulary
from terrafold.llm.tokens import ODD_SPACE, Encoder, UnitTable, byte_letters, tokenizer

#: A cut follows where this many high bits of the rolling hash are 0: chunks of 1 KiB on average.
CUT_BITS = 10
ENCODED = "doc_id long, n_tokens long, ids binary"
_SPACE = b" \t\n\x0b\x0c\r"
_PARTS = "row long, doc_id long, part long, key long, ids binary"


def cuts(data: np.ndarray, offsets: np.ndarray, bits: int = CUT_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks in data, and the number of chunks before each text. Cuts fall on character boundaries."""
    h = _BYTE[data].astype(np.uint32)
    for step in (1, 2, 4, 8, 16):  # h[i] = sum of 2**j * byte[i - j] for j < 32
        h[step:] += h[:-step] << np.uint32(step) if step < 32 else 0
    ends = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1
    ends = ends[ends < len(data)]
    for _ in range(3):
        inside = data[ends] & 0xC0 == 0x80
        if not inside.any():
            break
        ends = ends + inside
        ends = ends[ends < len(data)]
    ends = np.unique(np.concatenate([ends, offsets[1:]]))
    ends = ends[ends > 0]
    return ends, np.searchsorted(ends, offsets, "right") - np.searchsorted(ends, offsets[:1], "right")


def chunk_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_P, len(data)), out=total[1:])
    down = powers(pow(_P, -1, 2**64), len(data) + 1)
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)).view(np.int64)


def text_offsets(batch: pa.RecordBatch) -> np.ndarray:
    return text_bytes(batch.column("text"))[1]


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of rows with data, and starts, ends, keys and first chunk of their texts. Empty texts have no chunk."""
    for batch, data, offsets in slices(batches):
        ends, _ = cuts(data, offsets) if len(data) else (np.zeros(0, np.int64), None)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        first = np.searchsorted(starts, offsets)
        yield batch, data, starts, ends, chunk_keys(data, starts, ends), first


@lru_cache(maxsize=1)
def _units(path: str) -> UnitTable:
    return UnitTable(Encoder(path, False).unit)


def encode_pieces(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces of text, each by itself, and the number of ids before each piece.

    Units are white space and the word after it, or white space that ends a piece.
    """
    found = Words(data, offsets)
    n = np.diff(found.first)
    last = offsets[:-1].copy()
    last[n > 0] = found.ends[found.first[1:][n > 0] - 1]
    ends = np.sort(np.concatenate([found.ends, offsets[1:][last < offsets[1:]]]))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    ids, before, _ = _units(path).encoded(data, starts, ends, chunk_keys(data, starts, ends).view(np.uint64))
    return ids, before[np.searchsorted(starts, offsets)]


def odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with white space that the vocabulary knows and words do not; they are encoded whole."""
    raw, flags = data.tobytes(), np.zeros(len(offsets) - 1, bool)
    if any(x in raw for x in (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")):
        for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist(), strict=False)):
            flags[i] = ODD_SPACE.search(raw[a:b].decode()) is not None
    return flags


@lru_cache(maxsize=1)
def byte_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids one after another, where each starts, and how many."""
    t = tokenizer(path)
    back = {letter: b for b, letter in enumerate(byte_letters())}
    added = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    size = t.get_vocab_size()
    each = [added[i] if i in added else bytes(back[c] for c in t.id_to_token(i)) for i in range(size)]
    return _joined(each)


@lru_cache(maxsize=1)
def _decimals() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _joined([b"%d," % i for i in range(1 << 16)])


def _joined(each: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in each])
    return np.frombuffer(b"".join(each), np.uint8), np.cumsum(n) - n, n


def expand(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """The table's entries for ids, joined, and where each id's begins."""
    flat, starts, n = table
    own = n[ids]
    return flat[runs(starts[ids], own)].tobytes(), np.concatenate([[0], np.cumsum(own)])


def decode(ids: np.ndarray, path: str) -> str:
    return expand(ids, byte_table(path))[0].decode("utf-8", "replace")


def _unit_starts(raw: bytes) -> list[int]:
    """Where units begin: white space after something else."""
    return [i for i in range(1, len(raw)) if raw[i] in _SPACE and raw[i - 1] not in _SPACE]


class _End:
    """The side of an encoded piece that faces a join: its units' bytes and ids, taken one at a time."""

    def __init__(self, ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], left: bool) -> None:
        self.ids, self.table, self.left = ids, table, left

    def outer(self, units: int) -> tuple[bytes, int, int]:
        """Bytes of that many units next to the join, how many ids they have, and how many of these make the outermost unit."""
        n = 64
        while True:
            near = self.ids[-n:] if self.left else self.ids[:n]
            raw, at = expand(near, self.table)
            places = set(at.tolist())
            marks = [m for m in _unit_starts(raw) if m in places]
            whole = len(near) == len(self.ids)
            marks = ([0] if whole and self.left else []) + marks + ([len(raw)] if whole and not self.left else [])
            if self.left:
                marks = marks[::-1]
            if len(marks) >= units or whole:
                k = min(units, len(marks)) - 1
                mark, inner = marks[k], marks[k - 1] if k else (len(raw) if self.left else 0)
                count = int(np.searchsorted(at, mark))
                inside = int(np.searchsorted(at, inner))
                if self.left:
                    return raw[mark:], len(near) - count, inside - count
                return raw[:mark], count, count - inside
            n *= 4


def repaired(left: np.ndarray, right: np.ndarray, path: str) -> tuple[int, np.ndarray, int]:
    """What the join of two pieces' ids becomes: new ids in place of left's last n and right's first m."""
    table, full = byte_table(path), tokenizer(path)
    a, b, units = _End(left, table, True), _End(right, table, False), 2
    while True:
        before, n, outer_a = a.outer(units)
        after, m, outer_b = b.outer(units)
        ids = np.array(full.encode((before + after).decode(), add_special_tokens=False).ids, np.uint16)
        agree_a = n == len(left) or (outer_a <= len(ids) and np.array_equal(ids[:outer_a], left[len(left) - n :][:outer_a]))
        agree_b = m == len(right) or (outer_b <= len(ids) and np.array_equal(ids[len(ids) - outer_b :], right[m - outer_b : m]))
        if agree_a and agree_b:
            return n, ids, m
        units *= 2


def joined(pieces: list[np.ndarray], path: str) -> np.ndarray:
    """The ids of the text that the pieces' texts make together."""
    out, size = np.empty(sum(map(len, pieces)) + 64, np.uint16), 0
    for piece in pieces:
        n, ids, m = repaired(out[:size], piece, path) if size and len(piece) else (0, piece[:0], 0)
        size -= n
        for part in (ids, piece[m:]):
            if size + len(part) > len(out):
                out = np.concatenate([out, np.empty(len(out) + len(part), np.uint16)])
            out[size : size + len(part)] = part
            size += len(part)
    return out[:size]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for *_, keys, _ in chunked(batches):
        distinct, n = np.unique(keys, return_counts=True)
        yield pa.record_batch([pa.array(distinct), pa.array(n)], ["key", "n"])


def _with_shared(bits: np.ndarray, odd: np.ndarray, keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which chunks are taken as shared, and which texts hold one. Odd texts take none."""
    hit = in_filter(bits, keys)
    hit &= ~np.repeat(odd, np.diff(first))
    before = np.concatenate([[0], np.cumsum(hit)])
    return hit, before[first[1:]] > before[first[:-1]]


def encode_documents(docs: DataFrame, vocab: str | None = None) -> DataFrame:
    """ENCODED: ids as little-endian unsigned 16-bit numbers, one row for each row of docs.

    Null and empty texts have no ids. Repeated rows are encoded each on its own row; a null doc_id stays null; an
    empty table gives no rows; other columns are ignored. Equal to the library's encode(text,
    add_special_tokens=False) of a byte-level vocabulary of at most 65,536 ids without normaliser, also for texts
    that hold its special tokens' strings. Texts with white space outside space and U+0009..U+000D are encoded
    whole, without chunks.
    """
    path = vocab or vocabulary("byte_bpe_50k.json")
    rows = texts(docs)
    shared = rows.select("text").mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    sent = ship(docs.sparkSession, key_filter(shared.select("key")))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the texts without shared chunks."""
        for batch, data, starts, ends, keys, first in chunked(batches):
            offsets = text_offsets(batch)
            odd = odd_texts(data, offsets)
            _, travels = _with_shared(sent.value, odd, keys, first)
            plain = np.flatnonzero(~travels & ~odd)
            lengths = np.diff(offsets)[plain]
            ids, before = encode_pieces(path, data[runs(offsets[:-1][plain], lengths)], np.concatenate([[0], np.cumsum(lengths)]))
            blob = ids.tobytes()
            cells = [blob[2 * a : 2 * b] for a, b in zip(before.tolist(), before[1:].tolist(), strict=False)]
            n = np.diff(before).tolist()
            for i in np.flatnonzero(odd).tolist():
                own = tokenizer(path).encode(batch.column("text")[i].as_py(), add_special_tokens=False).ids
                cells.append(np.array(own, np.uint16).tobytes())
                n.append(len(own))
            kept = pa.array(np.concatenate([plain, np.flatnonzero(odd)]))
            yield pa.record_batch([batch.column("doc_id").take(kept), pa.array(n, pa.int64()), pa.array(cells, pa.binary())], ["doc_id", "n_tokens", "ids"])

    def chunk_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shared chunks of a slice, each once."""
        for batch, data, starts, ends, keys, first in chunked(batches):
            hit, _ = _with_shared(sent.value, odd_texts(data, text_offsets(batch)), keys, first)
            distinct, one = np.unique(keys[hit], return_index=True)
            at, raw = np.flatnonzero(hit)[one], data.tobytes()
            yield pa.record_batch([pa.array(distinct), pa.array([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], pa.binary())], ["key", "text"])

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            ids, before = encode_pieces(path, data, offsets)
            blob = ids.tobytes()
            yield pa.record_batch([batch.column("key"), pa.array([blob[2 * a : 2 * b] for a, b in zip(before.tolist(), before[1:].tolist(), strict=False)], pa.binary())], ["key", "shared"])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with shared chunks: a row for each of these, and one with its ids for each stretch between them."""
        for batch, data, starts, ends, keys, first in chunked(batches):
            hit, travels = _with_shared(sent.value, odd_texts(data, text_offsets(batch)), keys, first)
            begins = np.zeros(len(keys) + 1, bool)
            begins[first] = True
            begins[:-1][hit] = True
            begins[1:][hit] = True
            at = np.flatnonzero(begins[:-1])
            doc = np.searchsorted(first, at, "right") - 1
            start, end = starts[at], np.append(starts[at][1:], len(data))
            go = travels[doc]
            at, doc, start, end = at[go], doc[go], start[go], end[go]
            own = ~hit[at]
            lengths = (end - start)[own]
            ids, before = encode_pieces(path, data[runs(start[own], lengths)], np.concatenate([[0], np.cumsum(lengths)]))
            blob, cells = ids.tobytes(), np.full(len(at), None, object)
            cells[own] = [blob[2 * a : 2 * b] for a, b in zip(before.tolist(), before[1:].tolist(), strict=False)]
            row = batch.column("row").to_numpy()[doc]
            # a stretch's own key is its row and place, mixed: it meets no chunk, or one whose ids it does not take
            key = np.where(own, mix((row * 1_000_003 + at).astype(np.uint64)).view(np.int64), keys[at])
            yield pa.record_batch([pa.array(row), batch.column("doc_id").take(pa.array(doc)), pa.array(at), pa.array(key), pa.array(cells, pa.binary())], ["row", "doc_id", "part", "key", "ids"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = doc_id = None
        out: list[tuple[int, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array([d for d, _ in out], pa.int64()), pa.array([len(x) for _, x in out], pa.int64()), pa.array([x.tobytes() for _, x in out], pa.binary())], ["doc_id", "n_tokens", "ids"])

        for batch in batches:
            for row, doc, cell in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "ids")), strict=True):
                if row != last and held:
                    out.append((doc_id, joined(held, path)))
                    held = []
                last, doc_id = row, doc
                held.append(np.frombuffer(cell, np.uint16))
            yield flush()
            out.clear()
        if held:
            out.append((doc_id, joined(held, path)))
            yield flush()

    text_only = rows.select("text").mapInArrow(chunk_texts, "key long, text binary").groupBy("key").agg(F.first("text").cast("string").alias("text"))
    encoded = text_only.mapInArrow(encode_chunks, "key long, shared binary")
    pieces = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(parts, _PARTS)
    filled = pieces.join(encoded, "key", "left").select("row", "doc_id", "part", F.coalesce("ids", "shared").alias("ids"))
    together = filled.repartition("row").sortWithinPartitions("row", "part").mapInArrow(assemble, ENCODED)
    return rows.mapInArrow(alone, ENCODED).unionByName(together)


def digests(encoded: DataFrame, vocab: str | None = None) -> DataFrame:
    """Counts and digests of ids, and of the text that they decode to."""
    path = vocab or vocabulary("byte_bpe_50k.json")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell in batch.column("ids").to_pylist():
                ids = np.frombuffer(cell, np.uint16)
                out.append((hashlib.sha256(expand(ids, _decimals())[0][:-1]).hexdigest(), hashlib.sha256(decode(ids, path).encode()).hexdigest()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_tokens"), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
