"""What the training-data operators share: reading, shared tables, and columnar text scans.

Words are maximal runs of characters other than space and U+0009..U+000D. All
of those separators are single UTF-8 bytes, so words, their hashes and n-grams
can be found on the bytes of a whole Arrow batch without making Python strings.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.sources.shared import stored as stored  # operators take it from here

WORD = re.compile("[^\x20\x09-\x0d]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of text that are scanned at once; a longer text is scanned alone, whole.
SLICE_BYTES = 1 << 18
#: Rows that a task hands its Python worker at once, and powers of a base that a worker keeps.
BATCH_ROWS, KEPT_POWERS = 1000, 1 << 18
#: Filters of keys have 2**FILTER_BITS bits (4 MiB).
FILTER_BITS = 25

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15 | 5  # odd multipliers of two polynomial hashes modulo 2**64
_Q = 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(docs: DataFrame) -> DataFrame:
    """docs, in a session that hands tasks at most BATCH_ROWS rows at once, since texts can be long.

    Every operator on texts begins with this; the setting holds for the session, and a smaller one stays.
    """
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", docs.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return docs


def release(*tables: DataFrame) -> None:
    """Empties stored tables that nothing reads again, so their disk is free while a query goes on."""
    for table in tables:
        files = table.inputFiles()
        if files:
            table.sparkSession.createDataFrame([], table.schema).write.mode("overwrite").parquet(files[0].rpartition("/")[0])


def texts(docs: DataFrame, *more: str | Column) -> DataFrame:
    """(doc_id long, text string) and what else is named; other columns go, null texts are empty."""
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def words(text: str) -> list[str]:
    """The words of text. str.split() knows more separators; where it found one of those, the exact pattern decides."""
    found = text.split()
    if sum(map(len, found)) != len(text) - sum(map(text.count, SPACES)):
        return WORD.findall(text)
    return found


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of MurmurHash3), in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64. Up to KEPT_POWERS of them are kept; more are made anew for a long text."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def windows(values: np.ndarray, k: int, base: int = _Q) -> np.ndarray:
    """Hashes of all windows of k consecutive values, by prefix sums of a polynomial."""
    n = len(values)
    if n < k:
        return np.zeros(0, np.uint64)
    up = powers(base, n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=total[1:])
    down = powers(pow(base, -1, 2**64), n - k + 1)
    return mix((total[k:] - total[: n - k + 1]) * down)


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """Where the least of span values from each place on is, the last of equals."""
    n, least, width = max(0, len(values) - span + 1), values, 1
    while width < span and n:
        step = min(width, span - width)
        least = np.minimum(least[step:], least[:-step])
        width += step
    if not n:
        return np.zeros(0, np.int64)
    # a place stays until its value is left behind or one as small enters; what is left behind with no equal after it is followed by a greater
    entered, moves = values[span - 1 :] == least, np.ones(n, bool)
    np.greater(least[1:], least[:-1], out=moves[1:])
    moves |= entered
    at = np.flatnonzero(moves)
    place = at + (span - 1)
    search = np.flatnonzero(~entered.take(at))
    place[search] -= np.lib.stride_tricks.sliding_window_view(values, span)[at[search], ::-1].argmin(axis=1)
    return np.repeat(place, np.diff(at, append=n))


class Words:
    """The words of a slice of texts: starts and ends in data, hashes, and the number of words before each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        """data: the texts' bytes; offsets: where each text starts in data, and the end of the last."""
        self.data, self.offsets = data, offsets
        gap = np.ones(len(data) + 2, bool)
        gap[1:-1] = _SEPARATOR[data]
        edges = gap[1:] != gap[:-1]
        cuts = offsets[1:-1]
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        joined = inner[~gap[inner] & ~gap[inner + 1]]  # two texts meet inside a run of word bytes
        starts, ends = np.flatnonzero(edges & gap[:-1]), np.flatnonzero(edges & ~gap[:-1])
        if len(joined):
            joined = np.unique(joined)
            starts, ends = np.sort(np.concatenate([starts, joined])), np.sort(np.concatenate([ends, joined]))
        self.starts, self.ends = starts, ends
        self.first = np.searchsorted(starts, offsets)
        self._lower = lower

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if self._lower else _BYTE)[self.data] * powers(_P, n), out=total[1:])
        down = powers(pow(_P, -1, 2**64), n)
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the k-word windows that lie within one text, and the number of such windows before each text."""
        n = np.diff(self.first)
        has = np.maximum(n - k + 1, 0)
        before = np.concatenate([[0], np.cumsum(has)])
        return windows(self.hashes(), k)[runs(self.first[:-1], has)], before


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lengths[0] of them), then the same for starts[1], and so on."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets of a column without nulls; both start at 0."""
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of about most bytes of text at a time, with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
        pa.default_memory_pool().release_unused()


class Packed:
    """An array that travels compressed where most of it is 0; whoever unpickles it gets the array."""

    def __init__(self, array: np.ndarray) -> None:
        self.array = array

    def __reduce__(self) -> tuple:
        if 8 * np.count_nonzero(self.array) < self.array.size:
            return _unpacked, (zlib.compress(np.ascontiguousarray(self.array), 1), self.array.dtype.str, self.array.shape)
        return np.asarray, (self.array,)


def _unpacked(raw: bytes, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), kind).reshape(shape)


def ship(spark: SparkSession, array: np.ndarray) -> Broadcast:
    return spark.sparkContext.broadcast(Packed(array))


def _filter_bits(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap of 2**FILTER_BITS bits with those of all keys (one long column) set: of fixed size, so it may be broadcast.

    It says of every key that it may be there, and of few others; those must do no harm.
    """
    block = 16

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            bits = np.unique(_filter_bits(batch.column(0).to_numpy()))
            cuts = np.flatnonzero(np.diff(bits >> block)) + 1
            for part in np.split(bits, cuts) if len(bits) else ():
                own.setdefault(int(part[0]) >> block, np.zeros(1 << block, bool))[part & ((1 << block) - 1)] = True
        for k, flags in own.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["block", "bits"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("block").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                bits = np.frombuffer(raw, np.uint8)
                own[k] = own[k] | bits if k in own else bits
        for k, bits in own.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([bits.tobytes()], pa.binary())], ["block", "bits"])

    schema = "block int, bits binary"
    rows = keys.mapInArrow(blocks, schema).repartition("block").mapInArrow(merged, schema)
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in rows.collect():  # at most 2**(FILTER_BITS - block) rows of 8 KiB
        at = r.block << (block - 3)
        out[at : at + (1 << (block - 3))] |= np.frombuffer(r.bits, np.uint8)
    return out


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = _filter_bits(keys)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    return public_tokenizers.path(name)
