"""Count-min sketches of the hashes found in texts, merged over partitions.

A sketch has a few rows of 2**width counters that need to tell none, one and
more apart. Each stretch of a partition sends its counters as delta-coded
offsets, block by block; blocks are summed where they meet. The sums
overestimate: a hash that any row has counted once at most is not repeated. The
result is of fixed size, so it may be broadcast; a larger corpus fills it more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from terrafold.llm.common import SLICE_BYTES, mix, slices

WIDTH_BITS, BLOCK_BITS = 27, 17
#: Hashes that a task sketches at once.
STRETCH = 500_000


def _cells(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    h = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (row + 1) % 2**64))
    return (h >> np.uint64(64 - width)).astype(np.uint32)


def _deltas(offsets: np.ndarray) -> bytes:
    """Ascending offsets as bytes: 255 moves on by 255, less than that moves on and stops there."""
    d = np.diff(offsets, prepend=0)
    n = d // 255 + 1
    out = np.full(int(n.sum()), 255, np.uint8)
    out[np.cumsum(n) - 1] = d % 255
    return out.tobytes()


def _offsets(raw: bytes) -> np.ndarray:
    d = np.frombuffer(raw, np.uint8)
    return np.cumsum(d, dtype=np.int64)[d != 255]


def sketch(docs: DataFrame, hashes_of: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray], width: int = WIDTH_BITS, depth: int = 2, most: int = SLICE_BYTES) -> np.ndarray:
    """For each row of the merged sketch of what hashes_of finds in the texts, the bitmap of counters that reached two. Texts are scanned by slices of about most bytes."""
    block = min(BLOCK_BITS, width)
    blocks = 1 << (width - block)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            h = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            for row in range(depth):
                at, n = np.unique(_cells(h, row, width), return_counts=True)
                cuts = np.searchsorted(at, np.arange(blocks + 1, dtype=np.uint64) << np.uint64(block))
                full = np.flatnonzero(np.diff(cuts))
                low = (at & np.uint32((1 << block) - 1)).astype(np.int64)
                rows = [(row * blocks + b, low[cuts[b] : cuts[b + 1]], n[cuts[b] : cuts[b + 1]]) for b in full.tolist()]
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([_deltas(r[1]) for r in rows], pa.binary()), pa.array([_deltas(r[1][r[2] > 1]) if (r[2] > 1).any() else b"" for r in rows], pa.binary())], ["cell", "once", "twice"])

        for batch, data, offsets in slices(batches, most=most):
            held.append(hashes_of(batch, data, offsets))
            if sum(map(len, held)) >= STRETCH:
                yield from flush()
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cell = None

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([cell], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], ["cell", "bits"])

        for batch in batches:
            for c, once, twice in zip(*(batch.column(n).to_pylist() for n in ("cell", "once", "twice")), strict=True):
                if c != cell:
                    if cell is not None:
                        yield done()
                    cell, counts = c, np.zeros(1 << block, np.uint8)
                for raw in (once, twice):
                    at = _offsets(raw)
                    counts[at] = np.minimum(counts[at] + 1, 2)
        if cell is not None:
            yield done()

    parts = docs.mapInArrow(own, "cell int, once binary, twice binary")
    merged = parts.repartition("cell").sortWithinPartitions("cell").mapInArrow(merge, "cell int, bits binary")
    out = np.zeros((depth * blocks, max(1, (1 << block) // 8)), np.uint8)
    for r in merged.collect():  # depth * 2**width bits in all, whatever the input
        out[r.cell] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(depth, -1)


def estimated_repeated(bitmaps: np.ndarray, hashes: np.ndarray, width: int = WIDTH_BITS) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for row in range(len(bitmaps)):
        at = _cells(hashes[out], row, width).astype(np.int64)
        out[out] = bitmaps[row][at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1
    return out
