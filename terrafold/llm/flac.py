"""Media columns as FLAC: bytes as 8-bit mono samples, stored losslessly and read back.

Encoding picks, for each frame, a constant, a fixed predictor of order 0 to 2, a
quantised linear predictor of order 2, or verbatim samples, and Rice codes the
residuals in four partitions. Decoding reads any mono 8-bit stream of those kinds
(fixed orders to 4, linear predictors to order 32, Rice parameters of 4 or 5
bits, escaped partitions), verifies the checksums of frame headers and frames
and the stream's MD5, and gives PCM blocks with their sample offsets. A seek
point for each frame says where it starts, so all frames of a batch of streams
are decoded together: step i decodes the i-th sample of every frame in numpy.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import runs, slices, texts

BLOCK, RATE, PAD = 4096, 8000, 64
PARTITIONS = 2  # as a power of two
PRECISION, SHIFT = 10, 8
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
BATCH_BYTES = 4 << 20
MEDIA = "doc_id long, n_bytes long, media binary"
BLOCKS = "doc_id long, block long, sample_offset long, pcm binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class Corrupt(ValueError):
    """A stream whose checksums or lengths do not hold."""


@lru_cache(maxsize=1)
def _crc8() -> list[int]:
    out = []
    for x in range(256):
        for _ in range(8):
            x = x << 1 ^ (0x107 if x & 0x80 else 0)
        out.append(x)
    return out


def crc8(data: bytes) -> int:
    x, table = 0, _crc8()
    for b in data:
        x = table[x ^ b]
    return x


_crc16: dict[int, np.ndarray] = {}


def crc16_table(n: int) -> np.ndarray:
    """Row d: what each byte with d bytes after it adds to a frame's CRC-16 (polynomial 0x8005)."""
    have = _crc16.get(0)
    if have is None or len(have) < n:
        x = np.arange(256, dtype=np.uint32) << 8
        for _ in range(8):
            x = np.where(x & 0x8000, x << 1 ^ 0x8005, x << 1) & 0xFFFF
        rows = [x.astype(np.uint16)]
        for _ in range(max(n, 4200) - 1):
            last = rows[-1].astype(np.uint32)
            rows.append((last << 8 & 0xFFFF).astype(np.uint16) ^ rows[0][last >> 8])
        have = _crc16[0] = np.array(rows)
    return have


def crc16(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-16 of each range of data; ranges are not empty."""
    table = crc16_table(int(lengths.max(initial=1)))
    after = np.repeat(lengths, lengths) - 1 - runs(np.zeros(len(lengths), np.int64), lengths)
    first = np.cumsum(lengths) - lengths
    return np.bitwise_xor.reduceat(table.ravel()[after << 8 | data[runs(starts, lengths)]], first)


def _coded_number(n: int) -> bytes:
    """The frame number in the extended UTF-8 of frame headers."""
    if n < 0x80:
        return bytes([n])
    tail = []
    lead = 0x3F
    while n > lead:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        lead >>= 1
    return bytes([(~lead << 1) & 0xFF | n, *tail[::-1]])


@lru_cache(maxsize=4096)
def frame_header(number: int, size: int) -> bytes:
    """Sync code, fixed block size given in 16 bits, mono, 8 bits a sample, and CRC-8."""
    head = bytes([0xFF, 0xF8, 0x70, 0x02]) + _coded_number(number) + struct.pack(">H", size - 1)
    return head + bytes([crc8(head)])


def _put(bits: np.ndarray, at: np.ndarray, value: np.ndarray, width: int) -> None:
    for j in range(width):
        bits[at + j] = value >> (width - 1 - j) & 1


def _sums(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, starts)


def encode_frames(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subframes of frames of n samples (multiples of 64) that stand one after another in x: bytes, and bytes of each."""
    first = np.cumsum(n) - n
    frame = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(x)) - first[frame]
    x1, x2 = np.zeros_like(x), np.zeros_like(x)
    x1[1:], x2[2:] = x[:-1], x[:-2]
    f = x.astype(np.float32)
    r0 = _sums(f * f, first)
    r1 = _sums(np.where(place >= 1, f * x1, 0), first)
    r2 = _sums(np.where(place >= 2, f * x2, 0), first)
    det = np.maximum(r0 * r0 - r1 * r1, 1e-6)
    top = 1 << (PRECISION - 1)
    c1, c2 = (np.clip(np.rint(a * (1 << SHIFT)), -top, top - 1).astype(np.int32) for a in (r1 * (r0 - r2) / det, (r0 * r2 - r1 * r1) / det))
    residuals = [x, x - x1, x - 2 * x1 + x2, x - ((c1[frame] * x1 + c2[frame] * x2) >> SHIFT)]
    orders = np.array([0, 1, 2, 2])
    cost = np.array([_sums(np.where(place >= o, np.abs(r), 0), first) for r, o in zip(residuals, orders, strict=True)])
    kind = cost.argmin(axis=0)
    order = orders[kind]
    e = np.choose(kind[frame], residuals)
    coded = place >= order[frame]
    u = np.where(coded, e << 1 ^ e >> 31, 0).astype(np.int64)

    part = np.repeat(n >> PARTITIONS, 1 << PARTITIONS)  # samples of each partition
    p_first = np.cumsum(part) - part
    p_count = part.copy()
    p_count[:: 1 << PARTITIONS] -= order
    mean = _sums(u, p_first) / p_count
    k = np.clip(np.floor(np.log2(np.maximum(mean * 0.75, 1))), 0, 14).astype(np.int64)
    k_of = np.repeat(k, part)
    q = u >> k_of
    width = np.where(coded, q + 1 + k_of, 0)
    start_of_part = np.zeros(len(x), bool)
    start_of_part[p_first] = True
    p_bits = _sums(width, p_first) + 4
    head = 8 + 8 * order + np.where(kind == 3, 4 + 5 + 2 * PRECISION, 0) + 6
    size = head + p_bits.reshape(-1, 1 << PARTITIONS).sum(axis=1)
    verbatim = size >= 8 + 8 * n
    low = np.minimum.reduceat(x, first) == np.maximum.reduceat(x, first)
    verbatim &= ~low
    rice = ~verbatim & ~low
    size = np.where(low, 16, np.where(verbatim, 8 + 8 * n, size))
    n_bytes = -(-size // 8)
    at = 8 * (np.cumsum(n_bytes) - n_bytes)
    bits = np.zeros(8 * int(n_bytes.sum()), np.uint8)
    _put(bits, at, np.where(low, 0, np.where(verbatim, 1, np.where(kind == 3, 32 + 1, 8 + order))) << 1, 8)
    _put(bits, at[low] + 8, x[first[low]] & 255, 8)
    v = np.flatnonzero(verbatim[frame])
    _put(bits, at[frame[v]] + 8 + 8 * place[v], x[v] & 255, 8)
    for j in range(2):
        own = np.flatnonzero(rice & (order > j))
        _put(bits, at[own] + 8 + 8 * j, x[first[own] + j] & 255, 8)
    own = np.flatnonzero(rice & (kind == 3))
    _put(bits, at[own] + 24, np.full(len(own), PRECISION - 1), 4)
    _put(bits, at[own] + 28, np.full(len(own), SHIFT), 5)
    _put(bits, at[own] + 33, c1[own], PRECISION)
    _put(bits, at[own] + 33 + PRECISION, c2[own], PRECISION)
    _put(bits, at[rice] + head[rice] - 4, np.full(int(rice.sum()), PARTITIONS), 4)
    # where each code starts: after its frame's head and the codes and partition parameters before it
    width += 4 * start_of_part
    total = np.cumsum(width)
    code = total - width + 4 * start_of_part - (total - width)[first][frame] + (at + head)[frame]
    p_rice = np.repeat(rice, 1 << PARTITIONS)
    _put(bits, (code[p_first] - 4)[p_rice], k[p_rice], 4)
    s = np.flatnonzero(coded & rice[frame])
    code, q, u, k_of = code[s] + q[s], q[s], u[s], k_of[s]
    bits[code] = 1
    for j in range(int(k_of.max(initial=0))):
        own = k_of > j
        if not own.all():
            code, u, k_of = code[own], u[own], k_of[own]
        bits[code + k_of - j] = u >> j & 1
    return np.packbits(bits), n_bytes


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload; payloads are multiples of 64 bytes, not empty."""
    lengths = np.array([len(p) for p in payloads])
    frames = -(-lengths // BLOCK)
    doc = np.repeat(np.arange(len(payloads)), frames)
    number = runs(np.zeros(len(frames), np.int64), frames)
    n = np.minimum(BLOCK, lengths[doc] - number * BLOCK)
    x = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128
    data, sizes = encode_frames(x, n)
    heads = [frame_header(a, b) for a, b in zip(number.tolist(), n.tolist(), strict=True)]
    head_sizes = np.array([len(h) for h in heads])
    whole = head_sizes + sizes + 2
    at = np.cumsum(whole) - whole
    out = np.empty(int(whole.sum()), np.uint8)
    out[runs(at, head_sizes)] = np.frombuffer(b"".join(heads), np.uint8)
    out[runs(at + head_sizes, sizes)] = data
    crc = crc16(out, at, whole - 2)
    out[at + whole - 2], out[at + whole - 1] = crc >> 8, crc & 255
    raw, streams, at, whole, n = out.tobytes(), [], at.tolist(), whole.tolist(), n.tolist()
    begin = 0
    for payload, count in zip(payloads, frames.tolist(), strict=True):
        end = begin + count
        own = raw[at[begin] : at[end - 1] + whole[end - 1]]
        block = min(BLOCK, len(payload)) if count == 1 else BLOCK
        pcm = np.frombuffer(payload, np.uint8) ^ 128  # signed samples
        info = struct.pack(">HH", max(16, block), max(16, block)) + min(whole[begin:end]).to_bytes(3, "big") + max(whole[begin:end]).to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8, "big") + hashlib.md5(pcm).digest()
        points = b"".join(struct.pack(">QQH", i * BLOCK, at[begin + i] - at[begin], n[begin + i]) for i in range(count))
        streams.append(b"fLaC\x00" + len(info).to_bytes(3, "big") + info + b"\x83" + len(points).to_bytes(3, "big") + points + own)
        begin = end
    return streams


def parse_stream(media: bytes) -> tuple[int, bytes, list[tuple[int, int, int]]]:
    """Total samples, MD5, and (sample offset, byte offset, samples) of the frames by the seek table."""
    if media[:4] != b"fLaC":
        raise Corrupt("no FLAC stream")
    at, last, info, points = 4, False, b"", b""
    while not last:
        last, kind, size = bool(media[at] & 0x80), media[at] & 0x7F, int.from_bytes(media[at + 1 : at + 4], "big")
        body = media[at + 4 : at + 4 + size]
        info, points, at = body if kind == 0 else info, body if kind == 3 else points, at + 4 + size
    packed = int.from_bytes(info[10:18], "big")
    if packed >> 36 & 31 != 7 or packed >> 41 & 7:
        raise Corrupt("not mono with 8 bits a sample")
    frames = [(s, at + o, n) for s, o, n in struct.iter_unpack(">QQH", points) if s != 2**64 - 1]
    total = packed & (1 << 36) - 1
    if sum(n for *_, n in frames) != total:
        raise Corrupt("the seek table does not cover the samples")
    return total, info[18:34], frames


def _header_sizes(media: bytes, at: int, samples: int) -> int:
    """Bytes of a frame's header, which is verified."""
    if media[at : at + 2] != b"\xff\xf8" or media[at + 3] != 0x02:
        raise Corrupt("no frame of a mono 8-bit stream")
    lead = media[at + 4]
    more = 0 if lead < 0x80 else 7 - (lead ^ 0xFF).bit_length()
    code, end = media[at + 2] >> 4, at + 5 + more
    block = {6: media[end] + 1, 7: int.from_bytes(media[end : end + 2], "big") + 1}.get(code) or (192 if code == 1 else 576 << (code - 2) if code < 6 else 256 << (code - 8))
    end += {6: 1, 7: 2}.get(code, 0)
    if block != samples or crc8(media[at:end]) != media[end]:
        raise Corrupt("a frame header's checksum or length")
    return end + 1 - at


class _Bits:
    """Reads bit fields of many lanes from one byte array."""

    def __init__(self, data: np.ndarray) -> None:
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.zeros(len(data) + 1, np.uint64)
        for j in range(8):
            self.words |= padded[j : j + len(data) + 1].astype(np.uint64) << np.uint64(56 - 8 * j)

    def peek(self, at: np.ndarray) -> np.ndarray:
        """At least 57 bits, the first on top."""
        return self.words[at >> 3] << (at & 7).astype(np.uint64)

    def take(self, at: np.ndarray, width: int) -> np.ndarray:
        return (self.peek(at) >> np.uint64(64 - width)).astype(np.int64)

    def signed(self, at: np.ndarray, width: int) -> np.ndarray:
        x = self.take(at, width)
        return x - ((x >> (width - 1)) << width)


_ZEROS = np.array([16] + [15 - x.bit_length() + 1 for x in range(1, 1 << 16)], np.int64)


def decode_frames(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Samples of subframes that start at byte at and have n samples, one frame after another."""
    order_of_lanes = np.argsort(-n, kind="stable")
    at, n = at[order_of_lanes], n[order_of_lanes]
    bits, lanes = _Bits(data), len(n)
    pos = at * 8
    kind = bits.take(pos, 8) >> 1
    pos = pos + 8
    out = np.zeros((int(n.max(initial=0)), lanes), np.int32)
    low, verbatim = kind == 0, kind == 1
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (low | verbatim | fixed | lpc).all():
        raise Corrupt("a reserved subframe type")
    for lane in np.flatnonzero(low):
        out[:, lane] = bits.signed(pos[lane : lane + 1], 8)
    for lane in np.flatnonzero(verbatim):
        begin = int(pos[lane]) >> 3
        out[: n[lane], lane] = data[begin : begin + n[lane]].view(np.int8)

    own = np.flatnonzero(fixed | lpc)
    if len(own):
        order = np.where(fixed, kind - 8, kind - 31)[own]
        most, lpc, pos, sizes = int(order.max()), lpc[own], pos[own], n[own]
        coefficients = np.zeros((most, len(own)), np.int64)
        shift = np.zeros(len(own), np.int64)
        warm = np.zeros((most, len(own)), np.int64)
        for j in range(most):
            has = order > j
            warm[j, has] = bits.signed(pos[has] + 8 * j, 8)
        pos = pos + 8 * order
        for o in np.unique(order[~lpc]):
            for j, c in enumerate(FIXED[o]):
                coefficients[j, ~lpc & (order == o)] = c
        if lpc.any():
            precision = bits.take(pos, 4) + 1
            shift[lpc] = bits.signed(pos + 4, 5)[lpc]
            for width in np.unique(precision[lpc]):
                for j in range(most):
                    has = lpc & (precision == width) & (order > j)
                    coefficients[j, has] = bits.signed(pos[has] + 9 + int(width) * j, int(width))
            pos = pos + np.where(lpc, 9 + precision * order, 0)
        method, parts = bits.take(pos, 2), bits.take(pos + 2, 4)
        if (method > 1).any() or (shift < 0).any():
            raise Corrupt("a reserved coding method")
        pos = pos + 6
        wide, per_part = 4 + method, sizes >> parts
        k, raw, change = np.zeros(len(own), np.uint64), np.zeros(len(own), bool), order.copy()
        own_rows = np.zeros((int(sizes.max()), len(own)), np.int32)
        for i in range(len(own_rows)):
            live = int(np.searchsorted(-sizes, -i, "left"))  # lanes go by falling size
            p = pos[:live]
            at_change = np.flatnonzero(change[:live] == i)
            if len(at_change):
                w = wide[at_change]
                k4 = np.where(w == 4, bits.take(p[at_change], 4), bits.take(p[at_change], 5))
                p[at_change] += w
                raw[at_change] = k4 == (1 << w) - 1
                width = bits.take(p[at_change], 5)
                p[at_change] += 5 * raw[at_change]
                k[at_change] = np.where(raw[at_change], width, k4)
                change[at_change] = (i // per_part[at_change] + 1) * per_part[at_change]
            word, kk = bits.peek(p), k[:live]
            q = _ZEROS[(word >> np.uint64(48)).astype(np.int64)]
            long = np.flatnonzero(q == 16)
            if len(long):
                far, more, going = p[long] + 16, np.full(len(long), 16), np.arange(len(long))
                while len(going):
                    if (far[going] >> 3 >= len(data)).any():
                        raise Corrupt("a code runs past the frame")
                    z = _ZEROS[(bits.peek(far[going]) >> np.uint64(48)).astype(np.int64)]
                    more[going] += z
                    far[going] += z
                    going = going[z == 16]
                q[long] = more
                low_bits = (bits.peek(p + q + 1) >> (np.uint64(64) - kk)).astype(np.int64)
            else:
                low_bits = ((word << (q + 1).astype(np.uint64)) >> (np.uint64(64) - kk)).astype(np.int64)
            ki = kk.astype(np.int64)
            u = q << ki | low_bits
            e = u >> 1 ^ -(u & 1)
            step = q + 1 + ki
            if raw[:live].any():
                r = raw[:live]
                x = (word >> (np.uint64(64) - kk)).astype(np.int64)
                x = np.where(ki > 0, x - ((x >> np.maximum(ki - 1, 0)) << ki), 0)
                e, step = np.where(r, x, e), np.where(r, ki, step)
            if most:
                acc = coefficients[0, :live] * own_rows[i - 1, :live] if i else np.zeros(live, np.int64)
                for j in range(1, min(most, i)):
                    acc += coefficients[j, :live] * own_rows[i - 1 - j, :live]
                e = e + (acc >> shift[:live])
                if i < most:
                    starting = order[:live] > i
                    e, step = np.where(starting, warm[i, :live], e), np.where(starting, 0, step)
            own_rows[i, :live] = e
            p += step
        if ((pos + 7 >> 3) > len(data)).any():
            raise Corrupt("a frame runs past the stream")
        out[: len(own_rows), own] = own_rows
    by_lane = np.ascontiguousarray(out.T)
    flat = np.empty(int(n.sum()), np.int32)
    sizes = np.empty_like(n)
    sizes[order_of_lanes] = n
    begin = (np.cumsum(sizes) - sizes)[order_of_lanes]
    flat[runs(begin, n)] = by_lane.ravel()[runs(np.arange(lanes) * out.shape[0], n)]
    return flat


def decode(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """(sample offset, samples as unsigned bytes) of every frame of each stream, after all its checks."""
    parsed = [parse_stream(m) for m in streams]
    data = np.frombuffer(b"".join(streams), np.uint8)
    base = np.cumsum([0, *map(len, streams)])
    start, body, n, end = [], [], [], []
    for media, b, (_, _, frames) in zip(streams, base.tolist(), parsed, strict=False):
        edges = [o for _, o, _ in frames[1:]] + [len(media)]
        for (_, o, samples), e in zip(frames, edges, strict=True):
            start.append(b + o)
            body.append(b + o + _header_sizes(media, o, samples))
            n.append(samples)
            end.append(b + e)
    if not n:
        return [[] for _ in streams]
    start, body, n, end = (np.array(v, np.int64) for v in (start, body, n, end))
    if (crc16(data, start, end - start)).any():  # with its own checksum at the end, a frame's CRC-16 is 0
        raise Corrupt("a frame's checksum")
    samples = decode_frames(data, body, n)
    pcm = (samples + 128).astype(np.uint8)
    signed = samples.astype(np.int8).tobytes()
    raw, at, out = pcm.tobytes(), 0, []
    for total, md5, frames in parsed:
        if hashlib.md5(signed[at : at + total]).digest() != md5:
            raise Corrupt("the stream's MD5")
        out.append([(s, raw[at + s : at + s + k]) for s, _, k in frames])
        at += total
    return out


def payload(text: bytes) -> bytes:
    return text + bytes(-len(text) % PAD or (PAD if not text else 0))


def to_flac(docs: DataFrame) -> DataFrame:
    """MEDIA: each text's UTF-8 bytes, padded with 0 to a positive multiple of 64, as a FLAC stream.

    Null and empty texts are 64 zero bytes. Every row stays, equal texts give equal streams, a null doc_id stays
    null, an empty table gives no rows; other columns are ignored.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, most=BATCH_BYTES):
            raw = data.tobytes()
            media = encode([payload(raw[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)])
            yield pa.record_batch([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return texts(docs).mapInArrow(each, MEDIA)


def _batches_of_media(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        media, at = batch.column("media").to_pylist(), 0
        while at < len(media):
            to, size = at, 0
            while to < len(media) and (to == at or size < BATCH_BYTES):
                size += len(media[to])
                to += 1
            yield batch.slice(at, to - at), media[at:to]
            at = to


def pcm_blocks(media: DataFrame) -> DataFrame:
    """BLOCKS: the samples of every frame with the sample offset where it starts. Raises Corrupt on a broken stream."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, streams in _batches_of_media(batches):
            rows = [(d, i, s, p) for d, blocks in zip(batch.column("doc_id").to_pylist(), decode(streams), strict=True) for i, (s, p) in enumerate(blocks)]
            yield pa.record_batch([pa.array([r[j] for r in rows], k) for j, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "block", "sample_offset", "pcm"])

    return media.select("doc_id", "media").mapInArrow(each, BLOCKS)


def feature(pcm: bytes) -> str:
    """Mean, root mean square, zero crossings and peak of the signed samples."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int32) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"mean={x.mean():.4f} rms={np.sqrt((x * x).mean()):.4f} crossings={crossings} peak={int(np.abs(x).max())}"


def describe(media: DataFrame) -> DataFrame:
    """FEATURES of stored streams, computed from the samples read back."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FEATURES.split(", ")]
        kinds = [pa.int64() if c.endswith("long") else pa.string() for c in FEATURES.split(", ")]
        for batch, streams in _batches_of_media(batches):
            rows = []
            for doc, n, stream, blocks in zip(batch.column("doc_id").to_pylist(), batch.column("n_bytes").to_pylist(), streams, decode(streams), strict=True):
                own = b"".join(p for _, p in blocks)
                rows.append((doc, n, len(own), hashlib.sha256(own).hexdigest(), zlib.crc32(own[-PAD:]), len(stream), hashlib.sha256(stream).hexdigest(), feature(own)))
            yield pa.record_batch([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names)

    return media.mapInArrow(each, FEATURES)
