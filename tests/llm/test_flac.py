"""FLAC: exact round trips, a plain bit-by-bit decoder as the reference, and damage that is noticed."""

import hashlib
import zlib

import numpy as np
import pytest

from terrafold.llm import flac


class Reader:
    def __init__(self, data):
        self.bits = "".join(f"{b:08b}" for b in data)
        self.at = 0

    def take(self, n):
        self.at += n
        return int(self.bits[self.at - n : self.at] or "0", 2) if n else 0

    def signed(self, n):
        x = self.take(n)
        return x - (1 << n) if n and x >> (n - 1) else x


def plain_subframe(data, n):
    r = Reader(data)
    kind = r.take(8) >> 1
    if kind == 0:
        return [r.signed(8)] * n
    if kind == 1:
        return [r.signed(8) for _ in range(n)]
    order = kind - 8 if kind < 32 else kind - 31
    x = [r.signed(8) for _ in range(order)]
    coefficients, shift = flac.FIXED[order] if kind < 32 else None, 0
    if kind >= 32:
        width = r.take(4) + 1
        shift = r.signed(5)
        coefficients = [r.signed(width) for _ in range(order)]
    method, parts = r.take(2), r.take(4)
    for p in range(1 << parts):
        k = r.take(4 + method)
        raw = k == (1 << 4 + method) - 1
        width = r.take(5) if raw else 0
        for _ in range((n >> parts) - (order if p == 0 else 0)):
            if raw:
                e = r.signed(width)
            else:
                q = 0
                while not r.take(1):
                    q += 1
                u = q << k | r.take(k)
                e = u >> 1 ^ -(u & 1)
            x.append(e + (sum(c * v for c, v in zip(coefficients, x[::-1])) >> shift))
    return x


def payloads():
    rng = np.random.default_rng(1)
    text = ("The quiet boats. Été à Paris, größer. " * 400).encode()
    wave = (128 + 100 * np.sin(np.arange(9000) / 9)).astype(np.uint8).tobytes()
    found = [b"", b"a", text, wave, rng.bytes(5000), b"z" * 70, bytes(range(256)) * 3, b"\x00" * 4096 + b"\xff" * 4000 + b"\x80" * 300, text[:4096], (b"\x80" * 600 + b"\x00" + b"\x80" * 39)]
    return [flac.payload(p) for p in found]


def test_round_trip_and_plain_decoder():
    own = payloads()
    streams = flac.encode(own)
    kinds = set()
    for p, s, blocks in zip(own, streams, flac.decode(streams)):
        assert b"".join(b for _, b in blocks) == p and [o for o, _ in blocks] == list(range(0, len(p), flac.BLOCK))
        total, md5, frames = flac.parse_stream(s)
        assert total == len(p)
        for offset, at, n in frames:
            body = s[at + flac._header_sizes(s, at, n) :]
            kinds.add(body[0] >> 1)
            assert bytes(v + 128 for v in plain_subframe(body, n)) == p[offset : offset + n]
    assert {0, 1, 33} <= kinds and kinds & {8, 9, 10}


def bitstring(fields):
    text = "".join(f"{v & (1 << w) - 1:0{w}b}" for v, w in fields)
    text += "0" * (-len(text) % 8)
    return np.array([int(text[i : i + 8], 2) for i in range(0, len(text), 8)], np.uint8)


def test_decoder_reads_what_the_encoder_never_writes():
    """Fixed orders 3 and 4, long unary codes, 5-bit parameters, escaped partitions, higher linear predictors."""
    codes = lambda e, k: [(1, ((e << 1 ^ e >> 63) >> k) + 1)] + ([(e << 1 ^ e >> 63, k)] if k else [])
    rng = np.random.default_rng(2)
    frames = []
    for order in (3, 4):
        e = rng.integers(-2, 3, 16 - order).tolist()
        frames.append([((8 + order) << 1, 8), *((v, 8) for v in (3, 1, -2, 4)[:order]), (0, 2), (1, 4), (0, 4), *(c for v in e[: 8 - order] for c in codes(v, 0)), (1, 4), *(c for v in e[8 - order :] for c in codes(v, 1))])
    frames.append([(8 << 1, 8), (1, 2), (0, 4), (0, 5), *(c for v in [60, -60, 20, 0] * 4 for c in codes(v, 0))])
    frames.append([(8 << 1, 8), (1, 2), (0, 4), (0, 5), *(c for v in [9, -30, 50, 1] * 4 for c in codes(v, 0))])
    frames.append([(9 << 1, 8), (5, 8), (0, 2), (1, 4), (15, 4), (5, 5), *((v, 5) for v in (1, -3, 7, 0, -1, 2, 3)), (15, 4), (0, 5)])
    frames.append([((32 + 4) << 1, 8), *((v, 8) for v in (1, 2, 3, 4, 5)), (11, 4), (3, 5), *((v, 12) for v in (9, -4, 2, 1, -1)), (0, 2), (0, 4), (2, 4), *(c for v in rng.integers(-5, 6, 11).tolist() for c in codes(v, 2))])
    data = [bitstring(f) for f in frames]
    at = np.cumsum([0, *map(len, data)])[:-1]
    got = flac.decode_frames(np.concatenate(data), at, np.full(len(data), 16))
    assert got.reshape(-1, 16).tolist() == [plain_subframe(d, 16) for d in data]


def test_damage_is_noticed():
    stream = flac.encode([flac.payload(b"abcdefgh" * 700)])[0]
    for at in (3, 30, len(stream) - 1, len(stream) - 40, len(stream) // 2):
        broken = bytearray(stream)
        broken[at] ^= 4
        with pytest.raises(flac.Corrupt):
            flac.decode([bytes(broken)])


def test_frame_numbers():
    assert [flac._coded_number(n) for n in (0, 127, 128, 2047, 2048, 65536)] == [chr(n).encode() for n in (0, 127, 128, 2047, 2048, 65536)]


def test_documents(spark):
    texts = {1: None, 2: "", 3: "é" * 40, 4: "x" * 64, 5: "long text, " * 30_000, 6: "same", 7: "same"}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, media int")
    got = {r.doc_id: r for r in flac.describe(flac.to_flac(df)).collect()}
    for i, t in texts.items():
        p = flac.payload((t or "").encode())
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert len(p) % 64 == 0 and p
    assert got[6][2:] == got[7][2:] and got[1][2:] == got[2][2:] and got[5].media_bytes < got[5].payload_bytes
    blocks = flac.pcm_blocks(flac.to_flac(df)).orderBy("doc_id", "block").collect()
    assert b"".join(bytes(b.pcm) for b in blocks if b.doc_id == 5) == flac.payload(texts[5].encode())
    assert all(b.sample_offset == b.block * flac.BLOCK for b in blocks)
    assert flac.describe(flac.to_flac(df.limit(0))).count() == 0
