"""SimHash near duplicates by deletion-variant signatures.

A fingerprint's bit is the majority of that bit over the XXH64 of all k-word
shingles of a text. Shingles of a slice of texts are hashed together: their
lanes are read at unaligned offsets of one buffer of lower-cased words.

Links. Fingerprints that differ in at most 3 bits are cut into two halves, one
of which differs in at most one bit. So each half is indexed with each of its
bits deleted in turn: 64 signatures of 31 bits, and linked fingerprints have one
in common. Signatures are joined by equality, those of one signature are
compared bit by bit, and what links is kept as a forest, never as all pairs.

A signature that more than `most` different fingerprints share is not compared
in one task: those take the same step again on their other half, cut in two.
What then shares a signature has 46 bits in common, so it is at most 2**18
fingerprints, whatever the corpus: a bitmap finds the neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import _LOWER, Words, release, runs, slices, stored, texts
from terrafold.llm.components import components

NEAR, HALF, QUARTER = 3, 32, 16
SEED = 42
#: Fingerprints of one signature that are compared in one task; more take the second step.
MOST = 4096
#: Signatures that a task compares at once; links that it holds before it keeps their forest alone; shingles whose bits it counts at once.
STRETCH, PAIRS, CHUNK = 200_000, 1_000_000, 1 << 16
#: Longer shingles are hashed one by one.
LONG = 256
# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _round(acc: np.ndarray | np.uint64, lane: np.ndarray) -> np.ndarray:
    return _rotated(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of the pieces of data, which must have 8 bytes more than any piece needs."""
    lanes = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    halves = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    # of a vector even for one seed, so that sums wrap without a warning
    own = np.full(1, seed, np.uint64)
    out = np.repeat(own + P5, len(starts))
    at, left = starts.astype(np.int64), lengths.astype(np.int64)
    wide = np.flatnonzero(left >= 32)
    if len(wide):
        v = [np.repeat(x, len(wide)) for x in (own + P1 + P2, own + P2, own, own - P1)]
        go = np.arange(len(wide))
        while len(go):
            for i in range(4):
                v[i][go] = _round(v[i][go], lanes[at[wide[go]] + 8 * i])
            at[wide[go]] += 32
            left[wide[go]] -= 32
            go = go[left[wide[go]] >= 32]
        h = _rotated(v[0], 1) + _rotated(v[1], 7) + _rotated(v[2], 12) + _rotated(v[3], 18)
        for x in v:
            h = (h ^ _round(np.uint64(0), x)) * P1 + P4
        out[wide] = h
    out += lengths.astype(np.uint64)
    go = np.flatnonzero(left >= 8)
    while len(go):
        out[go] = _rotated(out[go] ^ _round(np.uint64(0), lanes[at[go]]), 27) * P1 + P4
        at[go] += 8
        left[go] -= 8
        go = go[left[go] >= 8]
    go = np.flatnonzero(left >= 4)
    out[go] = _rotated(out[go] ^ halves[at[go]].astype(np.uint64) * P1, 23) * P2 + P3
    at[go] += 4
    left[go] -= 4
    go = np.flatnonzero(left)
    while len(go):
        out[go] = _rotated(out[go] ^ data[at[go]].astype(np.uint64) * P5, 11) * P1
        at[go] += 1
        left[go] -= 1
        go = go[left[go] > 0]
    out ^= out >> np.uint64(33)
    out *= P2
    out ^= out >> np.uint64(29)
    out *= P3
    out ^= out >> np.uint64(32)
    return out


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each text's shingles, repeats included, and how many each text has."""
    found = Words(data, offsets, lower=True)
    n = np.diff(found.first)
    length = found.ends - found.starts
    put = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()) + 8, 32, np.uint8)
    joined[runs(put, length)] = _LOWER[data[runs(found.starts, length)]]
    has = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    first = runs(found.first[:-1], has)
    last = first + np.repeat(np.minimum(n, k) - 1, has)
    starts, sizes = put[first], put[last] + length[last] - put[first]
    short = sizes < LONG
    out = np.empty(len(first), np.uint64)
    out[short] = xxh64(joined, starts[short], sizes[short])
    for i in np.flatnonzero(~short).tolist():
        out[i] = xxhash.xxh64_intdigest(joined[starts[i] : starts[i] + sizes[i]].tobytes(), SEED)
    return out, has


def majority(hashes: np.ndarray, has: np.ndarray) -> np.ndarray:
    """A fingerprint of each run of hashes: the bits that over half of them have; without any, zero."""
    counts = np.zeros((len(has), 64), np.int64)
    owner = np.repeat(np.arange(len(has)), has)
    for a in range(0, len(hashes), CHUNK):
        own = owner[a : a + CHUNK]
        bits = np.unpackbits(hashes[a : a + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        counts[own[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > has[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fingerprint long) of each row; a text with fewer words than k has one shingle, without words it is zero."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            found = majority(*_shingle_hashes(data, offsets, k))
            yield pa.record_batch([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(own, "doc_id long, fingerprint long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (least of its class, each other one) that join what the links a, b join."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[x] != label[y]
        x, y = x[open_], y[open_]
    at = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[at]], nodes[at]


def _near(keys: np.ndarray, prints: np.ndarray, near: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Forests of the links among fingerprints with equal keys, which are neighbours."""
    held, n = [], 0
    go = np.arange(len(keys) - 1)
    for lag in range(1, len(keys)):
        go = go[go + lag < len(keys)]
        go = go[keys[go] == keys[go + lag]]
        if not len(go):
            break
        hit = go[np.bitwise_count((prints[go] ^ prints[go + lag]).view(np.uint64)) <= near]
        if len(hit):
            held.append((prints[hit], prints[hit + lag]))
            n += len(hit)
        if n >= PAIRS:
            held = [forest(*(np.concatenate(x) for x in zip(*held, strict=True)))]
            yield held.pop()
            n = 0
    if held:
        yield forest(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _rows(a: np.ndarray, b: np.ndarray | None, key: np.ndarray | None) -> pa.RecordBatch:
    empty = pa.nulls(len(a), pa.int64())
    return pa.record_batch([pa.array(a), empty if b is None else pa.array(b), empty if key is None else pa.array(key)], ["a", "b", "key"])


def _compared(near: int, most: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (a, b) of rows sorted by key; the fingerprints of a key with more than most as (a, key)."""
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        crowded = None  # the key at the end, if its rows go on to the second step

        def close(end: int) -> Iterator[pa.RecordBatch]:
            nonlocal crowded
            k, p = keys[:end], prints[:end]
            first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(k)))
            full = size > most
            if len(k) and crowded == k[0]:
                full[0] = True
            deep = np.repeat(full, size)
            if deep.any():
                yield _rows(p[deep], None, k[deep])
            crowded = int(k[-1]) if len(k) and full[-1] else None
            for a, b in _near(k[~deep], p[~deep], near):
                yield _rows(a, b, None)

        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            prints = np.concatenate([prints, batch.column("fingerprint").to_numpy()])
            if len(keys) >= STRETCH:
                # the last key may go on; one that is crowded already need not wait
                end = int(np.searchsorted(keys, keys[-1]))
                end = len(keys) if len(keys) - end > most or crowded == keys[-1] else end
                yield from close(end)
                keys, prints = keys[end:], prints[end:]
        yield from close(len(keys))

    return task


def _dense(near: int, most: int):
    masks = np.array([sum(1 << b for b in bits) for n in range(1, near + 1) for bits in combinations(range(QUARTER + 2), n)])

    def links(sub: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of fingerprints that agree but in the deleted bits and in one quarter: those 18 bits number them."""
        half, bit, quarter, spare = sub >> 10 & 1, sub >> 5 & 31, sub >> 4 & 1, sub & 15
        other = (prints >> (HALF * (1 - half))) & 0xFFFFFFFF
        place = (other >> (QUARTER * (1 - quarter))) & 0xFFFF
        place |= ((other >> (QUARTER * quarter + spare)) & 1) << QUARTER | ((prints >> (HALF * half + bit)) & 1) << (QUARTER + 1)
        who = np.full(1 << (QUARTER + 2), -1)
        who[place] = np.arange(len(prints))
        label = np.arange(len(prints))
        while True:
            before = label.copy()
            for mask in masks:
                partner = who[place ^ mask]
                np.minimum(label, np.where(partner >= 0, label[partner], label), out=label)
            label = label[label]
            if (label == before).all():
                break
        at = np.flatnonzero(label != np.arange(len(prints)))
        return prints[label[at]], prints[at]

    def close(key: np.ndarray, sub: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.append(True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(key)))
        few = np.repeat(size <= most, size)
        found = list(_near(np.cumsum(new)[few], prints[few], near))
        for i in np.flatnonzero(size > most).tolist():
            found.append(links(int(sub[first[i]]), prints[first[i] : first[i] + size[i]]))
        for a, b in found:
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of rows sorted by (key, sub): groups of at most 2**18 different fingerprints."""
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, ("key", "sub", "fingerprint"), strict=True)]
            key, sub, _ = held
            if len(key) >= STRETCH:
                end = int(np.flatnonzero((key != key[-1]) | (sub != sub[-1]))[-1:].sum() + 1) if key[0] != key[-1] or sub[0] != sub[-1] else 0
                if end:
                    yield from close(*(x[:end] for x in held))
                    held = [x[end:] for x in held]
        if len(held[0]):
            yield from close(*held)

    return task


#: The signatures of a fingerprint: which half (5 bits up), which of its bits is deleted, and the half without it.
_SIGNATURE = "(shiftrightunsigned(fingerprint, 32 * shiftright(i, 5)) & 4294967295L & ~shiftleft(1L, i & 31)) << 6 | i"
#: In the second step: the first signature's half and bit, then a quarter of the other half and its deleted bit, and above them that quarter.
_OTHER = "(shiftrightunsigned(fingerprint, 32 * (1 - shiftright(cast(key & 63 as int), 5))) & 4294967295L)"
_SUB = f"(shiftrightunsigned({_OTHER}, 16 * shiftright(i, 4)) & 65535L & ~shiftleft(1L, i & 15)) << 11 | shiftleft(key & 63L, 5) | i"


def near_links(prints: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """(a, b): links that join all fingerprints (a long column of different ones) at near or fewer differing bits.

    Not all pairs, but enough of them for the same components.
    """
    if not 0 <= near <= NEAR:
        raise ValueError(f"near must be 0 to {NEAR}: two halves leave one with a single differing bit")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")
    variants = prints.select("fingerprint", every(64)).select("fingerprint", F.expr(_SIGNATURE).alias("key"))
    found = stored(variants.repartition("key").sortWithinPartitions("key").select("key", "fingerprint").mapInArrow(_compared(near, most), "a long, b long, key long"))
    links = found.filter("key is null").select("a", "b")
    crowded = found.filter("key is not null").select(F.col("a").alias("fingerprint"), "key")
    subs = crowded.select("fingerprint", "key", every(32)).select("fingerprint", "key", F.expr(_SUB).alias("sub"))
    more = subs.repartition("key", "sub").sortWithinPartitions("key", "sub").select("key", "sub", "fingerprint").mapInArrow(_dense(near, MOST), "a long, b long")
    return links.unionByName(more)


def near_duplicates(docs: DataFrame, k: int = 3, near: int = NEAR, most: int = MOST) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: 16 hex digits, and the smallest doc_id its links reach, itself included.

    Words are lower-cased A-Z. Null, empty and wordless texts have fingerprint zero and link as any other. Rows with
    equal fingerprints are one vertex, however many there are, and travel once. Repeated rows, and rows that share a
    doc_id, stay as many as they are. Rows with a null doc_id keep it; they link others but name no component: one
    that reaches no other doc_id has a null component. Texts of any length are taken whole; a task needs some 100
    bytes for each byte of its longest text. Other columns are ignored. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, k))
    prints = rows.select("fingerprint").distinct()
    links = stored(near_links(prints, near, most))
    classes = stored(components(links))
    named = rows.join(classes, F.col("fingerprint") == F.col("node"), "left").select("doc_id", "fingerprint", F.coalesce("component", "fingerprint").alias("class"))
    # of classes of several rows; written, so that the join after it may split a class of very many
    smallest = stored(named.groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"))
    release(links)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return named.join(smallest, "class", "left").select("doc_id", digits, F.coalesce("component_id", "doc_id").alias("component_id"))
