"""N-gram Jaccard join with signature trees.

Candidates. Two sets whose Jaccard similarity reaches the threshold differ in at
most H tokens, H given by their sizes. Hashing tokens into H + 1 parts (and some
more, to spare for parts of hardly any token) therefore leaves them a part in which they agree
token for token; equal sums of parts that are not small bring sets together. A count-min sketch first
says which sums are found twice at all. Sizes fall into classes such that partners
are in the same or the next class, and every set takes part at two levels. Common
tokens, found by one pass of counters, are left out of the sums where enough others
are there: that can only make sets differ less, and texts that share a passage but
little else do not meet.
Candidate groups are joined to components, and only sets in one travel, once.

Join. The sets of a component build a signature tree: leaves of sets near each
other, nodes that hold the OR of their token bitmaps and their range of sizes. A
dual traversal of the tree prunes pairs of nodes whose largest possible overlap,
by bitmaps and sizes, is below what the smallest sizes need, and pairs that are
in one class already, since classes are what is asked for. What is left is
verified exactly. A component with more sets, or more tokens, than a block holds is cut into
blocks that are joined each with itself and with a few sets that all of them have; then only such
pairs of blocks meet as their summaries do not prune.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import Words, in_filter, key_filter, mix, release, runs, ship, slices, stored, texts, windows
from terrafold.llm.components import components, stars
from terrafold.llm.sketch import estimated_repeated, sketch

#: Bits of a node's bitmap; sets of a leaf; sets of a block.
BITS, LEAF, BLOCK = 4096, 16, 8192
#: Tokens of a block, times its sets, at most; sets that go to all blocks of a component, about.
TOKENS, PIVOTS = 256, 16
#: Classes of so many sets are pieces of their own where blocks meet; smaller ones of a block are one piece.
LARGE = 256
#: Parts with so few tokens are not asked to agree, unless a set has more of them than spare parts: they say little.
SMALL = 1
#: Counters that tell common tokens, as a power of two, and how far above twice the mean a common token's counter is.
HOT_BITS, HOT_MARGIN = 21, 64
RESULT = "doc_id long, n_shingles long, component_id long"


class Shape:
    """The threshold, as percent of the union, and what follows from it for sizes."""

    def __init__(self, k: int, percent: int) -> None:
        self.k, self.percent = k, percent
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1))
        self.edges = np.array(edges)
        self.differ = 2 * (self.edges[1:] - 1) * (100 - percent) // (100 + percent)
        self.parts = self.differ + 3 + self.differ // 5

    def classes(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, "right") - 1

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least overlap at which sets of these sizes link; at smallest sizes the least for larger ones too."""
        return np.maximum(-(-self.percent * (a + b) // (100 + self.percent)), -(-self.percent * np.maximum(a, b) // 100))

    def sets(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of each text, ascending, and how many before each text."""
        found = Words(data, offsets, lower=True)
        h, n, k = found.hashes(), np.diff(found.first), self.k
        own = runs(found.first[:-1], np.maximum(n - k + 1, 0))
        grams = windows(h, k)[own] if len(own) else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(n)), np.maximum(n - k + 1, 0))
        for short in range(1, k):  # the whole sequence of a text with fewer words
            at = np.flatnonzero(n == short)
            if len(at):
                whole = mix(windows(h, short)[found.first[at]] + np.uint64(short))
                grams, doc = np.concatenate([grams, whole]), np.concatenate([doc, at])
                grams, doc = grams[(order := np.argsort(doc, kind="stable"))], doc[order]
        cuts = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
        for a, b in pairwise(cuts):
            grams[a:b].sort()
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        return grams[new], np.searchsorted(doc[new], np.arange(len(n) + 1))

    def signatures(self, grams: np.ndarray, first: np.ndarray, hot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Part sums of all sets at both their levels, and the set each belongs to. hot: a bitmap of common tokens."""
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        values = mix(grams + np.uint64(0x632BE59BD9B4E019))
        cold = np.ones(len(grams), bool) if hot is None else ~_bit(hot, grams)
        out, whose = [], []
        for up in (0, 1):
            level = self.classes(np.maximum(n, 1)) + up
            parts = np.where(n > 0, self.parts[level], 0)
            base = np.cumsum(parts) - parts
            size = int(parts.sum())
            at = base[owner] + ((grams >> np.uint64(32)) * parts[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            doc = np.repeat(np.arange(len(n)), parts)
            tag = mix((level[doc].astype(np.uint64) << np.uint64(40)) + (np.arange(size) - base[doc]).astype(np.uint64))

            def sums(own: np.ndarray, at: np.ndarray = at, size: int = size) -> tuple[np.ndarray, np.ndarray]:
                total = np.zeros(size, np.uint64)
                np.add.at(total, at[own], values[own])
                return total, np.bincount(at[own], minlength=size)

            total, filled = sums(cold)
            keep = filled > SMALL
            out.append(mix(total + tag)[keep])
            whose.append(doc[keep])
            # a set's partners differ from it in fewer tokens than the level's largest ones, so it has more parts to spare
            most = np.minimum(n * 100 // self.percent, self.edges[level + 1] - 1)
            spare = parts - 1 - (n + most) * (100 - self.percent) // (100 + self.percent)
            # sets with more small parts than that take part with all their tokens too
            more = (np.bincount(doc[~keep], minlength=len(n)) > spare)[doc]
            total, filled = sums(np.ones(len(grams), bool))
            empty = np.bincount(doc[filled == 0], minlength=len(n)) > spare
            keep = more & ((filled > 0) | empty[doc])
            out.append(mix(total + tag + np.uint64(1))[keep])
            whose.append(doc[keep])
        return np.concatenate(out), np.concatenate(whose)


def _bit(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    at = (grams >> np.uint64(64 - HOT_BITS)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def common_tokens(rows: DataFrame, distinct: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """A bitmap of 2**HOT_BITS counters, summed over all tokens, that are well above their mean: of fixed size.

    Tokens counted there are left out where sets are brought together; which ones are has no effect on the result.
    """
    block = 14

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << HOT_BITS, np.int64)
        for _, data, offsets in slices(batches):
            counts += np.bincount((distinct(data, offsets) >> np.uint64(64 - HOT_BITS)).astype(np.int64), minlength=len(counts))
        cells = np.minimum(counts, 65535).astype(np.uint16).reshape(-1, 1 << block)
        full = np.flatnonzero(cells.any(axis=1)).tolist()
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array([cells[i].tobytes() for i in full], pa.binary())], ["block", "counts"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(raw, np.uint16).astype(np.int64)
        for k, x in total.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([x.astype(np.float32).tobytes()], pa.binary())], ["block", "counts"])

    parts = rows.select("text").mapInArrow(own, "block int, counts binary").repartition("block").mapInArrow(merged, "block int, counts binary")
    out = np.zeros((1 << (HOT_BITS - block), 1 << block), np.float32)
    for r in parts.collect():  # 2**HOT_BITS counters in all
        out[r.block] = np.frombuffer(r["counts"], np.float32)
    return np.packbits(out.ravel() > 2 * out.mean() + HOT_MARGIN)


def set_ids(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 63-bit identity of each set, which does not depend on order; equal sets have equal ones."""
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams + np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    own = total[first[1:]] - total[first[:-1]]
    return (mix(own + np.diff(first).astype(np.uint64)) >> np.uint64(1)).astype(np.int64)


class Union:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


class Node:
    """Sets start..end of a tree: the OR of their bitmaps, their range of sizes, and their largest bitmap shortfall."""

    __slots__ = ("children", "end", "excess", "high", "low", "one", "start", "word")

    def __init__(self, start: int, end: int, word: np.ndarray, low: int, high: int, excess: int, children: list[Node]) -> None:
        self.start, self.end, self.word, self.low, self.high, self.excess, self.children = start, end, word, low, high, excess, children
        self.one = end - start == 1


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), BITS), bool)
    for row, s in zip(out, sets, strict=True):
        row[(s >> np.uint64(64 - BITS.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(out, axis=1).view(np.uint64)


class Tree:
    """A signature tree over sets, which are put in order of their smallest tokens so that near ones are neighbours."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.order = sorted(range(len(sets)), key=lambda i: (sets[i][:4].tolist(), len(sets[i])))
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        self.bits = bitmaps(self.sets)
        self.excess = self.size - np.bitwise_count(self.bits).sum(axis=1)
        level = [self._node(a, min(a + LEAF, len(sets)), []) for a in range(0, len(sets), LEAF)]
        while len(level) > 1:
            level = [self._node(g[0].start, g[-1].end, g) for g in (level[i : i + 8] for i in range(0, len(level), 8))]
        self.root = level[0] if level else None

    def _node(self, start: int, end: int, children: list[Node]) -> Node:
        word = np.bitwise_or.reduce([c.word for c in children] if children else self.bits[start:end], axis=0)
        sizes = self.size[start:end]
        return Node(start, end, word, int(sizes.min()), int(sizes.max()), int(self.excess[start:end].max()), children)


def overlap_bound(a: Node, b: Node) -> int:
    """No set of a shares more tokens with one of b: common bits, plus tokens beyond one for each bit."""
    return min(a.high, b.high, int(np.bitwise_count(a.word & b.word).sum()) + min(a.excess, b.excess))


def dual(left: Tree, right: Tree, shape: Shape, union: Union, offset: int) -> list[tuple[int, int]]:
    """Links (positions in left, positions in right) that join classes. union numbers right's sets from offset.

    left may be right itself, with offset 0.
    """
    found: list[tuple[int, int]] = []

    def one_class(node: Node, base: int, tree: Tree) -> int | None:
        first = union.find(base + tree.order[node.start])
        return first if all(union.find(base + tree.order[i]) == first for i in range(node.start + 1, node.end)) else None

    def leaves(a: Node, b: Node) -> None:
        common = np.bitwise_count(left.bits[a.start : a.end, None, :] & right.bits[None, b.start : b.end, :]).sum(axis=2)
        na, nb = left.size[a.start : a.end, None], right.size[None, b.start : b.end]
        most = np.minimum(common + np.minimum(left.excess[a.start : a.end, None], right.excess[None, b.start : b.end]), np.minimum(na, nb))
        for i, j in np.argwhere(most >= shape.needed(na, nb)).tolist():
            i, j = a.start + i, b.start + j
            x, y = left.order[i], right.order[j]
            if (left is right and i >= j) or union.find(x) == union.find(offset + y):
                continue
            s, t = left.sets[i], right.sets[j]
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= shape.percent * (len(s) + len(t) - both):
                union.join(x, offset + y)
                found.append((x, y))

    stack = [(left.root, right.root)] if left.root and right.root else []
    while stack:
        a, b = stack.pop()
        if overlap_bound(a, b) < int(shape.needed(np.int64(a.low), np.int64(b.low))) or 100 * min(a.high, b.high) < shape.percent * max(a.low, b.low):
            continue
        own = one_class(a, 0, left)
        if own is not None and own == one_class(b, offset, right):
            continue
        if not a.children and not b.children:
            leaves(a, b)
        elif left is right and a is b:
            # pairs of a child with itself are taken first: what they join prunes the rest
            stack += [(c, d) for i, c in enumerate(a.children) for d in a.children[i + 1 :]]
            stack += [(c, c) for c in a.children]
        elif a.children and (not b.children or a.end - a.start >= b.end - b.start):
            stack += [(c, b) for c in a.children]
        else:
            stack += [(a, c) for c in b.children]
    return found


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[int], list[np.ndarray]]]:
    """Groups of consecutive rows by their columns before sid: the key, sids, and sets."""
    key, sids, sets = None, [], []
    for batch in batches:
        names = [n for n in batch.schema.names if n not in ("sid", "grams")]
        for sid, raw, *own in zip(*(batch.column(n).to_pylist() for n in ("sid", "grams", *names)), strict=True):
            if tuple(own) != key:
                if key is not None:
                    yield key, sids, sets
                key, sids, sets = tuple(own), [], []
            sids.append(sid)
            sets.append(np.frombuffer(raw, np.uint64))
    if key is not None:
        yield key, sids, sets


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])


def shingle_classes(docs: DataFrame, k: int = 5, percent: int = 80, width: int = 27, block: int = BLOCK) -> DataFrame:
    """RESULT: each row's number of distinct k-word shingles and the smallest doc_id its links reach, itself included.

    Words are lower-cased A-Z. A text with fewer words than k has its whole sequence as one shingle; null and empty
    texts have none and link with nothing. Equal sets are one vertex, however many rows share them. Rows that share a
    doc_id are vertices of their own, with that doc_id. Rows with a null doc_id keep it; they link others, and name
    no component; one that reaches no other doc_id has a null component. Other columns are ignored.
    """
    shape = Shape(k, percent)
    rows = texts(docs)

    def vertices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches):
            grams, first = shape.sets(data, offsets)
            yield pa.record_batch([batch.column("doc_id"), pa.array(set_ids(grams, first)), pa.array(np.diff(first))], ["doc_id", "sid", "n"])

    def distinct(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The tokens of the different sets of a slice."""
        grams, first = shape.sets(data, offsets)
        return grams[np.repeat(once(grams, first), np.diff(first))]

    def own_signatures(_: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each set's signatures once for each slice of texts, so that copies count only where slices meet."""
        grams, first = shape.sets(data, offsets)
        signatures, whose = shape.signatures(grams, first, hot.value)
        return signatures[once(grams, first)[whose]]

    def once(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first) - 1, bool)
        out[np.unique(set_ids(grams, first), return_index=True)[1]] = True
        return out

    hot = ship(docs.sparkSession, common_tokens(rows, distinct))
    seen = ship(docs.sparkSession, sketch(rows.select("text"), own_signatures, width))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches):
            grams, first = shape.sets(data, offsets)
            signatures, whose = shape.signatures(grams, first, hot.value)
            at = np.flatnonzero(once(grams, first)[whose])
            at = at[estimated_repeated(seen.value, signatures[at], width)]
            sids = set_ids(grams, first)[whose[at]]
            order = np.lexsort((sids, signatures[at]))
            yield pa.record_batch([pa.array(signatures[at][order].view(np.int64)), pa.array(sids[order]), pa.array(np.diff(first)[whose[at]][order])], ["signature", "sid", "n"])

    groups = stored(rows.select("text").mapInArrow(candidates, "signature long, sid long, n long"))
    hot.destroy()
    seen.destroy()
    # written, so that the join after it may split a signature that very many sets share
    least = stored(groups.groupBy("signature").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).filter("low < high").select("signature", "low"))
    pairs = stored(groups.join(least, "signature").select(F.col("low").alias("a"), F.col("sid").alias("b"), "n"))
    near = stored(components(pairs.select("a", "b")).join(pairs.groupBy(F.col("b").alias("node")).agg(F.max("n").alias("n")), "node"))
    release(groups, least, pairs)
    wanted = ship(docs.sparkSession, key_filter(near.select("node")))

    def travelling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, offsets in slices(batches):
            grams, first = shape.sets(data, offsets)
            sids = set_ids(grams, first)
            go = np.flatnonzero(once(grams, first) & in_filter(wanted.value, sids) & (np.diff(first) > 0))
            raw = grams.tobytes()
            cells = [raw[8 * a : 8 * b] for a, b in zip(first[go].tolist(), first[go + 1].tolist(), strict=True)]
            yield pa.record_batch([pa.array(sids[go]), pa.array(cells, pa.binary())], ["sid", "grams"])

    sizes = near.groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("tokens"))
    sizes = sizes.withColumn("blocks", F.ceil(F.greatest(F.col("members") / block, F.col("tokens") / (block * TOKENS))).cast("int"))
    members = near.join(sizes, "component").select(F.col("node").alias("sid"), "component", "blocks", F.xxhash64("node").alias("dealt"), F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("members") / PIVOTS)).alias("pivot"))
    # some sets of a component in blocks go to all of them: what links to those is one class everywhere
    own = F.array(F.pmod("dealt", "blocks").cast("int"))
    at = F.explode(F.when((F.col("blocks") > 1) & (F.col("pivot") == 0), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(own))
    placed = members.select("sid", "component", at.alias("block"), (F.col("blocks") > 1).alias("cut"))
    sent = rows.select("text").mapInArrow(travelling, "sid long, grams binary")
    sets = stored(sent.groupBy("sid").agg(F.first("grams").alias("grams")).join(placed, "sid"))
    wanted.destroy()

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stars: the smallest set of each class, and each other one; sets come in ascending order."""
        for (*_, cut), sids, own in _members(batches):
            if len(sids) > 1:
                tree, union = Tree(own), Union(len(sids))
                dual(tree, tree, shape, union, 0)
                found = [(sids[union.find(i)], s) for i, s in enumerate(sids) if union.find(i) != i]
                yield pa.record_batch([*_edges(found).columns, pa.array([cut] * len(found), pa.bool_())], ["a", "b", "cut"])

    order = ["component", "block"]
    blocks = sets.select(*order, "cut", "sid", "grams").repartition(*order).sortWithinPartitions(*order, "sid")
    links = stored(blocks.mapInArrow(within, "a long, b long, cut boolean"))
    classes = stars(links.filter("not cut"))
    if sets.filter("cut").limit(1).count():
        parts = links.filter("cut").select("a", "b")
        classes = classes.unionByName(components(parts.unionByName(_across(sets.filter("cut"), stored(components(parts)), shape))))
    found = rows.mapInArrow(vertices, "doc_id long, sid long, n long").join(classes.withColumnRenamed("node", "sid"), "sid", "left")
    named = stored(found.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "sid")).alias("class")))
    # of classes of several rows; written, so that the join after it may split a class of very many
    smallest = stored(named.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1").drop("rows"))
    return named.join(smallest, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _across(sets: DataFrame, classes: DataFrame, shape: Shape) -> DataFrame:
    """Links between the blocks of a component that are not in one class yet.

    Large classes are pieces of their own in each block, all else of a block is one piece. Summaries (bitmap, sizes)
    of the pieces meet, and only pairs that they do not prune, and that are not of one class, are joined.
    """
    piece = ["component", "block", "class"]
    large = classes.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") > LARGE).select("component")
    named = classes.join(large, "component").select(F.col("node").alias("sid"), F.col("component").alias("class"))
    marked = sets.drop("cut").join(named, "sid", "left")
    marked = stored(marked.select("component", "block", F.coalesce("class", F.lit(-1).cast("long")).alias("class"), "sid", "grams"))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, own in _members(batches):
            root = Tree(own).root
            cells = [*key, root.word.tobytes(), root.low, root.high, root.excess]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 3)
            yield pa.record_batch([pa.array([c], t) for c, t in zip(cells, kinds, strict=True)], [*piece, "word", "low", "high", "excess"])

    schema = "component long, block int, class long, word binary, low long, high long, excess long"
    short = marked.repartition(*piece).sortWithinPartitions(*piece).select(*piece, "sid", "grams").mapInArrow(summaries, schema)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a component's pieces that may hold links."""
        component, nodes = None, []

        def meet() -> list[tuple]:
            out = []
            for i, (b, c, x) in enumerate(nodes):
                for d, e, y in nodes[i + 1 :]:
                    if (c != e or c < 0) and 100 * min(x.high, y.high) >= shape.percent * max(x.low, y.low) and overlap_bound(x, y) >= int(shape.needed(np.int64(x.low), np.int64(y.low))):
                        out.append((component, b, c, d, e))
            return out

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            return pa.record_batch([pa.array([r[j] for r in out], t) for j, t in enumerate(kinds)], ["component", "block", "class", "other_block", "other_class"])

        for batch in batches:
            for c, b, k, word, low, high, excess in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if c != component:
                    if nodes:
                        yield batch_of(meet())
                    component, nodes = c, []
                nodes.append((b, k, Node(0, 2, np.frombuffer(word, np.uint64), low, high, excess, [])))
        if nodes:
            yield batch_of(meet())

    meetings = stored(short.repartition("component").sortWithinPartitions(*piece).mapInArrow(pairs, "component long, block int, class long, other_block int, other_class long"))
    meetings = meetings.withColumn("pair", F.xxhash64("component", "block", "class", "other_block", "other_class"))
    left = meetings.join(marked, piece).select("pair", F.lit(0).alias("side"), "sid", "grams")
    right = meetings.join(marked.select("component", F.col("block").alias("other_block"), F.col("class").alias("other_class"), "sid", "grams"), ["component", "other_block", "other_class"]).select("pair", F.lit(1).alias("side"), "sid", "grams")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for (pair, side), sids, own in _members(batches):
            if side == 0:
                waiting = (pair, sids, Tree(own))
            elif waiting and waiting[0] == pair:
                union = Union(len(waiting[1]) + len(sids))
                yield _edges([(waiting[1][x], sids[y]) for x, y in dual(waiting[2], Tree(own), shape, union, len(waiting[1]))])

    both = left.unionByName(right).repartition("pair").sortWithinPartitions("pair", "side", "sid")
    return both.select("pair", "side", "sid", "grams").mapInArrow(across, "a long, b long")


