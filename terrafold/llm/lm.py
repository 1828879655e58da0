"""Scoring by a gated recurrent language model in numpy, beside a smoothed unigram model.

Counts. All training tokens are counted, by hash, in partitions of their own, in a
first pass over the texts; a second one stores the numbers of their words. The
FREQUENT most frequent words go to the tasks; the first WORDS of them are the
model's words, any other word is its unknown word, whose probability is shared
out among all other words by their smoothed counts. So every text has a proper
probability. Counts of words that are not frequent meet their occurrences where
the word's hash falls to, and only sums come back to the documents.

Model. Embedding, one gated recurrent layer, and an output softmax in two
factors: the class of the next word, then the word within its class (classes are
ranges of words of about equal summed square-root frequency). It starts as the
unigram model and is trained by truncated backpropagation on all training documents,
each token once: replicas, as many as these need, each go through their own part
from common parameters, which are then averaged, block by block.

Scoring. Texts of many batches go side by side, in lanes of one text after another;
windows of steps carry their states on to the next window, so a document's score
covers it from first word to end.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import Words, runs, slices, stored, texts

FREQUENT, WORDS, CLASSES, WIDTH = 50_000, 6000, 64, 32
#: Parts that words are counted in, whatever the number of shuffle partitions; each offers four times its share of the frequent ones.
BUCKETS = 256
#: A replica takes so many tokens, one of ROUNDS parts of them in each round.
ROUNDS, REPLICA_TOKENS = 2, 2_000_000
WINDOW, LANES, RATE = 24, 128, 0.3
#: A task scores so many tokens side by side: lanes are as many as go without one being longer than the longest text.
SCORE_WINDOW, SCORE_LANES, SCORE_TOKENS = 64, 512, 4_000_000
#: A word that a window has so often is summed alone.
OFTEN = 12
UNKNOWN, END = 0, 1
SLOT_BITS = 18
END_HASH = np.uint64(0x9D39247E33776D41)
NUMBERED = "part int, place int, doc_id long, train boolean, n long, known long, base double, unknown long, score double, ids binary, bucket int, a binary, b binary, c binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def fold_of(doc_id: int | None) -> int:
    return zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0


def _folds(column: pa.Array) -> np.ndarray:
    return np.array([fold_of(d) for d in column.to_pylist()], np.int64)


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and its end, and how many tokens come before each text."""
    found = Words(data, offsets, lower=True)
    n = np.diff(found.first)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    out, word = np.empty(int(first[-1]), np.uint64), np.ones(int(first[-1]), bool)
    word[first[1:] - 1] = False
    out[first[1:] - 1] = END_HASH
    out[word] = found.hashes()
    return out, first


class Vocabulary:
    """Frequent words by hash with their counts; the model's words are numbered by falling count."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, train_tokens: int, distinct: int) -> None:
        order = np.lexsort((hashes, -counts))
        hashes, counts = hashes[order], counts[order]
        own = np.flatnonzero(hashes != END_HASH)[: WORDS - 2]
        number = np.full(len(hashes), UNKNOWN)
        number[own] = np.arange(len(own)) + 2
        number[hashes == END_HASH] = END
        self.train_tokens, self.distinct = train_tokens, distinct
        kept = number != UNKNOWN
        self.n_words = len(own) + 2
        self.frequency = np.zeros(self.n_words)
        self.frequency[number[kept]] = counts[kept]
        self.frequency[UNKNOWN] = train_tokens - counts[kept].sum()
        by_hash = np.argsort(hashes)
        self.hashes, self.counts, self.number = hashes[by_hash], counts[by_hash], number[by_hash]
        #: where the hashes of each slot begin, by their first bits
        self.slots = np.searchsorted(self.hashes, np.arange(1 << SLOT_BITS, dtype=np.uint64) << np.uint64(64 - SLOT_BITS)).astype(np.int32)
        self.slots = np.append(self.slots, np.int32(len(self.hashes)))
        #: what words share that the model doesn't know: their counts, one more for each, and one for all new words
        self.unknown_mass = self.frequency[UNKNOWN] + (distinct - int(kept.sum())) + 1

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the tables, and which hashes are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        at = np.minimum(self.slots[slot], len(self.hashes) - 1).astype(np.int64)
        there = self.hashes[at] == hashes
        # slots of several: what is not the first may be a later one
        left = np.flatnonzero(~there)
        left = left[self.slots[slot[left] + 1] > at[left] + 1]
        while len(left):
            at[left] += 1
            same = self.hashes[at[left]] == hashes[left]
            there[left[same]] = True
            left = left[~same]
            left = left[self.slots[slot[left] + 1] > at[left] + 1]
        return at, there

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at, there = self.look_up(hashes)
        return np.where(there, self.number[at], UNKNOWN) if len(self.hashes) else np.zeros(len(hashes), np.int64)


def _by_kind(x: np.ndarray) -> np.ndarray:
    """The columns of z, r and new apart."""
    return np.ascontiguousarray(x.reshape(len(x), 3, -1).transpose(1, 0, 2))


def _sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of rows by word: those of a word are order[first], ..., as many as it counts; counts fall."""
    out = rows.take(order.take(first), axis=0)
    often = int(np.searchsorted(-count, -OFTEN, "right"))
    if often:
        block, ones = rows.take(order.take(runs(first[:often], count[:often])), axis=0), np.ones(count[0], rows.dtype)
        at = 0
        for k, n in enumerate(count[:often].tolist()):
            np.dot(ones[:n], block[at : at + n], out=out[k])
            at += n
    # the others take one row each at a time
    for k in range(1, OFTEN):
        to = int(np.searchsorted(-count, -k))
        if to <= often:
            break
        out[often:to] += rows.take(order.take(first[often:to] + k), axis=0)
    return out


def _leaves(x: np.ndarray) -> bool:
    """Whether exponentials of x, or sums of them, may leave float32."""
    return bool(x.size) and not (x.max() <= 80 and x.min() >= -80)


class Model:
    """Parameters are views of one float32 vector. Words of a class are neighbours in rank."""

    def __init__(self, frequency: np.ndarray, flat: np.ndarray | None = None) -> None:
        v, h = len(frequency), WIDTH
        rank = np.argsort(-frequency, kind="stable")
        self.rank = np.empty(v, np.int64)
        self.rank[rank] = np.arange(v)
        mass = np.cumsum(np.sqrt(frequency[rank] + 1))
        classes = np.minimum((mass / mass[-1] * CLASSES).astype(np.int64), CLASSES - 1)
        _, classes = np.unique(classes, return_inverse=True)
        self.class_of = classes
        self.starts = np.searchsorted(classes, np.arange(classes[-1] + 2))
        c = len(self.starts) - 1
        # a bias is the last weight of its class or word
        shapes = {"embedding": (v, h), "w": (h, 3 * h), "u": (h, 3 * h), "b": (3 * h,), "classes": (h + 1, c), "words": (v * (h + 1),)}
        sizes = {k: math.prod(s) for k, s in shapes.items()}
        fresh = flat is None
        self.shapes = shapes
        self.flat = np.zeros(sum(sizes.values()), np.float32) if fresh else flat
        self._views()
        if fresh:
            rng = np.random.default_rng(7)
            for name in ("embedding", "w", "u"):
                x = getattr(self, name)
                x[:] = rng.normal(0, 1 / math.sqrt(h) if name != "embedding" else 0.3, x.shape)
            seen = frequency[rank] + 1
            class_b, word_b = self.classes[h], np.log(seen)
            class_b[:] = np.log(np.add.reduceat(seen, self.starts[:-1]))
            class_b -= class_b.max()
            word_b -= np.maximum.reduceat(word_b, self.starts[:-1])[classes]
            for block, own in zip(self.of_class, np.split(word_b, self.starts[1:-1]), strict=True):
                block[h] = own

    def _views(self) -> None:
        at = 0
        for name, shape in self.shapes.items():
            size = math.prod(shape)
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size
        #: the words of each class, a column each
        rows, starts = WIDTH + 1, self.starts.tolist()
        self.of_class = [self.words[rows * a : rows * b].reshape(rows, b - a) for a, b in zip(starts, starts[1:], strict=False)]
        self.turned_class = [block[:WIDTH].T for block in self.of_class]

    def blank(self) -> Model:
        out = object.__new__(Model)
        out.__dict__.update(self.__dict__)
        out.flat = np.zeros_like(self.flat)
        out._views()
        return out

    def turned(self, x: np.ndarray) -> np.ndarray:
        """x by kind of column (z, r, new), as step takes it: with the signs of gates turned, since a gate is 1 / (1 + exp(-x))."""
        return _by_kind(x) * np.array([-1, -1, 1], x.dtype)[:, None, None]

    def step(self, x: np.ndarray, h: np.ndarray, u: np.ndarray, a: np.ndarray, out: np.ndarray) -> None:
        """One step from input projections x and states h, by turned weights, to states out; x becomes one over each gate and new states, a what u makes of h (turned; a[1] is lost)."""
        with np.errstate(over="ignore", under="ignore"):
            self._step(x, h, u, a, out)

    def _step(self, x: np.ndarray, h: np.ndarray, u: np.ndarray, a: np.ndarray, out: np.ndarray) -> None:
        np.matmul(h, u, out=a)
        gates, new = x[:2], x[2]
        gates += a[:2]
        np.exp(gates, out=gates)
        gates += 1
        np.divide(a[2], gates[1], out=a[1])
        new += a[1]
        np.tanh(new, out=new)
        np.subtract(h, new, out=out)
        out /= gates[0]
        out += new

    def losses(self, h: np.ndarray, target: np.ndarray, back: Model | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target (by rank) after its state; with back, gradients of their sum too, and those of classes and words there."""
        n, width = len(h), WIDTH
        own = self.class_of.take(target)
        # the rows of a class side by side, so its products read and write slices
        order = np.argsort(own.astype(np.uint16), kind="stable")
        own, target = own.take(order), target.take(order)
        cuts = np.searchsorted(own, np.arange(len(self.starts))).tolist()
        starts = self.starts.tolist()
        s = np.empty((n, width + 1), h.dtype)
        s[:, :width], s[:, width] = h.take(order, axis=0), 1
        rows = np.arange(n)
        e = s @ self.classes
        if _leaves(e):
            e -= e.max(axis=1, keepdims=True)
        of_own, flat = rows * e.shape[1] + own, e.reshape(-1)
        logs = flat.take(of_own).astype(np.float64)
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], h.dtype)
        logs -= np.log(total)
        dh = None
        if back is not None:
            flat[of_own] -= total
            e /= -total[:, None]
            np.matmul(s.T, e, out=back.classes)
            dh = e @ self.classes[:width].T
        # words within classes: a row of e for each target, as long as its class, one after another
        sizes = np.diff(self.starts)[own]
        ends = np.cumsum(sizes)
        begin = ends - sizes
        e = np.empty(int(sizes.sum()), h.dtype)
        parts = []
        for c, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)):
            size = starts[c + 1] - starts[c]
            if i < j and size > 1:
                x = e[begin[i] : ends[j - 1]].reshape(j - i, size)
                np.dot(s[i:j], self.of_class[c], out=x)
                parts.append((i, j, c, x))
                continue
            # no target, or the one word of a class, which is certain
            if i < j:
                e[begin[i] : ends[j - 1]] = 0
            if back is not None:
                back.of_class[c][:] = 0
        if _leaves(e):
            e -= np.repeat(np.maximum.reduceat(e, begin), sizes)
        at = begin + target - self.starts[own]
        logs += e[at]
        np.exp(e, out=e)
        total = np.add.reduceat(e, begin) if n else e
        logs -= np.log(total)
        out = np.empty(n)
        out[order] = logs
        if back is not None:
            e[at] -= total
            scaled = s / -total[:, None]
            word_dh = np.zeros_like(dh)
            for i, j, c, x in parts:
                np.dot(scaled[i:j].T, x, out=back.of_class[c])
                np.dot(x, self.turned_class[c], out=word_dh[i:j])
            word_dh /= -total[:, None]
            dh += word_dh
            back_to = np.empty_like(order)
            back_to[order] = rows
            dh = dh.take(back_to, axis=0)
        return out, dh

    def window(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, back: Model) -> tuple[float, np.ndarray]:
        """Truncated backpropagation through one window (steps by lanes) from states h; gradients of the log likelihood replace those in back, of embeddings in the rows back.touched alone."""
        t, n = len(inputs), WIDTH
        lanes, kind = len(h), h.dtype
        # inputs by word, the most frequent first: what is the same for a word is done once
        flat = inputs.ravel().astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        flat = flat.take(order)
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        count = np.diff(np.concatenate([first, [len(flat)]]))
        falling = np.argsort(-count, kind="stable")
        place = np.empty_like(falling)
        place[falling] = np.arange(len(falling))
        which = np.empty(len(flat), np.int64)
        which[order] = np.repeat(place, count)
        first, count = first.take(falling), count.take(falling)
        words = flat.take(first).astype(np.int64)
        own = self.embedding.take(words, axis=0)
        x = np.matmul(own, self.turned(self.w))
        x += self.turned(self.b[None])
        projected, u, which = x, self.turned(self.u), which.reshape(t, lanes)
        x = np.empty((t, 3, lanes, n), kind)
        states = np.empty((t + 1, lanes, n), kind)
        states[0] = h
        made = np.empty((t, 3, lanes, n), kind)
        with np.errstate(over="ignore", under="ignore"):
            for i in range(t):
                np.take(projected, which[i], axis=1, out=x[i], mode="clip")
                self._step(x[i], states[i], u, made[i], states[i + 1])
        logs, dh = self.losses(states[1:].reshape(-1, n), targets.ravel(), back)
        dh = dh.reshape(t, lanes, n)
        new = x[:, 2]
        z, r = np.divide(1, x[:, 0]), np.divide(1, x[:, 1])
        # what a state's gradient is multiplied by on its way to z, r and the new state, there without the reset gate
        one, to_new = kind.type(1), new * new
        np.subtract(one, to_new, out=to_new)
        not_z = one - z
        to_new *= not_z
        to_z = states[:-1] - new
        to_z *= z
        to_z *= not_z
        through = to_new * r
        to_r = np.subtract(one, r, out=not_z)
        to_r *= through
        to_r *= made[:, 2]
        carry, gone, ut = np.zeros((lanes, n), kind), np.empty((lanes, n), kind), np.ascontiguousarray(self.u.T)
        da = np.empty((t, lanes, 3, n), kind)
        for i in range(t - 1, -1, -1):
            d, own_da = dh[i], da[i]
            d += carry
            np.multiply(to_z[i], d, out=own_da[:, 0])
            np.multiply(to_r[i], d, out=own_da[:, 1])
            np.multiply(through[i], d, out=own_da[:, 2])
            np.matmul(own_da.reshape(lanes, 3 * n), ut, out=gone)
            np.multiply(d, z[i], out=carry)
            carry += gone
        np.matmul(states[:-1].reshape(-1, n).T, da.reshape(-1, 3 * n), out=back.u)
        np.multiply(dh, to_new, out=da[:, :, 2])
        # a word's rows are summed before they go through the weights
        da = _sums(da.reshape(-1, 3 * n), order, first, count)
        np.matmul(np.ones(len(da), kind), da, out=back.b)
        np.matmul(own.T, da, out=back.w)
        back.embedding[words] = da @ self.w.T
        back.touched = words
        return float(logs.sum()), states[t].copy()

    def train(self, tokens: np.ndarray) -> None:
        """Adagrad over a stream of token ranks, each predicted, the first from the last; read in up to LANES lanes side by side, fewer where each would have less than 96 windows."""
        if not len(tokens):
            return
        n = max(1, min(LANES, len(tokens) // (96 * WINDOW)))
        steps = -(-len(tokens) // n)
        # a lane starts with the token before its own; lanes past the stream's end begin anew
        lanes = np.take(tokens, np.arange(n) * steps + np.arange(-1, steps)[:, None], mode="wrap")
        # squares of gradients are of sums over the lanes, and so is what they start from
        back, seen = self.blank(), self.blank()
        seen.flat[:] = 1e-3 * n * n
        rest = slice(self.embedding.size, None)
        # in blocks that stay in a processor's cache
        spare = np.empty(1 << 14, self.flat.dtype)
        blocks = [(*(y.flat[rest][i : i + (1 << 14)] for y in (back, self, seen)), spare[: min(1 << 14, self.flat[rest].size - i)]) for i in range(0, self.flat[rest].size, 1 << 14)]
        h = np.zeros((n, WIDTH), np.float32)
        for at in range(0, steps, WINDOW):
            to = min(at + WINDOW, steps)
            _, h = self.window(lanes[at:to], lanes[at + 1 : to + 1], h, back)
            for g, own, squares, step in blocks:
                np.multiply(g, g, out=step)
                squares += step
                np.sqrt(squares, out=step)
                np.divide(g, step, out=step)
                step *= RATE
                own += step
            # embeddings of words that the window has not stay as they are
            words = back.touched
            d, total = back.embedding.take(words, axis=0), seen.embedding.take(words, axis=0)
            total += d * d
            seen.embedding[words] = total
            np.sqrt(total, out=total)
            d *= RATE
            d /= total
            d += self.embedding.take(words, axis=0)
            self.embedding[words] = d

    def score(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of each text, given by the ranks of its tokens."""
        n, width = np.diff(first), WIDTH
        out = np.zeros(len(n))
        if not len(tokens):
            return out
        # texts go one after another in lanes of about the same length, of which no lane is longer than it must be
        lanes = int(min(SCORE_LANES, -(-len(tokens) // int(n.max()))))
        queues: list[list[int]] = [[] for _ in range(lanes)]
        loads = [(0, lane) for lane in range(lanes)]
        for text in np.argsort(-n, kind="stable").tolist():
            load, lane = loads[0]
            queues[lane].append(text)
            heapq.heapreplace(loads, (load + int(n[text]), lane))
        loads = sorted(loads, reverse=True)
        load = np.array([x for x, _ in loads])
        texts_ = np.concatenate([np.array(queues[lane], np.int64) for _, lane in loads])
        place, text = runs(first[texts_], n[texts_]), np.repeat(texts_, n[texts_])
        tokens = tokens[place]
        new = np.ones(len(text), bool)
        new[1:] = text[1:] != text[:-1]
        before = np.append(self.rank[END], tokens[:-1])
        before[new] = self.rank[END]
        begin = np.cumsum(load) - load
        projected, u = self.turned(self.embedding @ self.w + self.b), self.turned(self.u)
        h = np.zeros((lanes, width), np.float32)
        for at in range(0, int(load[0]), SCORE_WINDOW):
            live = int(np.searchsorted(-load, -at, "left"))
            t = min(SCORE_WINDOW, int(load[0]) - at)
            steps = at + np.arange(t)[:, None]
            inside = steps < load[:live]
            own = begin[:live] + np.minimum(steps, load[:live] - 1)
            starts = new[own]
            some = starts.any(axis=1).tolist()
            x = np.take(projected, before[own], axis=1)
            a = np.empty((3, live, width), np.float32)
            states = np.empty((t + 1, live, width), np.float32)
            states[0] = h[:live]
            with np.errstate(over="ignore", under="ignore"):
                for i in range(t):
                    # a new text starts from nothing; the state before it stays, as its own text's
                    h = states[i] * ~starts[i][:, None] if some[i] else states[i]
                    self._step(x[:, i], h, u, a, states[i + 1])
            h = states[t]
            passed = states[1:].reshape(-1, width)
            if not inside.all():
                own, passed = own[inside], passed[inside.ravel()]
            own = own.ravel()
            logs, _ = self.losses(passed, tokens[own])
            out += np.bincount(text[own], logs, len(n))
        return out / math.log(10)


def count_words(rows: DataFrame) -> Vocabulary:
    """Frequent words of the training documents, and how many tokens and distinct ones there are in all."""
    buckets, top = BUCKETS, 4 * FREQUENT // BUCKETS

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            hashes, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            keys, back = np.unique(hashes, return_inverse=True)
            counts = np.bincount(back, n, len(keys)).astype(np.int64)
            bucket = (keys >> np.uint64(32)).astype(np.int64) * buckets >> 32
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cuts)).tolist()
            a, b = keys.tobytes(), counts.tobytes()
            return pa.record_batch([pa.array(full, pa.int32()), *(pa.array([x[8 * cuts[k] : 8 * cuts[k + 1]] for k in full], pa.binary()) for x in (a, b))], ["bucket", "hashes", "counts"])

        for batch, data, offsets in slices(batches):
            hashes, first = token_hashes(data, offsets)
            train = _folds(batch.column("doc_id")) % 7 != 2
            held.append(np.unique(hashes[np.repeat(train, np.diff(first))], return_counts=True))
            if sum(len(h) for h, _ in held) > 2_000_000:
                yield flush()
        if held:
            yield flush()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def close() -> pa.RecordBatch:
            hashes, counts = (np.concatenate(c) for c in zip(*held, strict=True))
            keys, back = np.unique(hashes, return_inverse=True)
            n = np.bincount(back, counts, len(keys)).astype(np.int64)
            best = np.lexsort((keys, -n))[:top]
            held.clear()
            return pa.record_batch([pa.array([keys[best].tobytes()], pa.binary()), pa.array([n[best].tobytes()], pa.binary()), pa.array([int(n.sum())]), pa.array([len(keys)])], ["hashes", "counts", "tokens", "distinct"])

        for batch in batches:
            for b, hashes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and held:
                    yield close()
                bucket = b
                held.append((np.frombuffer(hashes, np.uint64), np.frombuffer(counts, np.int64)))
        if held:
            yield close()

    parts = rows.mapInArrow(own, "bucket int, hashes binary, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    found = parts.mapInArrow(merged, "hashes binary, counts binary, tokens long, distinct long").collect()  # at most buckets * top words
    hashes = np.concatenate([np.frombuffer(r.hashes, np.uint64) for r in found] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in found] or [np.zeros(0, np.int64)])
    best = np.lexsort((hashes, -counts))[:FREQUENT]
    return Vocabulary(hashes[best], counts[best], sum(r.tokens for r in found), sum(r.distinct for r in found))


def number_words(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """NUMBERED, stored, so texts are cut into words once: for each document the model's numbers of its tokens and
    what its frequent words say of it, with its place in its part; for each bucket of hashes and part the occurrences
    of other words: hashes, places, and how often, negative in held-out documents, where they do not count.
    """
    words = rows.sparkSession.sparkContext.broadcast(vocabulary)
    buckets = 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([("part", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("n", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("unknown", pa.int64()), ("score", pa.float64()), ("ids", pa.binary()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])

    def batch_of(length: int, /, **columns: list | np.ndarray | pa.Array) -> pa.RecordBatch:
        return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in schema], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at_row, held, n_held = TaskContext.get().partitionId(), 0, [], 0
        vocab = words.value
        logs = np.log10(vocab.counts + 1.0)

        def flush() -> pa.RecordBatch:
            h, doc, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.argsort(h, kind="stable")
            h, doc, n = h[order], doc[order].astype(np.int32), n[order].astype(np.int32)
            bucket = (h >> np.uint64(32)).astype(np.int64) * buckets >> 32
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(h)]]).tolist() if len(h) else [0]
            ranges = list(zip(cuts, cuts[1:], strict=False))
            own = {name: [x[i:j].tobytes() for i, j in ranges] for name, x in (("a", h), ("b", doc), ("c", n))}
            return batch_of(len(ranges), part=[part] * len(ranges), bucket=[int(bucket[i]) for i, _ in ranges], **own)

        for batch, data, offsets in slices(batches):
            hashes, first = token_hashes(data, offsets)
            docs_here, n = batch.num_rows, np.diff(first)
            train = _folds(batch.column("doc_id")) % 7 != 2
            owner = np.repeat(np.arange(docs_here), n)
            at, there = vocab.look_up(hashes)
            number = np.where(there, vocab.number.take(at), UNKNOWN) if len(vocab.hashes) else np.zeros(len(hashes), np.int64)
            own = np.where(there, logs.take(at), 0.0) if len(vocab.hashes) else np.zeros(len(hashes))
            unknown = number == UNKNOWN
            raw, cuts = number.astype(np.uint16).tobytes(), (2 * first).tolist()
            yield batch_of(
                docs_here, part=np.full(docs_here, part), place=np.arange(at_row, at_row + docs_here), doc_id=batch.column("doc_id"), train=train, n=n,
                known=np.bincount(owner, there, docs_here).astype(np.int64), base=np.bincount(owner, own, docs_here),
                unknown=np.bincount(owner, unknown, docs_here).astype(np.int64), score=np.bincount(owner, own * unknown, docs_here),
                ids=[raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)],
            )
            rare = np.flatnonzero(~there)
            doc, h = owner[rare], hashes[rare]
            order = np.lexsort((h, doc))
            h, doc = h[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            start = np.flatnonzero(new)
            times = np.diff(np.append(start, len(h)))
            held.append((h[start], doc[start] + at_row, np.where(train[doc[start]], times, -times)))
            n_held += len(start)
            at_row += docs_here
            if n_held > 1_000_000:
                yield flush()
                n_held = 0
        if held:
            yield flush()

    return stored(rows.mapInArrow(scan, NUMBERED))


def fit(rows: DataFrame, vocabulary: Vocabulary, numbered: DataFrame | None = None) -> Model:
    """The model, trained by replicas whose parameters are averaged after each round; numbered: rows by number_words, if they are there."""
    spark = rows.sparkSession
    words = spark.sparkContext.broadcast(vocabulary)
    train = (number_words(rows, vocabulary) if numbered is None else numbered).filter("train").select("ids", "n", "doc_id")
    total = train.agg(F.sum("n")).first()[0] or 0
    model = Model(vocabulary.frequency)
    if not total:
        return model
    replicas = -(-total // REPLICA_TOKENS)
    block = 1 << 14
    groups = math.isqrt(replicas - 1) + 1  # replicas are averaged in groups, then the groups
    # a session may deal rows to more partitions than asked for, as the check tool's does; replicas, of which each shuffles a whole model, stay as many
    dealt = train.repartition(int(replicas), F.xxhash64("ids", "doc_id")).coalesce(int(replicas))
    schema = "block int, group int, x binary, weight long"
    for round_ in range(ROUNDS):
        now = spark.sparkContext.broadcast(model.flat.copy())

        def replica(batches: Iterator[pa.RecordBatch], now=now, round_=round_) -> Iterator[pa.RecordBatch]:
            cells = sorted((c for b in batches for c in b.column("ids").to_pylist()), key=lambda c: (zlib.crc32(c), c))
            group = TaskContext.get().partitionId() % groups
            own = Model(words.value.frequency, now.value.copy())
            tokens = np.frombuffer(b"".join(cells[round_::ROUNDS]), np.uint16).astype(np.int64)
            if len(tokens):
                own.train(own.rank[tokens])
                flat = [own.flat[i : i + block].tobytes() for i in range(0, len(own.flat), block)]
                yield pa.record_batch([pa.array(range(len(flat)), pa.int32()), pa.array([group] * len(flat), pa.int32()), pa.array(flat, pa.binary()), pa.array([len(tokens)] * len(flat), pa.int64())], ["block", "group", "x", "weight"])

        def averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            weights: dict[int, int] = {}
            for batch in batches:
                for k, x, w in zip(*(batch.column(c).to_pylist() for c in ("block", "x", "weight")), strict=True):
                    sums[k] = sums.get(k, 0) + np.frombuffer(x, np.float32).astype(np.float64) * w
                    weights[k] = weights.get(k, 0) + w
            for k, x in sums.items():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([0], pa.int32()), pa.array([(x / weights[k]).astype(np.float32).tobytes()], pa.binary()), pa.array([weights[k]], pa.int64())], ["block", "group", "x", "weight"])

        blocks = dealt.mapInArrow(replica, schema).repartition("block", "group").mapInArrow(averaged, schema).repartition("block").mapInArrow(averaged, schema).collect()
        now.destroy()
        for r in blocks:  # one for each block of a model of fixed size
            model.flat[r.block * block : r.block * block + block] = np.frombuffer(r.x, np.float32)
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """RESULT: token counts and log10 probabilities of every row's whole text.

    Tokens are words, lower-cased A-Z, then one end. Null and empty texts are one end. Documents whose
    crc32(doc_id as text) mod 7 is 2 are held out of counting and training; a null doc_id is not held out. Repeated
    rows count, train and are scored each. An empty table gives no rows; other columns are ignored.
    """
    rows = texts(docs)
    spark = docs.sparkSession
    vocabulary = count_words(rows)
    numbered = number_words(rows, vocabulary)
    trained = fit(rows, vocabulary, numbered)
    words, flat = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(trained.flat)
    schema = "part int, rare boolean, a binary, b binary, c binary"
    names = ["part", "rare", "a", "b", "c"]
    known_kind = np.dtype([("doc", np.int64), ("null", np.bool_), ("held_out", np.bool_), ("n", np.int64), ("known", np.int64), ("base", np.float64), ("score", np.float64), ("unknown", np.int64)])

    def row(part: int, rare: bool, a: bytes, b: bytes, c: bytes) -> pa.RecordBatch:
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([rare]), *(pa.array([x], pa.binary()) for x in (a, b, c))], names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a document's frequent words and the model say of it."""
        waiting: list[tuple] = []  # documents that are not scored yet
        n_waiting = 0
        model = Model(words.value.frequency, flat.value)

        def flush() -> Iterator[pa.RecordBatch]:
            out, part, place, ranks = (np.concatenate(c) for c in zip(*waiting, strict=True))
            waiting.clear()
            out["score"] += model.score(ranks, np.concatenate([[0], np.cumsum(out["n"])]))
            for k in np.unique(part).tolist():
                own = part == k
                yield row(k, False, out[own].tobytes(), place[own].tobytes(), b"")

        for batch in batches:
            ids, out = batch.column("doc_id"), np.zeros(batch.num_rows, known_kind)
            out["null"] = ~ids.is_valid().to_numpy(zero_copy_only=False)
            out["doc"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            out["held_out"] = ~batch.column("train").to_numpy(zero_copy_only=False)
            for name in ("n", "known", "base", "unknown", "score"):
                out[name] = batch.column(name).to_numpy()
            numbers = np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.uint16)
            waiting.append((out, *(batch.column(c).to_numpy().astype(np.int32) for c in ("part", "place")), model.rank.take(numbers).astype(np.uint16)))
            n_waiting += len(numbers)
            if n_waiting > SCORE_TOKENS:
                yield from flush()
                n_waiting = 0
        if waiting:
            yield from flush()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each part, sums over the occurrences that fell to this partition."""
        bucket, held, sums = None, [], []

        def close() -> None:
            h, part, doc, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            _, back = np.unique(h, return_inverse=True)
            c = np.bincount(back, np.maximum(n, 0))[back]
            key, where = np.unique(part.astype(np.int64) << 32 | doc, return_inverse=True)
            sums.append((key, np.bincount(where, np.abs(n) * np.log10(c + 1), len(key)), np.bincount(where, np.abs(n) * (c > 0), len(key))))

        def flush() -> Iterator[pa.RecordBatch]:
            key, base, known = (np.concatenate(c) for c in zip(*sums, strict=True))
            sums.clear()
            own, where = np.unique(key, return_inverse=True)
            base, known = np.bincount(where, base, len(own)), np.bincount(where, known, len(own))
            for at in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own >> 32)) + 1):
                yield row(int(own[at[0]] >> 32), True, (own[at] & 0xFFFFFFFF).astype(np.int32).tobytes(), base[at].tobytes(), known[at].astype(np.int32).tobytes())

        for batch in batches:
            for b, part, x, y, z in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and held:
                    close()
                bucket = b
                h = np.frombuffer(x, np.uint64)
                held.append((h, np.full(len(h), part), np.frombuffer(y, np.int32), np.frombuffer(z, np.int32)))
            if sum(len(s[0]) for s in sums) > 1_000_000:
                yield from flush()
        if held:
            close()
        if sums:
            yield from flush()

    total = math.log10(vocabulary.train_tokens + vocabulary.distinct + 1)
    shared = math.log10(vocabulary.unknown_mass)
    train_tokens = vocabulary.train_tokens

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs_, extra = None, [], []

        def close() -> pa.RecordBatch:
            d = np.concatenate([np.frombuffer(x, known_kind) for x, _ in docs_])
            place = np.concatenate([np.frombuffer(y, np.int32) for _, y in docs_])
            base, known = np.zeros(int(place.max()) + 1), np.zeros(int(place.max()) + 1, np.int64)
            for x, y, z in extra:
                at = np.frombuffer(x, np.int32)
                np.add.at(base, at, np.frombuffer(y, np.float64))
                np.add.at(known, at, np.frombuffer(z, np.int32))
            docs_.clear()
            extra.clear()
            base, known = base[place], known[place]
            columns = [pa.array(d["doc"], mask=d["null"]), pa.array(d["held_out"]), pa.array(d["n"]), pa.array(d["known"] + known), pa.array(np.full(len(d), train_tokens)), pa.array(d["base"] + base - d["n"] * total), pa.array(d["score"] + base - d["unknown"] * shared)]
            return pa.record_batch(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for part, rare, x, y, z in zip(*(batch.column(c).to_pylist() for c in ("part", "rare", "a", "b", "c")), strict=True):
                if part != now and docs_:
                    yield close()
                now = part
                if rare:
                    extra.append((x, y, z))
                else:
                    docs_.append((x, y))
        if docs_:
            yield close()

    documents = numbered.filter("bucket is null").drop("bucket", "a", "b", "c").mapInArrow(scored, schema)
    others = numbered.filter("bucket is not null").select("bucket", "part", "a", "b", "c").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(counted, schema)
    return documents.union(others).repartition("part").sortWithinPartitions("part").mapInArrow(gathered, RESULT)
