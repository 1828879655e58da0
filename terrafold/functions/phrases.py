"""Aspects and sentiment of comments by a lexicon of phrases, found in one pass of an Aho-Corasick automaton.

A lexicon is a table (phrase, kind) of thousands of phrases in any languages.
Texts go through the automaton in Arrow batches, whole and once. Of phrases that
overlap within a kind's group, the longest that starts first counts, so "not
good" is not also "good"; a negation up to some words before a phrase turns it.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds of phrases; an aspect's is aspect: and its name.
POSITIVE, NEGATIVE, NEGATION, CONTRAST, ASPECT = "positive", "negative", "negation", "contrast", "aspect:"
#: Of these every occurrence counts, and no negation turns them.
GLAD, SAD = "positive_emoji", "negative_emoji"
#: Phrases a lexicon may have at most: it travels to every task.
MOST_PHRASES = 100_000
#: Phrases so short must stand alone; words of a clause in which one phrase tells its aspect; the shortest clause and text.
ALONE, CLAUSE_WORDS, SHORTEST = 2, 15, 3
#: Signals a kind can give, exclamation marks that are one, signals of a sure label, and its confidence.
MOST_SIGNALS, MARKS, SURE = 3, 2, 5.0
LEAST, SPREAD, TOP, TIED, UNTOLD = 0.4, 0.55, 0.95, 0.5, 0.3
#: Words that a negation may stand before a phrase.
WINDOW = 3

_GROUPS = {POSITIVE: "mood", NEGATIVE: "mood", NEGATION: "mood", GLAD: "emoji", SAD: "emoji"}
_AWAY = re.compile(r"http\S+|www\S+|@\w+")
_WORD = re.compile(r"\w+")
_CUT = re.compile(r"[.,?;\n]|!+")


def lower(text: str) -> str:
    """Lower case, a character for a character, as SQL has it: a final sigma is one as any other."""
    return text.replace("Σ", "σ").replace("İ", "i").lower()


class Hit(NamedTuple):
    start: int
    end: int
    phrase: str
    kind: str


class Lexicon:
    """Phrases by kind, lower-case; the automaton is built where it is first used."""

    def __init__(self, phrases: list[tuple[str, str]]) -> None:
        self.phrases = sorted({(lower(p), k) for p, k in phrases if p and k})
        self.aspects = sorted({k[len(ASPECT) :] for _, k in self.phrases if k.startswith(ASPECT)})

    @classmethod
    def of(cls, table: DataFrame, most: int = MOST_PHRASES) -> Lexicon:
        """From a table (phrase, kind), of which at most `most` rows come to the driver; with more, ValueError."""
        rows = table.select("phrase", "kind").dropna().distinct().limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"a lexicon of more than {most} phrases")
        return cls([(r.phrase, r.kind) for r in rows])

    def __reduce__(self) -> tuple:
        return Lexicon, (self.phrases,)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton | None:
        kinds: dict[str, list[str]] = {}
        for phrase, kind in self.phrases:
            kinds.setdefault(phrase, []).append(kind)
        found = ahocorasick.Automaton()
        for phrase, own in kinds.items():
            found.add_word(phrase, (phrase, own))
        found.make_automaton()
        return found if kinds else None

    def each(self, text: str) -> Counter:
        """By (phrase, kind), how often each phrase occurs in text, which is lower-case, from left to right, not overlapping itself."""
        out: Counter = Counter()
        free: dict[str, int] = {}  # the end of a phrase's last occurrence
        for last, (phrase, kinds) in self.automaton.iter(text) if self.automaton else ():
            if last - len(phrase) + 1 >= free.get(phrase, 0):
                free[phrase] = last + 1
                out.update((phrase, kind) for kind in kinds)
        return out

    def hits(self, text: str) -> list[Hit]:
        """The phrases of text, which is lower-case, in order; the longest of those that overlap, group by group.

        Positive, negative and negation are one group, and so are emoji; contrast and each aspect are others.
        """
        groups: dict[str, list[Hit]] = {}
        for last, (phrase, kinds) in self.automaton.iter(text) if self.automaton else ():
            start, end = last - len(phrase) + 1, last + 1
            if len(phrase) <= ALONE and phrase.isalpha() and ((start and text[start - 1].isalpha()) or text[end : end + 1].isalpha()):
                continue
            for kind in kinds:
                groups.setdefault(_GROUPS.get(kind, kind), []).append(Hit(start, end, phrase, kind))
        out = []
        for found in groups.values():
            end = 0
            for hit in sorted(found, key=lambda h: (h.start, -h.end, h.kind)):
                if hit.start >= end:
                    out.append(hit)
                    end = hit.end
        return sorted(out)


def turned(hits: list[Hit], text: str, window: int = WINDOW) -> list[Hit]:
    """hits without negations: a phrase with one in the window words before it, in its clause, has the other sign."""
    other = {POSITIVE: NEGATIVE, NEGATIVE: POSITIVE}
    nots = [h for h in hits if h.kind == NEGATION]
    out = []
    for hit in hits:
        if hit.kind in other:
            between = (text[n.end : hit.start] for n in nots if n.end <= hit.start)
            if any(len(_WORD.findall(gap)) < window and not _CUT.search(gap) for gap in between):
                hit = hit._replace(kind=other[hit.kind])
        if hit.kind != NEGATION:
            out.append(hit)
    return out


def _told(hits: list[Hit], kind: str) -> int:
    """How many different phrases of a kind; of emoji, how many."""
    own = [h.phrase for h in hits if h.kind == kind]
    return len(own if kind in (GLAD, SAD) else set(own))


def label(text: str | None, lexicon: Lexicon, window: int = WINDOW) -> dict:
    """label, confidence, aspects (comma-joined, in order of name) and, for each aspect, its pos and neg (1 or 0).

    Signals of a side: up to three different phrases and three emoji, and for positive one for two exclamation marks; one more
    signal tells nothing. The stronger side wins with min(0.95, 0.4 + 0.55 * its share * min(signals / 5, 1)); equal
    sides are neutral at 0.5. A clause, between marks, line ends and contrasts, tells of an aspect with two of its
    phrases, or with one in 15 words at most; the side with more phrases in such clauses is the aspect's, else the
    text's. Urls and mentions are blanks. Texts under three characters are neutral at 0.3, with no aspects.
    """
    out: dict = {"label": "neutral", "confidence": UNTOLD, "aspects": ""} | {f"{a}_{side}": 0.0 for a in lexicon.aspects for side in ("pos", "neg")}
    if text is None or len(text.strip()) < SHORTEST:
        return out
    low = _AWAY.sub(lambda m: " " * len(m[0]), lower(text))
    hits = turned(lexicon.hits(low), low, window)
    positive, negative = (sum(min(_told(hits, k), MOST_SIGNALS) for k in kinds) for kinds in ((POSITIVE, GLAD), (NEGATIVE, SAD)))
    positive += text.count("!") >= MARKS
    signals, side = positive + negative + 1, max(positive, negative)
    if positive == negative:
        out["confidence"] = TIED
    else:
        out["label"] = POSITIVE if positive > negative else NEGATIVE
        out["confidence"] = min(TOP, LEAST + side / signals * SPREAD * min(signals / SURE, 1.0))

    cuts = sorted([(m.start(), m.end()) for m in _CUT.finditer(low)] + [(h.start, h.end) for h in hits if h.kind == CONTRAST])
    starts, ends = [0, *(b for _, b in cuts)], [*(a for a, _ in cuts), len(low)]
    clauses: dict[int, list[Hit]] = {}
    for hit in hits:
        i = bisect_right(starts, hit.start) - 1
        if hit.kind != CONTRAST and hit.end <= ends[i]:
            clauses.setdefault(i, []).append(hit)
    sides: dict[str, Counter] = {}
    for i, own in clauses.items():
        clause = low[starts[i] : ends[i]].strip()
        if len(clause) < SHORTEST:
            continue
        lean = _told(own, POSITIVE) + _told(own, GLAD) + (clause.count("!") >= MARKS) - _told(own, NEGATIVE) - _told(own, SAD)
        for aspect in lexicon.aspects:
            n = _told(own, ASPECT + aspect)
            if n >= 2 or (n == 1 and len(clause.split()) <= CLAUSE_WORDS):
                sides.setdefault(aspect, Counter())[(lean > 0) - (lean < 0)] += 1
    for aspect, own in sides.items():
        lean = own[1] - own[-1] or {POSITIVE: 1, NEGATIVE: -1}.get(out["label"], 0)
        out[f"{aspect}_pos"], out[f"{aspect}_neg"] = float(lean > 0), float(lean < 0)
    out["aspects"] = ",".join(sorted(sides))
    return out


def phrase_labels(df: DataFrame, column: str, lexicon: Lexicon, window: int = WINDOW) -> DataFrame:
    """df with what label says of a text column: label, confidence, aspects, and two columns for each aspect."""
    more = ["label string", "confidence double", "aspects string", *(f"{a}_{side} double" for a in lexicon.aspects for side in ("pos", "neg"))]
    sent = df.sparkSession.sparkContext.broadcast(lexicon)  # of a checked size

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        names = [m.split()[0] for m in more]
        for batch in batches:
            told = [label(t, own, window) for t in batch[column]]
            yield pd.concat([batch.reset_index(drop=True), pd.DataFrame([[t[n] for n in names] for t in told], columns=names)], axis=1)

    return df.mapInPandas(task, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, {', '.join(more)}")


def phrase_hits(df: DataFrame, key: str, column: str, lexicon: Lexicon, apart: bool = False) -> DataFrame:
    """(key, phrase, kind, n): how often each phrase of the lexicon occurs in each text, the longest of overlapping ones.

    Apart, each phrase counts for itself, whatever others overlap it, as replacing it alone would; short ones need not stand alone.
    """
    kind = df.schema[key].dataType.simpleString()
    sent = df.sparkSession.sparkContext.broadcast(lexicon)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text is not None:
                    found = sent.value.each(lower(text)) if apart else Counter((h.phrase, h.kind) for h in sent.value.hits(lower(text)))
                    rows += [i] * len(found)
                    out += [(*h, n) for h, n in found.items()]
            phrases, kinds, n = zip(*out, strict=True) if out else ((), (), ())
            yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(phrases, pa.string()), pa.array(kinds, pa.string()), pa.array(n, pa.int64())], ["key", "phrase", "kind", "n"])

    return df.select(key, column).mapInArrow(task, f"key {kind}, phrase string, kind string, n long").withColumnRenamed("key", key)
