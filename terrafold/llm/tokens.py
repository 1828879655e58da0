"""Tokenising whole batches of texts through a table of distinct units.

A unit is a word, or white space and the word after it. Both public BPE
vocabularies used here split a text at those places before they merge
anything, so a text's ids are its units' ids in order. The units of a slice of
texts are hashed in numpy, only units that a worker has not met before go
through the tokenizers library, and the ids of all texts are gathered at once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from terrafold.llm.common import Words, runs

#: A worker forgets its units when it holds more than this many (about 40 bytes each).
TABLE_UNITS = 800_000
CORES = 50_000
#: White space of the vocabularies' patterns that does not separate words here.
ODD_SPACE = re.compile("[\x85\xa0  -     　]")
_SIMPLE = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE vocabularies use for each byte (a fixed rule of theirs)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes single units; letters with at most a full stop or comma go straight to the BPE model."""

    def __init__(self, path: str, fold: bool) -> None:
        """fold: the vocabulary lower-cases and drops white space."""
        self.full, self.fold = tokenizer(path), fold
        self.model = self.full.model
        self.letters = byte_letters()
        self.cores: dict[str, list[int]] = {"": []}
        self.marks = {m: self.whole(m) if m else [] for m in ("", ".", ",")}

    def whole(self, text: str) -> list[int]:
        return self.full.encode(text, add_special_tokens=False).ids

    def core(self, text: str) -> list[int]:
        ids = self.cores.get(text)
        if ids is None:
            if len(self.cores) > CORES:
                self.cores.clear()
            ids = self.cores[text] = [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, text.encode())))]
        return ids

    def unit(self, text: str) -> list[int]:
        simple = _SIMPLE.fullmatch(text)
        if simple is None:
            return self.whole(text)
        space, core, mark = simple.groups()
        return self.core(core.lower() if self.fold else space + core) + self.marks[mark]


class UnitTable:
    """Ids of units by hash."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint16)
        self.odd = np.zeros(0, bool)

    def learn(self, keys: np.ndarray, at: np.ndarray, units: list[str]) -> None:
        found = [self.encode(u) for u in units]
        n = np.array([len(x) for x in found], np.int64)
        self.slots = np.insert(self.slots, at, np.arange(len(found)) + len(self.odd))
        self.keys = np.insert(self.keys, at, keys)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(n)])
        self.ids = np.concatenate([self.ids, np.array([i for x in found for i in x], np.uint16)])
        self.odd = np.concatenate([self.odd, np.array([ODD_SPACE.search(u) is not None for u in units], bool)])

    def encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All units' ids one after another, the number of ids before each unit, and which units hold odd white space."""
        if len(self.keys) > TABLE_UNITS:
            self.forget()
        distinct, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        if not known.all():
            raw = data.tobytes()
            units = [raw[a:b].decode() for a, b in zip(starts[one[~known]].tolist(), ends[one[~known]].tolist(), strict=True)]
            self.learn(distinct[~known], at[~known], units)
            at = np.searchsorted(self.keys, distinct)
        slot = self.slots[at][back]
        n = self.starts[slot + 1] - self.starts[slot]
        before = np.concatenate([[0], np.cumsum(n)])
        return self.ids[runs(self.starts[slot], n)], before, self.odd[slot]


@lru_cache(maxsize=2)
def table(path: str, fold: bool) -> UnitTable:
    return UnitTable(Encoder(path, fold).unit)


def encode_words(path: str, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts under a vocabulary that folds case and drops white space, and the number of ids before each text."""
    found = Words(data, offsets)
    ids, before, _ = table(path, True).encoded(data, found.starts, found.ends, found.hashes())
    return ids, before[found.first]
