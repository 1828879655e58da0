"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback measures how a text breaks into tokens:
characters per token, the share of fallback bytes, and the entropy of the
text's token distribution. Prose of a language stays within known bands; mark-up
remnants, shouting, symbol noise and loops leave them. Bands are taken by the
row's language where there is one, else by the script most of its letters have.

Documents are judged one by one in one pass over the table without a shuffle.
A word's pieces are looked up once for each worker and kept in a bounded cache.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from terrafold.llm.common import SPACES, Words, slices, small_batches, texts, vocabulary, windows, words

SYMBOLS = "#*$%&|<>"
CACHE_WORDS = 100_000
#: The longest labelled text has about so many words.
MOST_WORDS = 5000
WIDE_ENTROPY = 5.3
COLUMNS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy double, band string, base_failed boolean, kept boolean"


@dataclass(frozen=True)
class Band:
    """What a text of a language or script keeps to: characters per token, byte share, bits of token entropy, tokens per word.

    Limits with a slope move by slope / sqrt(words), as short texts scatter more; from MOST_WORDS on they stay.
    Texts of more characters a token than most_fitted are unlike all that the limits were fitted on: of these, only
    WIDE_ENTROPY is asked.
    """

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float
    most_tokens: float = math.inf
    chars_slope: float = 0.0
    entropy_slope: float = 0.0
    tokens_slope: float = 0.0
    most_fitted: float = math.inf

    def keeps(self, chars: float, byte_share: float, entropy: float, tokens: float = 0.0, n_words: int = MOST_WORDS) -> bool:
        if chars > self.most_fitted:
            return chars <= self.most_chars and byte_share <= self.most_bytes and entropy >= WIDE_ENTROPY
        x = 1 / math.sqrt(min(max(n_words, 1), MOST_WORDS))
        inside = self.least_chars + self.chars_slope * x <= chars <= self.most_chars and byte_share <= self.most_bytes
        return inside and entropy >= self.least_entropy + self.entropy_slope * x and tokens <= self.most_tokens + self.tokens_slope * x


def fit_limit(n_words: np.ndarray, figure: np.ndarray, loss: float) -> tuple[float, float]:
    """Limit and slope below which that share of clean texts has the figure; for an upper limit, negate figure and result."""
    x = 1 / np.sqrt(n_words)
    slope, limit = np.polyfit(x, figure, 1)
    rest = figure - limit - slope * x
    wider, wide = np.polyfit(x, np.abs(rest), 1)
    if wider < 0:
        wide, wider = np.abs(rest).mean(), 0.0
    elif wide < 0:
        wide, wider = 0.0, (np.abs(rest) / x).mean()
    z = np.quantile(rest / (wide + wider * x), loss)
    return float(limit + z * wide), float(slope + z * wider)


#: Languages: fit_limit at 0.0025 a figure over the 3243 documents of sf0.1 labelled clean that pass the base rule,
#: and their most characters a token. Scripts have no labelled documents and stay wide.
BANDS = {
    "en": Band(2.218, 6.5, 0.06, 7.129, 2.246, -2.648, -11.805, 4.752, 2.43),
    "de": Band(2.246, 6.5, 0.06, 6.918, 2.431, -2.072, -10.110, 4.460, 2.44),
    "es": Band(1.929, 6.5, 0.06, 6.951, 2.665, -1.445, -10.851, 4.284, 2.08),
    "fr": Band(1.994, 6.5, 0.06, 6.810, 2.485, -2.569, -9.564, 6.798, 2.20),
    "latin": Band(1.2, 6.5, 0.15, 5.0),
    "cyrillic": Band(1.2, 6.5, 0.15, 5.0),
    "other": Band(0.2, 6.5, 1.0, 4.0),
}
_LATIN, _CYRILLIC = re.compile("[A-Za-zÀ-ɏ]"), re.compile("[Ѐ-ԯ]")


def script(text: str) -> str:
    """The script of most letters: latin, cyrillic or other."""
    latin, cyrillic = (len(p.findall(text)) for p in (_LATIN, _CYRILLIC))
    rest = sum(map(str.isalpha, text)) - latin - cyrillic
    return max((latin, "latin"), (cyrillic, "cyrillic"), (rest, "other"), key=lambda x: x[0])[1]


class Pieces(dict):
    """The piece ids of words, as bytes of unsigned 16-bit numbers."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.model = SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])

    def learn(self, found: set[str]) -> None:
        if len(self) > CACHE_WORDS:
            self.clear()
        new = [w for w in found if w not in self]
        self.update(zip(new, (np.array(x, np.uint16).tobytes() for x in self.model.encode(new)), strict=True))


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def repeated_words(grams: np.ndarray, k: int) -> int:
    """How many words lie in a window of k words, given by its hash, that is found twice or more."""
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    dup = np.zeros(len(s), bool)
    dup[1:] |= same
    dup[:-1] |= same
    covered = np.zeros(len(s) + k - 1, bool)
    at = order[dup]
    for i in range(k):
        covered[at + i] = True
    return int(covered.sum())


def line_repeats(text: str) -> int:
    kept = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(kept) - len(set(kept))


def judged(batches: Iterator[pa.RecordBatch], path: str, bands: dict[str, Band], k: int, least_words: int, most_repeats: int) -> Iterator[pa.RecordBatch]:
    pieces = _pieces(path)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in COLUMNS.split(", ")])
    for batch, data, offsets in slices(batches):
        found = Words(data, offsets)
        hashes, first = found.hashes(), found.first
        doc_ids, langs, all_texts = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "text"))
        split = [words(t) for t in all_texts]
        pieces.learn({w for ws in split for w in ws})
        out = []
        for i, (text, ws) in enumerate(zip(all_texts, split, strict=True)):
            n, own = len(ws), hashes[first[i] : first[i + 1]]
            repeats = repeated_words(windows(own, k), k) if n >= k else 0
            ids = np.frombuffer(b"".join(map(pieces.__getitem__, ws)), np.uint16)
            _, counts = np.unique(ids, return_counts=True)
            share = counts / max(1, len(ids))
            chars = len(text) - sum(map(text.count, SPACES))
            fertility = (chars / len(ids), float(pieces.is_byte[ids].mean()), float(-(share * np.log2(share)).sum())) if n else (0.0, 0.0, 0.0)
            band = langs[i] if langs[i] in bands else script(text)
            failed = n < least_words or 100 * repeats > most_repeats * n
            out.append((doc_ids[i], n, chars, sum(map(text.count, SYMBOLS)), line_repeats(text), repeats, len(ids), *fertility, band, failed, not failed and bands[band].keeps(*fertility, len(ids) / max(1, n), n)))
        yield pa.record_batch([pa.array([r[j] for r in out], f.type) for j, f in enumerate(schema)], names)


def quality_rules(docs: DataFrame, bands: dict[str, Band] = BANDS, vocab: str | None = None, least_words: int = 50, most_repeats: int = 50, window: int = 3) -> DataFrame:
    """Base counts, fertility figures and verdicts (COLUMNS) of every document, one row for each row of docs.

    Null or empty texts have no words and fail the base rule; a null doc_id stays null; repeated rows are judged
    alike. lang is used if docs has it; a null or unknown language is judged by script. Other columns are ignored.
    """
    path = vocab or vocabulary("piece_bpe_32k.model")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = texts(docs, lang.alias("lang"))
    return rows.mapInArrow(lambda batches: judged(batches, path, bands, window, least_words, most_repeats), COLUMNS)


def keep_documents(docs: DataFrame, bands: dict[str, Band] = BANDS, vocab: str | None = None) -> DataFrame:
    """The rows of docs that quality_rules keeps, unchanged, in one pass without a shuffle."""
    path = vocab or vocabulary("piece_bpe_32k.model")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            columns = {"doc_id": pa.nulls(n, pa.int64()), "text": pc.fill_null(batch.column("text"), ""), "lang": batch.column("lang") if "lang" in batch.schema.names else pa.nulls(n, pa.string())}
            own = pa.record_batch(list(columns.values()), list(columns))
            kept = [b.column("kept") for b in judged(iter([own]), path, bands, 3, 50, 50)]
            yield batch.filter(pa.chunked_array(kept, pa.bool_()).combine_chunks())

    return small_batches(docs).mapInArrow(each, docs.schema)
