"""Chunked encoding against the library on whole texts."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import bpe, common, tokens

VOCAB = common.vocabulary("byte_bpe_50k.json")
FULL = tokens.tokenizer(VOCAB)
ALPHABET = "ab C\n\t  .,'s<|endoftext|>é漢 1  "


def ids_of(text):
    return FULL.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET.replace(" ", "x"), max_size=60), st.data())
def test_joins(text, data):
    places = sorted({data.draw(st.integers(0, len(text))) for _ in range(3)} | {0, len(text)})
    parts = [text[a:b] for a, b in zip(places, places[1:])]
    raw = [p.encode() for p in parts]
    ids, before = bpe.encode_pieces(VOCAB, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    pieces = [ids[a:b] for a, b in zip(before, before[1:])]
    assert [p.tolist() for p in pieces] == [ids_of(p) for p in parts]
    assert bpe.joined(pieces, VOCAB).tolist() == ids_of(text)
    assert bpe.decode(bpe.joined(pieces, VOCAB), VOCAB) == text


def test_cuts_are_content_defined():
    rng = np.random.default_rng(0)
    a, b, c = ("".join(map(chr, rng.integers(97, 1500, n))) for n in (9000, 30_000, 5000))
    sets = []
    for text in (a + b, b + c):
        data = np.frombuffer(text.encode(), np.uint8)
        ends, _ = bpe.cuts(data, np.array([0, len(data)]))
        pieces = [bytes(data[s:e]).decode() for s, e in zip([0, *ends], ends)]
        assert "".join(pieces) == text
        sets.append(set(pieces))
    assert len(sets[0] & sets[1]) > 10


@pytest.mark.parametrize("bits", [4, 10])
def test_documents(spark, monkeypatch, bits):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    monkeypatch.setattr(bpe.cuts, "__defaults__", (bits,))
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta,", "don't", "x<|endoftext|>y", "été", "  gap", "\n\n", "漢字", "12345", "𝄞"]
    common_part = " ".join(rng.choice(words, 800))
    texts = {i: " ".join(rng.choice(words, 40)) + common_part[i:] + "tail" * (i % 3) for i in range(20)}
    texts |= {100: None, 101: "", 102: " ", 103: common_part, 104: common_part, 105: "a  b" + common_part, 106: "x" * 20_000, 107: " ", 108: "\n \nbar  <|endoftext|>  "}
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, ids int").repartition(3)
    got = {r.doc_id: r for r in bpe.encode_documents(df).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        assert np.frombuffer(got[i].ids, np.uint16).tolist() == ids_of(t or ""), i
        assert got[i].n_tokens == len(ids_of(t or ""))
    for r in bpe.digests(bpe.encode_documents(df)).collect():
        t = texts[r.doc_id] or ""
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids_of(t))).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(FULL.decode(ids_of(t), skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(df.limit(0)).count() == 0
