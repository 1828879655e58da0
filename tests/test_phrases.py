"""Phrases against a plain search, labels by hand, and dict literals against Python's own reader."""

import ast
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrafold.functions.literals import literal_map
from terrafold.functions.phrases import ASPECT, CONTRAST, GLAD, NEGATION, NEGATIVE, POSITIVE, SAD, Hit, Lexicon, label, phrase_hits, phrase_labels

GROUP = {POSITIVE: "mood", NEGATIVE: "mood", NEGATION: "mood", GLAD: "emoji", SAD: "emoji"}
WORDS = Lexicon([
    ("good", POSITIVE), ("very good", POSITIVE), ("love", POSITIVE), ("bad", NEGATIVE), ("not good", NEGATIVE), ("dirty", NEGATIVE), ("not", NEGATION), ("no", NEGATION), ("but", CONTRAST), ("😍", GLAD), ("😡", SAD),
    ("food", ASPECT + "food"), ("noodle", ASPECT + "food"), ("ăn", ASPECT + "food"), ("cheap", ASPECT + "price"), ("price", ASPECT + "price"),
])


def plain_hits(text, phrases):
    """Every occurrence of every phrase, then greedily the first and longest of each group."""
    found = {}
    for phrase, kind in phrases:
        for i in range(len(text) - len(phrase) + 1):
            if text[i : i + len(phrase)] == phrase:
                alone = not (text[i - 1 : i].isalpha() and i) and not text[i + len(phrase) : i + len(phrase) + 1].isalpha()
                if len(phrase) > 2 or not phrase.isalpha() or alone:
                    found.setdefault(GROUP.get(kind, kind), set()).add(Hit(i, i + len(phrase), phrase, kind))
    out, left = [], {g: set(h) for g, h in found.items()}
    for own in left.values():
        while own:
            first = min(own, key=lambda h: (h.start, -h.end, h.kind))
            out.append(first)
            own -= {h for h in own if h.start < first.end}
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", min_size=1, max_size=4), st.sampled_from([POSITIVE, NEGATIVE, NEGATION, CONTRAST, GLAD, ASPECT + "x"])), max_size=8), st.text("abc ", max_size=40))
def test_hits(phrases, text):
    lexicon = Lexicon(phrases)
    assert lexicon.hits(text) == plain_hits(text, lexicon.phrases)


@pytest.mark.parametrize(
    ("text", "told", "confidence", "sides"),
    [
        (None, "neutral", 0.3, {}),
        (" a ", "neutral", 0.3, {}),
        ("nothing here", "neutral", 0.5, {}),
        ("good", "positive", 0.4 + 0.5 * 0.55 * 0.4, {}),
        ("very good love", "positive", 0.4 + 2 / 3 * 0.55 * 0.6, {}),  # the longer phrase, once
        ("not very good", "negative", 0.4 + 0.5 * 0.55 * 0.4, {}),  # turned
        ("not. very good", "positive", 0.4 + 0.5 * 0.55 * 0.4, {}),  # not across clauses
        ("not one two three love", "positive", 0.4 + 0.5 * 0.55 * 0.4, {}),  # too far
        ("not good", "negative", 0.4 + 0.5 * 0.55 * 0.4, {}),
        ("GOOD! Love!", "positive", 0.4 + 3 / 4 * 0.55 * 0.8, {}),
        ("x😍😍😍😍😡", "positive", 0.4 + 3 / 5 * 0.55 * 1.0, {}),
        ("good food but dirty price", "neutral", 0.5, {"food": 1, "price": -1}),
        ("love it. the food was cheap, ok", "positive", 0.4 + 0.5 * 0.55 * 0.4, {"food": 1, "price": 1}),
        ("food " + "x " * 15 + "bad", "negative", 0.4 + 0.5 * 0.55 * 0.4, {}),  # one phrase in a long clause says nothing
        ("food noodle " + "x " * 15 + "bad", "negative", 0.4 + 0.5 * 0.55 * 0.4, {"food": -1}),
        ("băn khoăn", "neutral", 0.5, {}),  # two letters must stand alone
        ("tôi ăn http://good.love @bad", "neutral", 0.5, {"food": 0}),
        ("hay " * 2000 + "good", "positive", 0.4 + 0.5 * 0.55 * 0.4, {}),
    ],
)
def test_labels(text, told, confidence, sides):
    got = label(text, WORDS)
    assert got["label"] == told and got["confidence"] == pytest.approx(confidence) and got["aspects"] == ",".join(sorted(sides))
    for aspect in ("food", "price"):
        assert (got[f"{aspect}_pos"], got[f"{aspect}_neg"]) == (float(sides.get(aspect, 0) > 0), float(sides.get(aspect, 0) < 0))


def test_frames(spark):
    table = spark.createDataFrame([*WORDS.phrases, (None, POSITIVE), ("x", None)], "phrase string, kind string")
    lexicon = Lexicon.of(table)
    assert lexicon.phrases == WORDS.phrases and lexicon.aspects == ["food", "price"]
    with pytest.raises(ValueError, match="more than 3"):
        Lexicon.of(table, 3)
    df = spark.createDataFrame([(1, "good food"), (2, None), (3, "")], "id int, `a text` string")
    got = {r.id: r for r in phrase_labels(df, "a text", lexicon).collect()}
    assert got[1].food_pos == 1.0 and got[2].confidence == 0.3 and len(got[1]) == 2 + 3 + 4
    assert phrase_labels(df.limit(0), "a text", lexicon).count() == 0 and phrase_labels(df, "a text", Lexicon([])).count() == 3
    hits = {(r.id, r.phrase): r.n for r in phrase_hits(spark.createDataFrame([(1, "Good good, very good"), (2, None)], "id int, t string"), "id", "t", lexicon).collect()}
    assert hits == {(1, "good"): 2, (1, "very good"): 1}


def test_each_phrase_for_itself(spark):
    """Phrases that overlap each other count in full, short ones within words too; keys stay whole beside a null."""
    texts = {2**60 + 1: "Ab ab ab cd ab cd", None: "xab ΣΑΣ", 3: None, 4: ""}
    phrases = [("ab cd", "even"), ("ab ab", "even"), ("ab", "odd"), ("b", "odd"), ("σας", "odd"), ("ΣΑΣ", "odd")]
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    hits = phrase_hits(df, "id", "t", Lexicon(phrases), apart=True).collect()
    low = {i: (t or "").replace("Σ", "σ").lower() for i, t in texts.items()}
    want = {(i, q, k, low[i].count(q)) for i in texts for p, k in phrases if (q := p.replace("Σ", "σ").lower()) in low[i]}
    assert {tuple(r) for r in hits} == want and len(hits) == len(want) == 7


values = st.recursive(st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.floats(allow_nan=False, allow_infinity=False, width=32) | st.text(st.characters(exclude_categories=["Cs"]), max_size=12), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("abé'\" ", max_size=4), x, max_size=3), max_leaves=6)


def test_literals(spark):
    cases: list[str] = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.dictionaries(st.text(st.characters(exclude_categories=["Cs"]), max_size=8), values, max_size=4))
    def more(x):
        cases.append(repr(x))

    more()
    cases += ["{'a': 'b',}", "{ 'a' :\n'b' }", "{'\\x41\\u00e9\\U0001F600\\101\\n': u'z'}", "{'a': +1_000., 'b': .5, 'c': (1, 2,)}", '{"it\'s": \'x"y\'}', "{'a':'1','a':'2'}", "{}", "{'k': '" + "y" * 50_000 + "'}"]
    broken = ["", "no", "{'a': 'b'", "{'a' 'b'}", "[1]", "{a: 1}", "{'a': 'b'} x", "{'a': 'b'}, {'c': 1}", "'a'", None]
    df = spark.createDataFrame(list(enumerate([*cases, *broken])), "i int, t string").repartition(4)
    got = {r.i: r.m for r in df.select("i", literal_map(F.col("t")).alias("m")).collect()}
    for i, text in enumerate(cases):
        want = ast.literal_eval(text)
        read = {k: v if isinstance(want.get(k), str) or v is None else json.loads(v) for k, v in got[i].items()}
        assert read == json.loads(json.dumps(want)), text
    assert all(got[len(cases) + i] is None for i in range(len(broken)))
