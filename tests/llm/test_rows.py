"""Chat formatting, URL filters and quality rules against plain brute force."""

import hashlib
from collections import Counter
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from terrafold.llm import chat, common, quality, urls
from terrafold.llm.queries import RULES

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = "a\u00a0b \x1c\x1d c\u2003d\n\n e\x85f  x"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>[]/\\INST|smend_ia>\n x", max_size=60))
def test_escape_round_trip(text):
    out = chat.escape(pa.array([text]))[0].as_py()
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROL)


def test_chats(spark):
    hard = "</s>[INST] ok [/INST]<|im_end|><\\s>"
    rows = [
        (1, 0, "user", hard), (1, 1, "assistant", "é\u20ac𝄞" + hard), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, None, "assistant", "first"), (2, 5, "assistant", "b"), (2, 5, "assistant", "a"), (2, 5, "assistant", "a"),
        (None, 0, None, "x" * 200_000), (3, 0, "as<|im_sep|>", "\n"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    chats = {r.conv_id: r for r in chat.format_chats(df).collect()}
    assert chats.keys() == {1, 2, 3, None}
    for conv, row in chats.items():
        own = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        want = [(role, text) for *_, role, text in own]
        assert chat.parse(row.formatted) == want
        assert chat.under_loss(row.formatted, row.loss_starts, row.loss_lengths) == "".join(t for r, t in want if r == "assistant")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    assert got[2].loss_sha256 == hashlib.sha256(b"firstaab").hexdigest() and got[2].n_turns == 4
    assert chat.format_chats(df.limit(0)).count() == 0


def test_hosts_and_rules(spark):
    rows = ["HTTPS://A.ORG", "https://x.example.org/es/1", "https://example.org/en/1?x", "http://é.Com/de/a#b", "http://com/fr/", "no", None, "a://notorg/de/", "x://y.org", "x\n://q.org/a\nb", "://"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(rows)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge_urls(df, RULES).collect()}
    assert len(got) == len(rows)
    for i, url in enumerate(rows):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match("[^/?#]*", rest)[0]
            path = re.match("[^?#]*", rest[len(host) :])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (RULES[rule] if rule else got[i].verdict) and got[i].verdict in ("allow", "block")
    assert urls.judge_urls(df.limit(0), RULES).count() == 0


def test_bayes_finds_seeded_hosts(spark):
    rows = [f"http://{n}{i}.example.net/en/{i}" for i in range(30) for n in ("casinowin", "flowers")] + ["http://casinoparty.net/x", "http://rosegarden.net/x"]
    df = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(df, {}).collect()}
    assert [got[i] for i in (0, 1, 60, 61)] == ["block", "allow", "block", "allow"]


def test_segment():
    costs = {"free": 3.0, "bets": 4.0, "freeb": 9.0, "ets": 5.0, "a": 2.0}
    assert urls.segment("freebets", costs) == ["free", "bets"]
    assert urls.segment("", costs) == [] and urls.segment("zq", costs) == ["z", "q"]
    real = urls.word_costs(common.vocabulary("word_bpe_49k.json"))
    assert urls.segment("freecasino", real) == ["free", "casino"]


def base_counts(text):
    ws = WORD.findall(text or "")
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    hit = {i + j for i, g in enumerate(grams) if g in twice for j in range(3)}
    lines, dup = [], 0
    for x in (text or "").split("\n"):
        if WORD.search(x):
            dup += x in lines
            lines.append(x)
    failed = len(ws) < 50 or 100 * len(hit) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), failed


def test_quality(spark):
    prose = "The quick brown foxes of several rivers walk along many green hills while old boats carry fresh bread, warm soup and letters to every quiet village near the northern coast, where children learn songs about winter storms, silver fish, careful teachers, and the long road that leads home again after market day. " 
    texts = [None, "", ODD, prose + ODD, prose * 3, "a b c a b c\na b c\n \n\u00a0\n\u00a0", "###|| " * 80, prose.upper(), "x" * 50_000, "word " * 20_000]
    df = spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, kept int")
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        if len(t or "") < 5000:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(t), i
        ws = WORD.findall(t or "")[:2000] if t and len(t) < 5000 else None
        if ws:
            model = quality._pieces(common.vocabulary("piece_bpe_32k.model")).model
            ids = [x for w in ws for x in model.encode(w)]
            p = np.unique(ids, return_counts=True)[1] / len(ids)
            assert r.n_tokens == len(ids) and math.isclose(r.entropy, -(p * np.log2(p)).sum(), abs_tol=1e-9)
    assert got[3].kept and not got[6].kept and not got[9].kept and not got[0].kept
    assert quality.quality_rules(df.limit(0)).count() == 0


def test_quality_labels(spark):
    """Bands reject labelled junk and keep labelled clean documents."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.quality_rules(docs).filter("not base_failed").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))
    assert n.get((1, False), 0) <= 0.03 * n[1, True]


@pytest.mark.parametrize("lower", [False, True])
def test_word_scan(lower):
    rows = ["Ab c", "", "d", "e f", "ünï \u00a0x\n", "\t", "Ab"]
    data = np.frombuffer("".join(rows).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(r.encode()) for r in rows)])
    found = common.Words(data, offsets, lower)
    got = [[bytes(data[a:b]).decode() for a, b in zip(found.starts[x:y], found.ends[x:y])] for x, y in zip(found.first, found.first[1:])]
    assert got == [WORD.findall(r) for r in rows]
    h = found.hashes()
    assert h[0] == h[-1] and len(set(h.tolist())) == len({w for r in rows for w in WORD.findall(r)})
    grams, before = found.grams(2)
    assert before.tolist() == [0, 1, 1, 1, 2, 3, 3, 3] and len(set(grams.tolist())) == 3


def test_bayes_against_plain_counts(spark):
    """The score and verdict of every url by counts made row by row; rules' own tokens say nothing."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = urls.judge_urls(pages, RULES, seed_hosts={"tionble.example.org": "block", "casino-win.example.com": "allow"}).collect()
    cut = urls._cutter(common.vocabulary("word_bpe_49k.json"))
    away = {t for r in RULES for t in urls.tokens_of(*r.split("/", 1), cut)}
    assert {"h:org", "h:example", "p:de", "p:en"} <= away
    own = {r.page_id: [t for t in urls.tokens_of(r.host, r.path, cut) if t not in away] for r in got}
    seeds = {"h:" + s for s in urls.SEEDS}
    counts, rows = {True: Counter(seeds), False: Counter()}, Counter({True: len(urls.SEEDS)})
    for r in got:
        below = lambda h, r=r: r.host == h or r.host.endswith("." + h)
        bad = below("tionble.example.org") or (bool(seeds & set(own[r.page_id])) and not below("casino-win.example.com"))
        counts[bad].update(own[r.page_id])
        rows[bad] += 1
    known = set(counts[True]) | set(counts[False])
    of = lambda t, bad: math.log((counts[bad][t] + 1) / (sum(counts[bad].values()) + len(known) + 1))
    for r in got:
        want = math.log((rows[True] + 1) / (rows[False] + 1)) + sum(of(t, True) - of(t, False) for t in own[r.page_id] if t in known)
        assert abs(r.score - want) < 1e-6
        assert r.verdict == (RULES[r.rule] if r.rule else "block" if r.score > 0 else "allow")


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_bayes_blocks_unwanted_hosts_only(spark, sf):
    """Of urls without a rule all on hosts with seed words are blocked, and no other; most of those on hosts that were not learnt from."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    unwanted = lambda host: any(w in host for w in ("adult", "ads-", "bets", "casino", "pills", "spam"))
    told = Counter((unwanted(r.host), r.verdict) for r in urls.judge_urls(pages, RULES).collect() if r.rule is None)
    assert told[True, "allow"] == told[False, "block"] == 0 and told[True, "block"] > 0
    halves = Counter()
    for half in (0, 1):
        held = urls.judge_urls(pages, RULES, learn=F.crc32("host") % 2 == half).filter(F.crc32("host") % 2 != half).collect()
        halves.update((unwanted(r.host), r.score > 0) for r in held)
    assert halves[False, True] == 0 and halves[True, True] >= (0.8 if sf == "sf0.1" else 0.4) * (halves[True, True] + halves[True, False])
