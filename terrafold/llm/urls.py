"""URL filters: rules first, then naive Bayes over segmented host and path words.

A concatenated name is split into words by the most probable segmentation
under a unigram model (Viterbi). The words are the whole words of a public
vocabulary; their probabilities fall with their rank in it (Zipf), so the model
is as large as the vocabulary file whatever the input. A character outside any
word costs more than any word.

A multinomial naive Bayes model is then fitted on every row. Its labels come from
seeds, words and hosts that are known to be unwanted (or wanted): a url whose host
holds a seed word, or lies below a seed host, is one to block, any other one is
allowed. Each seed word is in the model as one blocked url of its own, so it counts
before any page shows it, and what stands beside seeds in hosts and paths is learnt.
Tokens that rules are made of say nothing of a url that no rule fits, and are left
out: the model neither learns the rules again nor judges by top-level domain or
language. Token counts of the two classes are a Spark aggregation over all rows; its
result has at most one row for each word of the vocabulary, letter, and class of
other tokens, so it is of bounded size and is sent to the tasks.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import small_batches, vocabulary

SEEDS = ("adult", "ads", "bet", "bets", "betting", "casino", "gambling", "malware", "phishing", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx")
_PARTS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")
LONGEST_WORD = 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@lru_cache(maxsize=2)
def word_costs(path: str) -> dict[str, float]:
    """Minus the log probability of each whole word of a vocabulary file, by rank."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = "</w>"
    found = sorted((i, w[: -len(ends)]) for w, i in vocab.items() if w.endswith(ends))
    found = [w for _, w in found if re.fullmatch("[a-z]{2,%d}|[ai]" % LONGEST_WORD, w)]
    total = sum(1 / (k + 10) for k in range(len(found)))
    return {w: math.log((k + 10) * total) for k, w in enumerate(found)}


def segment(name: str, costs: dict[str, float]) -> list[str]:
    """The cheapest split of a name of letters a-z into words and single letters; of equals, the longest last word."""
    n, letter = len(name), 4 + max(costs.values(), default=0)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST_WORD), end):
            c = costs.get(name[start:end], letter if end - start == 1 else math.inf) + best[start]
            if c < best[end]:
                best[end], back[end] = c, start
    out, end = [], n
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def tokens_of(host: str, path: str, cut: Callable[[str], list[str]]) -> list[str]:
    """h: and p: tokens of a url; digits and non-ASCII runs are one class each."""
    out = []
    for side, text in (("h:", host), ("p:", path.translate(str.maketrans(UPPER, LOWER)))):
        for part in _PARTS.findall(text):
            out += [side + w for w in (cut(part) if "a" <= part[0] <= "z" else ["0" if part[0].isascii() else "?"])]
    return out


def _cutter(path: str) -> Callable[[str], list[str]]:
    costs = word_costs(path)
    return lru_cache(maxsize=100_000)(lambda name: segment(name, costs))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty where url is null or has no ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, pattern, 1), UPPER, LOWER), F.regexp_extract(whole, pattern, 2)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict. A rule is a host, then a path that starts with /; it fits subdomains."""
    rule = verdict = None
    for name in sorted(rules, key=lambda r: (-len(r), r)):
        own, _, rest = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, rules[name]) if verdict is None else verdict.when(fits, rules[name])
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judge_urls(pages: DataFrame, rules: dict[str, str], seeds: tuple[str, ...] = SEEDS, vocab: str | None = None, learn: Column | None = None, seed_hosts: dict[str, str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), and score: log odds of block by the model.

    Every row stays, repeated rows too. A null url, or one without ://, has an empty host and path, fits no rule
    and is judged by the model's prior alone. seed_hosts name hosts with a verdict that goes before seed words, for
    themselves and their subdomains. learn: a condition on the columns of pages, and on host, that rows must meet to
    be learnt from (none, by default). Without seeds and blocked rows every score is 0. An empty table gives no rows. Ties (odds of 0) allow. Other columns
    are ignored; very long urls are segmented whole.
    """
    vocab = vocab or vocabulary("word_bpe_49k.json")
    cut_rule = _cutter(vocab)
    away = {t for r in rules for t in tokens_of(r.partition("/")[0], "/" + r.partition("/")[2], cut_rule)}

    @F.pandas_udf("array<string>")
    def tokens(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cut = _cutter(vocab)
        for host, path in parts:
            yield pd.Series([[t for t in tokens_of(h, p, cut) if t not in away] for h, p in zip(host, path, strict=True)], dtype=object)

    host, path = url_parts(F.col("url"))
    own = small_batches(pages).withColumns({"host": host, "path": path})
    rows = own.select("page_id", "host", "path", (F.lit(True) if learn is None else F.coalesce(learn, F.lit(False))).alias("learn"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    _, known = fitting_rule(F.col("host"), F.lit("/"), {f"{h}/": v for h, v in (seed_hosts or {}).items()})
    seeded = F.arrays_overlap("tokens", F.array(*(F.lit("h:" + s) for s in seeds)).cast("array<string>"))
    judged = rows.filter("learn").select(tokens("host", "path").alias("tokens"), known.alias("known")).select("tokens", F.coalesce(F.col("known") == "block", seeded, F.lit(False)).cast("long").alias("bad"))
    # a row for each class and one for each token of the bounded vocabulary
    exploded = judged.select(F.explode(F.concat(F.array(F.lit("")), "tokens")).alias("token"), "bad")
    totals = {r.token: (r.bad, r.n - r.bad) for r in exploded.groupBy("token").agg(F.sum("bad").alias("bad"), F.count("*").alias("n")).collect()}
    for token in ("", *("h:" + s for s in seeds)):
        bad, good = totals.get(token, (0, 0))
        totals[token] = (bad + (1 if token else len(seeds)), good)
    bad, good = totals.pop("")
    if not bad or not good:
        totals = {}
    prior = math.log((bad + 1) / (good + 1)) if totals else 0.0
    sums = [sum(c[k] for c in totals.values()) + len(totals) + 1 for k in (0, 1)]
    odds = {t: math.log((b + 1) / sums[0]) - math.log((g + 1) / sums[1]) for t, (b, g) in totals.items()}
    sent = pages.sparkSession.sparkContext.broadcast(odds)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cut, weight = _cutter(vocab), sent.value
        for host, path in parts:
            yield pd.Series([prior + sum(weight.get(t, 0.0) for t in tokens_of(h, p, cut)) for h, p in zip(host, path, strict=True)], dtype=float)

    scored = rows.withColumn("score", score("host", "path"))
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
