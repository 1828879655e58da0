"""The pipeline against the stages' brute-force versions, one after the other."""

import re

import numpy as np
import test_jaccard
import test_packing
import test_substring
from test_rows import base_counts

import corpus_pipeline
from terrafold.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def corpus():
    rng = np.random.default_rng(21)
    vocab = "river garden letter morning village winter bread silver teacher harbour quiet green walking along between stone window market children story northern evening light careful music".split()
    prose = lambda n: " ".join(rng.choice(vocab) + rng.choice(vocab) for _ in range(n))
    passage = prose(70)
    texts = {i: prose(int(rng.integers(60, 160))) + ("\n" + passage + " " + prose(20) if i % 3 == 0 else "") for i in range(30)}
    texts |= {100 + i: texts[i] for i in range(5)} | {200 + i: texts[i] + " more" for i in range(5)}
    return texts | {300: None, 301: "short", 302: "spam " * 200, 303: passage, 304: passage + " x", 305: passage[:-1] + "q"}


def test_stages(spark, tmp_path):
    texts = corpus()
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.rules(spark, df, "").collect()}
    verdicts = {r.doc_id: r.kept for r in quality.quality_rules(df).collect()}
    assert kept == {d for d in texts if verdicts[d]} and not kept & {d for d in texts if base_counts(texts[d])[-1]}
    assert {*range(30)} <= kept
    classes = test_jaccard.brute({d: texts[d] for d in kept}, 5, 80)
    unique = {d for d in kept if classes[d][1] == d}
    left = {}
    split = {d: WORD.findall(texts[d]) for d in unique}
    starts = {}
    for d in sorted(split):
        for i in range(len(split[d]) - 49):
            starts.setdefault(tuple(split[d][i : i + 50]), d)
    for d, ws in split.items():
        gone = {i + j for i in range(len(ws) - 49) if starts[tuple(ws[i : i + 50])] < d for j in range(50)}
        if len(gone) < len(ws):
            left[d] = " ".join(w for i, w in enumerate(ws) if i not in gone) if gone else texts[d]
    assert test_substring.brute(texts, 50)
    test_packing.check(corpus_pipeline.run(spark, str(tmp_path)).withColumn("ids", __import__("pyspark").sql.functions.lit(None)).collect(), left, 2048)
