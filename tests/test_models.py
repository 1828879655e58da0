"""Trees, clusters, quantiles, positions and the feature table against plain computations."""

import datetime
import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from terrafold.functions import keys
from terrafold.operators import clusters, feature_table, features, filters, positions, quantiles, summaries, trees

SCHEMA = "e string, m int, v double"


def months_of(n, first=202201):
    return [(first // 100 + (first % 100 - 1 + i) // 12) * 100 + (first % 100 - 1 + i) % 12 + 1 for i in range(n)]


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    rows = [(e, m, float(rng.integers(1, 100))) for e, n in (("a", 30), ("b", 14), ("c", 2), ("d", 1)) for m in months_of(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def features_of(past, month):
    n, lag = month % 100, lambda k: past[min(k, len(past)) - 1]
    return [float(n), math.sin(2 * math.pi * n / 12), math.cos(2 * math.pi * n / 12), *(lag(k) for k in (1, 2, 3, 12)), sum(past[:3]) / len(past[:3])]


def test_history_rows(spark, series):
    df, rows = series
    got = {(r.e, r.m): [r[c] for c in trees.FEATURES] for r in trees.history_rows(df, "e", "m", "v").collect()}
    want = {}
    for i, (e, m, _) in enumerate(rows):
        past = [v for x, _, v in rows[:i] if x == e][::-1]
        if past:
            want[e, m] = features_of(past, m)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k], rtol=0, atol=1e-12) for k in want)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_forecast_is_the_plain_loop(spark, series, kind):
    df, rows = series
    params = {"numTrees": 5, "maxDepth": 3} if kind == "forest" else {"maxIter": 3, "maxDepth": 2}
    model = trees.fit(trees.history_rows(df, "e", "m", "v"), "v", kind, params)
    got = {(r.e, r.horizon): (r.m, r.forecast) for r in trees.forecast(df, "e", "m", "v", model, 12, low=20.0, high=70.0).collect()}
    want = {}
    for e in "abcd":
        past, month = [v for x, _, v in rows if x == e][::-1][:12], max(m for x, m, _ in rows if x == e)
        for h in range(1, 13):
            month = months_of(2, month)[1]
            new = min(max(model.stages[1].predict(Vectors.dense(features_of(past, month))), 20.0), 70.0)
            want[e, h] = (month, new)
            past = [new, *past][:12]
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_search_in_order_of_time(spark, series):
    rows = trees.history_rows(series[0], "e", "m", "v")
    blocks = trees.time_blocks(rows, "m", 2).groupBy("block").agg(F.min("m").alias("a"), F.max("m").alias("b")).orderBy("block").collect()
    assert [r.block for r in blocks] == [0, 1, 2] and all(x.b < y.a for x, y in zip(blocks, blocks[1:]))
    scores = trees.search(rows, "m", "v", "boosted", [{"maxIter": 1, "maxDepth": 1}, {"maxIter": 4, "maxDepth": 3}], 2)
    found = scores.collect()
    assert [(r.fold, r.n > 0, r.rmse >= r.mae) for r in found] == [(1, True, True), (2, True, True)] * 2
    means = {}
    for r in found:
        means.setdefault(r.params, []).append(r.rmse)
    assert trees.chosen(scores) in ({"maxIter": 1, "maxDepth": 1}, {"maxIter": 4, "maxDepth": 3})
    best = min(means, key=lambda p: sum(means[p]))
    assert str(trees.chosen(scores)["maxIter"]) in best


def test_cluster_scores(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 1, (n, 3)) for c, n in ((0, 40), (4, 25), (9, 10))])
    label = np.repeat([0, 1, 2], [40, 25, 10])
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(label, x)] + [(None, [1.0] * 3), (1, None)], "label int, x array<double>")
    centres = [x[label == i].mean(axis=0) for i in range(3)]
    within = sum(((x[label == i] - centres[i]) ** 2).sum() for i in range(3))
    between = sum((label == i).sum() * ((centres[i] - x.mean(axis=0)) ** 2).sum() for i in range(3))
    spread = [np.sqrt(((x[label == i] - centres[i]) ** 2).sum(axis=1)).mean() for i in range(3)]
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i) for i in range(3)])
    r = clusters.scores(df, "label", "x").first()
    assert (r.n, r.k) == (75, 3) and np.allclose([r.inertia, r.calinski_harabasz, r.davies_bouldin], [within, between / 2 / (within / 72), db])
    one = clusters.scores(df.filter("label = 1"), "label", "x").first()
    assert (one.n, one.k, one.calinski_harabasz, one.davies_bouldin) == (25, 1, None, None)
    assert clusters.scores(df.limit(0), "label", "x").first().n == 0
    from pyspark.ml.functions import array_to_vector

    points = df.dropna().select(array_to_vector("x").alias("f")).cache()
    costs = [clusters.best_kmeans(points, "f", 3, starts).summary.trainingCost for starts in (1, 6)]
    assert costs[1] <= costs[0] and abs(costs[1] - within) < 0.2 * within
    assert clusters.silhouette(df.dropna(), "label", "x") > 0.6


def test_sketches(spark):
    rng = np.random.default_rng(4)
    values = np.round(rng.lognormal(3, 2, 60_000), 3)
    entity, month = rng.integers(0, 2, len(values)), rng.integers(0, 9, len(values))
    df = spark.createDataFrame([(int(e), int(m), float(v)) for e, m, v in zip(entity, month, values)] + [(5, 0, None)], "e int, m int, v double").repartition(8)
    at = {"p5": 0.05, "p33": 0.33, "p50": 0.5, "p66": 0.66, "p99": 0.99}
    by_month = quantiles.sketched(df, ["e", "m"], "v", where=F.col("m") < 8)
    got = {r.e: r for r in quantiles.quantiles(quantiles.merged(by_month, ["e"]), at).collect()}
    assert (got[5].n, got[5].p50) == (0, None)
    for e in (0, 1):
        own = np.sort(values[(entity == e) & (month < 8)])
        assert got[e].n == len(own) > quantiles.K
        for name, q in at.items():
            low, high = np.searchsorted(own, got[e][name], "left"), np.searchsorted(own, got[e][name], "right")
            assert low / len(own) - 0.004 <= q <= high / len(own) + 0.004
    few = {r.e: r for r in quantiles.quantiles(quantiles.sketched(df.filter("m = 8 and v < 2"), ["e"], "v"), at).collect()}
    for e in (0, 1):  # no more values than a sketch keeps
        own = np.sort(values[(entity == e) & (month == 8) & (values < 2)])
        assert [few[e][name] for name in at] == [own[math.ceil(q * len(own)) - 1] for q in at.values()]


def test_exact_quantiles_by_key(spark):
    """Keys with more values than a sketch keeps, and few, tied, no and null ones; sketches that are far off change nothing."""
    rng = np.random.default_rng(5)
    own = {1: rng.permutation(30_000).astype(float), 2: rng.integers(0, 3, 9000).astype(float), 3: np.array([2.0, 1.0]), None: rng.normal(size=5000), 4: np.zeros(0)}
    rows = [(e, 1, float(v)) for e, vs in own.items() for v in vs] + [(4, 1, None), (1, 1, float("nan")), (2, 0, 7.0)]
    df = spark.createDataFrame(rows, "e int, m int, `v` double").repartition(6)
    at = {"least": 0.0, "p5": 0.05, "p33": 0.33, "p50": 0.5, "p99": 0.99, "most": 1.0}
    want = {e: (len(v), *(np.sort(v)[max(math.ceil(round(q * len(v), 9)), 1) - 1] if len(v) else None for q in at.values())) for e, v in own.items()}
    off = quantiles.sketched(df.withColumn("v", F.when(F.col("e") == 1, F.lit(0.5) + F.col("v") % 7).otherwise(F.col("v"))), ["e"], "v", where=F.col("m") == 1)
    for sketches in (None, off):
        got = {r.e: tuple(r)[1:] for r in quantiles.exact_by(df, ["e"], "v", at, sketches, where=F.col("m") == 1).collect()}
        assert got == want
    total = quantiles.exact_by(df, [], "v", {"p50": 0.5}, where=F.col("e") == 1).collect()
    assert [tuple(r) for r in total] == [(30_000, 14_999.0)]


@pytest.mark.parametrize("kind", ["spread", "ties", "edge", "few", "none"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(6)
    values = {"spread": rng.normal(size=40_000), "ties": rng.integers(0, 4, 20_000).astype(float), "edge": np.repeat([1.0, 2.0], 6000), "few": np.array([3.0, 1.0, 2.0]), "none": np.zeros(0)}[kind]
    rows = [(float(v),) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "`a.b` double").repartition(6)
    at, own = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0], np.sort(values)
    got = quantiles.exact(df, {"a.b": at})
    assert got == {("a.b", q): (own[max(math.ceil(round(q * len(own), 9)), 1) - 1] if len(own) else None) for q in at}
    between = quantiles.exact(df, {"a.b": at}, between=True)
    assert all(between["a.b", q] is None if not len(own) else math.isclose(between["a.b", q], np.percentile(own, 100 * q), rel_tol=1e-9, abs_tol=1e-12) for q in at)


def test_positions(spark):
    rng = np.random.default_rng(7)
    rows = [(None if rng.random() < 0.1 else int(rng.integers(0, 40)), i) for i in range(2000)] + [(7, -i) for i in range(1, 3000)]
    df = spark.createDataFrame(rows, "k int, i long").repartition(9)
    order = [F.col("k").desc_nulls_first(), F.col("i")]
    got = [(r.k, r.i) for r in positions.positions(df, order, "p").orderBy("p").collect()]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))
    assert sorted(r.p for r in positions.positions(df, [F.col("k")], "p").collect()) == list(range(len(rows)))
    split = positions.row_split(df, order, {"train": 0.7, "valid": 0.15, "test": 0.15}).groupBy("split").count().collect()
    n = len(rows)
    assert {r.split: r["count"] for r in split} == {"train": int(n * 0.7), "valid": int(n * 0.85) - int(n * 0.7), "test": n - int(n * 0.85)}
    assert positions.positions(df.limit(0), order).count() == 0
    stray = spark.createDataFrame([("a",), *((f"https://x/{i:05d}",) for i in range(500)), (None,)], "k string")
    assert [r.k for r in keys.surrogate_keys(stray, "k", "sk").orderBy("sk").collect()] == [None, "a", *(f"https://x/{i:05d}" for i in range(500))]
    assert {r.sk for r in keys.surrogate_keys(stray, "k", "sk").collect()} == set(range(1, 503))


def test_feature_table_parts(spark):
    rows = [("a", 202401, 0.5, 10), ("a", 202402, 0.2, 0), ("a", 202404, 0.4, 30), ("b", 202402, 0.1, 5)]
    df = spark.createDataFrame(rows, "entity string, year_month int, s double, n int")
    got = {(r.entity, r.year_month): r for r in df.withColumns({"change": feature_table.polarity_change("s")} | feature_table.lagged(df, "n", "n", (1, 3))).collect()}
    assert [round(got["a", m].change, 9) for m in (202401, 202402, 202404)] == [0.0, -0.3, 0.2] and got["b", 202402].change == 0.0
    assert got["a", 202404].n_lag_1 == 0 and got["a", 202404].n_rolling_3m == 5.0 and got["a", 202404].n_momentum is None
    growth = {r.year_month: r.growth for r in features.clipped_growth(df.filter("entity = 'a'"), "entity", "year_month", "n").collect()}
    assert growth == {202401: 0.0, 202402: -1.0, 202404: 0.0}
    posts = spark.createDataFrame([("a", 202401, 1, 1, 10, 1, 1, 1), ("a", 202401, 2, 1, 20, 1, 1, 1), (None, 202401, 3, 1, 1, 1, 1, 1)], "entity string, year_month int, post int, author int, likes long, saves long, shares long, comments long")
    (r,) = feature_table.post_months(posts).collect()
    assert (r.total_posts, r.unique_authors, r.avg_likes_per_post, r.sum_likes, r.engagement_score, r.viral_post_ratio) == (2, 1, 15.0, 30, 36, 0.0)
    wave = spark.range(1).select(*(c.alias(n) for n, c in feature_table.harmonics(F.lit(3)).items())).first()
    assert np.allclose(list(wave), [1, 0, 0, -1], atol=1e-12)


def test_months_and_odd_names(spark):
    days = [datetime.date(2023, 12, 31), datetime.date(2024, 1, 1), datetime.date(2024, 12, 31), datetime.date(2025, 1, 1), datetime.date(2024, 2, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    count = lambda **k: filters.of_month(df, "d", **k).count()
    assert (count(), count(year=2024), count(year=2024, month=12), count(year=2024, month=2), count(month=12), count(month=1)) == (5, 3, 1, 1, 2, 2)
    odd = spark.createDataFrame([(1, 2.0, "x"), (3, None, None)], "`a.b` int, `a__n` double, `c``d` string")
    assert {r.column_name: (r.n, r.n_null, r.max) for r in summaries.describe(odd).collect()} == {"a.b": (2, 0, 3.0), "a__n": (1, 1, 2.0)}
    assert {r.column_name: r.n_null for r in summaries.profile_columns(odd).collect()} == {"a.b": 0, "a__n": 1, "c`d": 1}
    assert summaries.sum_numbers(odd, ["c`d"]).count() == 2 and {r.column_name: r.n_filled for r in summaries.load_summary(odd, ["a.b", "c`d"]).collect()} == {"a.b": 2, "c`d": 1}
