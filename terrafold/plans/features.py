"""Queries on entity-by-month features, reports, segments, forecasts and data quality.

Nations stand for provinces, orders for posts, customers for authors and lines for reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.clean import smoothed_ratio
from terrafold.operators import analytics, dq, features, forecast, joins
from terrafold.plans.registry import cents, moved, query, table
from terrafold.plans.relational import lines

_POSTS = """
WITH posts AS (SELECT n_name, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym, o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT *, quantile_disc(cents, 0.9) OVER (PARTITION BY n_name, ym) AS p90 FROM posts),
eng AS (SELECT n_name, ym, count(DISTINCT o_orderkey) AS n_posts, count(DISTINCT o_custkey) AS n_authors, CAST(sum(cents) AS BIGINT) AS total, CAST(sum(cents) AS BIGINT) / count(cents) AS avg_value,
  quantile_disc(cents, 0.5) AS median, max(p90) AS p90, count(*) FILTER (cents > p90) / count(*) AS hot_ratio FROM p GROUP BY n_name, ym)
"""
_RANK = "percent_rank() OVER (PARTITION BY ym ORDER BY {0} NULLS FIRST)"
_HOT = ", hot AS (SELECT *, round(greatest(0.0e0, least(1.0e0, " + " + ".join(f"{_RANK.format(m)} * {w}e0" for m, w in features.INDEX_WEIGHTS.items()) + ")), 9) AS hotness FROM eng)"
_W = "OVER (PARTITION BY n_name ORDER BY ym"
_LAG = f""", lagged AS (SELECT n_name, ym, total, lag(total, 1) {_W}) AS lag_1, lag(total, 2) {_W}) AS lag_2, lag(total, 3) {_W}) AS lag_3, lag(total, 12) {_W}) AS lag_12,
  CAST(sum(total) {_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT) / nullif(count(total) {_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS mean_3 FROM eng)"""
_MOVES = "lag_1 - lag_3 AS momentum, CASE WHEN lag_1 > 0 THEN (total - lag_1) / lag_1 ELSE 0.0 END AS growth"


def posts(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    both = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return both.select("n_name", features.year_month(F.col("o_orderdate")).alias("ym"), "o_orderkey", "o_custkey", cents("o_totalprice").alias("cents"))


def months(spark: SparkSession, sf: str) -> DataFrame:
    return features.engagement(posts(spark, sf), "n_name", "ym", "o_orderkey", "o_custkey", "cents")


@query(_POSTS + "SELECT * FROM eng")
def nation_month_engagement(spark: SparkSession, sf: str) -> DataFrame:
    return months(spark, sf)


@query(_POSTS + _HOT + " SELECT n_name, ym, n_posts, total, hotness FROM hot")
def hot_index_nation_month(spark: SparkSession, sf: str) -> DataFrame:
    return features.rank_index(months(spark, sf), "ym", features.INDEX_WEIGHTS).select("n_name", "ym", "n_posts", "total", F.round("hotness", 9).alias("hotness"))


@query(_POSTS + _LAG + f" SELECT *, {_MOVES} FROM lagged")
def lag_rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.lags(months(spark, sf).select("n_name", "ym", "total"), "n_name", "ym", "total")


@query(_POSTS + f" SELECT n_name, ym, total, coalesce(round(stddev(total) {_W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6), 0.0) AS stddev_3 FROM eng".replace("total)", "n_posts)").replace("ym, total,", "ym, n_posts,"))
def rolling_spread(spark: SparkSession, sf: str) -> DataFrame:
    return features.rolling_stddev(months(spark, sf).select("n_name", "ym", "n_posts"), "n_name", "ym", "n_posts")


@query("""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(round(value * 100) AS BIGINT)) AS cents FROM events GROUP BY ALL)
SELECT event_type, day, CAST(cents AS BIGINT) AS cents, CAST(sum(cents) OVER w AS BIGINT) / count(cents) OVER w AS mean_own_3 FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def rolling_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    daily = table(spark, sf, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.sum(cents("value")).alias("cents"))
    return features.rolling_inclusive(daily, "event_type", "day", "cents")


@query(_POSTS + """, f AS (SELECT n_name, ym, total, list(total) OVER (PARTITION BY n_name ORDER BY ym ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS total_window FROM eng)
SELECT n_name, ym, total, total_window FROM f WHERE len(total_window) = 3""")
def sequence_windows(spark: SparkSession, sf: str) -> DataFrame:
    return features.sequences(months(spark, sf).select("n_name", "ym", "total"), "n_name", "ym", ["total"], 3)


@query(_POSTS + ", n AS (SELECT n_name, count(DISTINCT ym) AS n FROM eng GROUP BY 1) SELECT CAST(l AS INTEGER) AS length, CAST(sum(greatest(n - l, 0)) AS BIGINT) AS n_sequences, count(*) AS n_entities FROM n, (VALUES (3), (4), (5)) v(l) GROUP BY l")
def sequence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.sequence_counts(months(spark, sf), "n_name", "ym")


@query("""
WITH m AS (SELECT o_custkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym, count(*) AS n FROM orders GROUP BY ALL),
s AS (SELECT o_custkey, min(ym) AS a, max(ym) AS b FROM m GROUP BY 1),
g AS (SELECT o_custkey, CAST(year(d) * 100 + month(d) AS INTEGER) AS ym FROM (SELECT o_custkey, unnest(generate_series(make_date(a // 100, a % 100, 1), make_date(b // 100, b % 100, 1), INTERVAL 1 MONTH)) AS d FROM s))
SELECT g.o_custkey, g.ym, m.n FROM g LEFT JOIN m ON g.o_custkey = m.o_custkey AND g.ym = m.ym""")
def dense_months(spark: SparkSession, sf: str) -> DataFrame:
    sparse = posts(spark, sf).groupBy("o_custkey", "ym").agg(F.count("*").alias("n"))
    return features.dense_months(sparse, "o_custkey", "ym")


_REVIEWS = """
reviews AS (SELECT n_name, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym, l_quantity / 5 AS score, CAST(s_nationkey AS VARCHAR) AS country, l_returnflag AS kind, l_quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
q AS (SELECT n_name, ym, count(*) AS n_reviews, sum(CAST(l_quantity AS BIGINT)) / count(l_quantity) AS avg_score, round(stddev(l_quantity), 6) AS sd_score, count(*) FILTER (l_quantity >= 40) / count(*) AS high_ratio,
  count(*) FILTER (l_quantity < 10) / count(*) AS low_ratio, count(DISTINCT country) AS n_countries, count(*) FILTER (country = '3') / count(*) AS domestic_ratio, count(*) FILTER (kind LIKE '%A%') / count(*) AS kind_a_ratio FROM reviews GROUP BY n_name, ym)
"""


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    l, s, n = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    both = l.join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey)
    rows = both.select("n_name", features.year_month(F.col("l_shipdate")).alias("ym"), "l_quantity", F.col("s_nationkey").cast("string").alias("country"), F.col("l_returnflag").alias("kind"))
    return features.quality(rows, ["n_name", "ym"], "l_quantity", "country", "kind", "3", high=40, low=10)


@query("WITH " + _REVIEWS + "SELECT * FROM q")
def review_month_quality(spark: SparkSession, sf: str) -> DataFrame:
    return reviews(spark, sf)


@query("""
SELECT event_type, CASE WHEN sum(CAST(value > 10 OR value < 5 AS INTEGER)) >= 1 THEN (sum(CAST(value > 10 AS INTEGER)) - sum(CAST(value < 5 AS INTEGER))) / sum(CAST(value > 10 OR value < 5 AS INTEGER)) END AS net_sentiment FROM events GROUP BY event_type""")
def net_sentiment_guarded(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    return features.net_sentiment(table(spark, sf, "events"), "event_type", (v > 10).cast("int"), (v < 5).cast("int"), ((v > 10) | (v < 5)).cast("int"))


@query(_POSTS + _HOT + _LAG + ", " + _REVIEWS + f"""
SELECT h.n_name, h.ym, h.n_posts, h.n_authors, h.total, h.avg_value, h.median, h.p90, h.hot_ratio, h.hotness, lag_1, lag_2, lag_3, lag_12, mean_3, {_MOVES.replace('total', 'h.total')},
coalesce(n_reviews, 0) AS n_reviews, coalesce(avg_score, 0.0) AS avg_score, coalesce(high_ratio, 0.0) AS high_ratio, h.n_posts / (coalesce(n_reviews, 0) + 1.0e0) AS posts_per_review,
round(sin((h.ym % 100) * (2 * 3.141592653589793e0 / 12)), 6) + 0.0 AS sin_month, round(cos((h.ym % 100) * (2 * 3.141592653589793e0 / 12)), 6) + 0.0 AS cos_month, h.ym % 100 IN (1, 4, 6, 7, 8, 12) AS is_peak
FROM hot h JOIN lagged l ON h.n_name = l.n_name AND h.ym = l.ym LEFT JOIN q ON h.n_name = q.n_name AND h.ym = q.ym""")
def feature_table_nation_month(spark: SparkSession, sf: str) -> DataFrame:
    """The whole feature table: engagement, index, lags, review quality, ratios and season."""
    own = features.lags(features.rank_index(months(spark, sf), "ym", features.INDEX_WEIGHTS), "n_name", "ym", "total")
    both = own.join(reviews(spark, sf).select("n_name", "ym", "n_reviews", "avg_score", "high_ratio"), ["n_name", "ym"], "left").fillna(0, ["n_reviews", "avg_score", "high_ratio"])
    both = both.withColumn("hotness", F.round("hotness", 9))
    return features.season(both.withColumn("posts_per_review", smoothed_ratio(F.col("n_posts"), F.col("n_reviews"))), "ym")


@query("""
SELECT n_name, count(*) AS total, count(*) FILTER (l_returnflag = 'A') AS n_a, round(
 (CASE WHEN count(*) FILTER (l_returnflag = 'A') > 0 THEN -(count(*) FILTER (l_returnflag = 'A') / count(*)) * ln(count(*) FILTER (l_returnflag = 'A') / count(*)) ELSE 0 END)
 + (CASE WHEN count(*) FILTER (l_returnflag = 'N') > 0 THEN -(count(*) FILTER (l_returnflag = 'N') / count(*)) * ln(count(*) FILTER (l_returnflag = 'N') / count(*)) ELSE 0 END)
 + (CASE WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN -(count(*) FILTER (l_returnflag = 'R') / count(*)) * ln(count(*) FILTER (l_returnflag = 'R') / count(*)) ELSE 0 END), 6) AS entropy
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""")
def entropy_diversity(spark: SparkSession, sf: str) -> DataFrame:
    l, s, n = (table(spark, sf, t) for t in ("lineitem", "supplier", "nation"))
    own = lambda f: F.count_if(F.col("l_returnflag") == f).alias(f"n_{f.lower()}")
    counts = l.join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count("*").alias("total"), own("A"), own("N"), own("R"))
    return counts.select("n_name", "total", "n_a", F.round(features.entropy([F.col("n_a"), F.col("n_n"), F.col("n_r")], F.col("total")), 6).alias("entropy"))


@query("""
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS d, avg(c_nationkey) AS m2, stddev_pop(c_nationkey) AS d2 FROM customer)
SELECT c_custkey, greatest(abs((c_acctbal - m) / nullif(d, 0)), abs((c_nationkey - m2) / nullif(d2, 0)), 0.0) >= 3 AS is_outlier FROM customer, s""")
def zscore_outliers(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return features.zscores(c, ["c_acctbal", "c_nationkey"]).select("c_custkey", "is_outlier")


def _supplier_features(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem")
    counts = l.groupBy("l_suppkey").agg(F.count("*").alias("total"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.avg("l_extendedprice").alias("avg_price"))
    return counts.withColumns(forecast.cluster_features(counts, ["returned"], "total"))


@query()
def cluster_segments(spark: SparkSession, sf: str) -> DataFrame:
    found, _ = forecast.segments(_supplier_features(spark, sf), ["returned_ratio", "log_total", "avg_price"])
    return found


@query()
def cluster_names(spark: SparkSession, sf: str) -> DataFrame:
    found, silhouette = forecast.segments(_supplier_features(spark, sf), ["returned_ratio", "log_total", "avg_price"])
    return forecast.named_segments(found, "avg_price").withColumn("silhouette", F.lit(silhouette))


@query(_POSTS + """, t AS (SELECT *, quantile_cont(CASE WHEN ym < 199701 THEN total END, 0.99) OVER () AS top FROM eng),
x AS (SELECT n_name, ym, ln(1 + least(total, top)) AS x FROM t), s AS (SELECT quantile_cont(x, 0.5) AS mid, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS r FROM x WHERE ym < 199701)
SELECT n_name, ym, round((x - mid) / CASE WHEN r > 0 THEN r ELSE 1.0 END, 6) AS scaled FROM x, s""")
def clip_robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    own = months(spark, sf).select("n_name", "ym", "total")
    return features.robust_scale(own, "total", F.col("ym") < 199701).select("n_name", "ym", "scaled")


@query(_POSTS + """, f AS (SELECT n_name, total * 1.0e0 AS total, lag(total) OVER (PARTITION BY n_name ORDER BY ym) * 1.0e0 AS p FROM eng)
SELECT n_name, count(*) AS n, round(sqrt(avg((total - p) * (total - p))), 6) AS rmse, round(avg(abs(total - p)), 6) AS mae,
round(1 - sum((total - p) * (total - p)) / nullif(sum(total * total) - count(total) * avg(total) * avg(total), 0.0), 6) AS r2,
round(avg(CASE WHEN abs(total) + abs(p) > 0 THEN 2 * abs(total - p) / (abs(total) + abs(p)) ELSE 0 END), 6) AS smape, round(sum(abs(total - p)) / sum(abs(total)), 6) AS wape,
round(avg(CASE WHEN total > 0 THEN abs(total - p) / total END), 6) AS mape FROM (SELECT n_name, total / 1e8 AS total, p / 1e8 AS p FROM f) WHERE p IS NOT NULL GROUP BY n_name""")
def forecast_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The forecast of no change, in millions."""
    own = features.lags(months(spark, sf).select("n_name", "ym", "total"), "n_name", "ym", "total", (1, 3)).filter("lag_1 is not null")
    return analytics.forecast_metrics(own.select("n_name", (F.col("total") / 1e8).alias("a"), (F.col("lag_1") / 1e8).alias("p")), "a", "p", ["n_name"])


@query(_POSTS + """, m AS (SELECT n_name, CAST(sum(total) AS BIGINT) / count(total) AS v FROM eng GROUP BY 1), c AS (SELECT quantile_cont(v, 1.0 / 3) AS a, quantile_cont(v, 2.0 / 3) AS b FROM m),
t AS (SELECT n_name, CASE WHEN v <= a THEN 'low' WHEN v <= b THEN 'mid' ELSE 'high' END AS tier FROM m, c),
f AS (SELECT n_name, total / 1e8 AS a, lag(total) OVER (PARTITION BY n_name ORDER BY ym) / 1e8 AS p FROM eng)
SELECT tier, count(*) AS n, round(avg(CASE WHEN abs(a) + abs(p) > 0 THEN 2 * abs(a - p) / (abs(a) + abs(p)) ELSE 0 END), 6) AS smape, round(sum(abs(a - p)) / sum(abs(a)), 6) AS wape FROM f JOIN t USING (n_name) WHERE p IS NOT NULL GROUP BY tier""")
def tier_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the forecast of no change by tiers of nations."""
    own = months(spark, sf).select("n_name", "ym", "total")
    pairs = features.lags(own, "n_name", "ym", "total", (1, 3)).filter("lag_1 is not null").select("n_name", (F.col("total") / 1e8).alias("a"), (F.col("lag_1") / 1e8).alias("p"))
    return analytics.forecast_metrics(pairs.join(analytics.tiers(own, "n_name", "total"), "n_name"), "a", "p", ["tier"]).select("tier", "n", "smape", "wape")


@query(_POSTS + """, l AS (SELECT quantile_cont(total, 0.05) AS f FROM eng), a AS (SELECT n_name, greatest(quantile_cont(total, 0.5), max(f)) AS anchor FROM eng, l GROUP BY n_name)
SELECT n_name, ym, total, anchor, round(total / anchor, 6) AS relative FROM eng JOIN a USING (n_name)""")
def anchor_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return features.anchors(months(spark, sf).select("n_name", "ym", "total"), "n_name", "total")


@query(_POSTS + """, m AS (SELECT DISTINCT ym FROM eng), s AS (SELECT ym, row_number() OVER (ORDER BY ym) / (SELECT count(*) FROM m) AS x FROM m)
SELECT n_name, eng.ym, CASE WHEN x <= 0.75 THEN 'train' WHEN x <= 0.875 THEN 'valid' ELSE 'test' END AS split FROM eng JOIN s USING (ym)""")
def time_split(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.time_split(months(spark, sf), "ym").select("n_name", "ym", "split")


@query("WITH RECURSIVE" + _POSTS.replace("WITH", "", 1) + """, n AS (SELECT n_name, ym, total * 1.0e0 AS v, row_number() OVER (PARTITION BY n_name ORDER BY ym DESC) AS r FROM eng),
f AS (SELECT n_name, max(ym) AS base, 0 AS horizon, max(v) FILTER (r = 1) AS a, max(v) FILTER (r = 2) AS b, max(v) FILTER (r = 3) AS c, 0.0e0 AS was FROM n WHERE r <= 3 GROUP BY 1
  UNION ALL SELECT n_name, base, horizon + 1, CASE WHEN b IS NULL THEN 0.5e0 * a / 0.5e0 WHEN c IS NULL THEN (0.5e0 * a + 0.3e0 * b) / (0.5e0 + 0.3e0) ELSE (0.5e0 * a + 0.3e0 * b + 0.2e0 * c) / (0.5e0 + 0.3e0 + 0.2e0) END, a, b, a FROM f WHERE horizon < 12)
SELECT n_name, CAST((base // 100 * 12 + base % 100 + horizon - 1) // 12 * 100 + (base // 100 * 12 + base % 100 + horizon - 1) % 12 + 1 AS INTEGER) AS ym, horizon, a AS forecast, (a - was) / nullif(was, 0) * 100 AS growth_pct FROM f WHERE horizon > 0""")
def recursive_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return forecast.recursive(months(spark, sf), "n_name", "ym", "total")


@query()
def boosted_forecast(spark: SparkSession, sf: str) -> DataFrame:
    own = features.lags(months(spark, sf).select("n_name", "ym", "total"), "n_name", "ym", "total", (1, 2, 3)).dropna()
    split = analytics.time_split(own, "ym")
    found = forecast.boosted(split.filter("split = 'train'"), split.filter("split <> 'train'"), ["lag_1", "lag_2", "lag_3", "mean_3"], "total")
    return found.select("n_name", "ym", "total", F.round("prediction", 2).alias("predicted"))


_TOTALS = ", t AS (SELECT n_name, CAST(sum(n_posts) AS BIGINT) AS n_posts, CAST(sum(n_authors) AS BIGINT) AS n_authors FROM eng GROUP BY 1)"


@query(_POSTS + _TOTALS + """, s AS (SELECT n_name, n_posts, round(100 * (0.4e0 * (CASE WHEN max(n_posts) OVER () > min(n_posts) OVER () THEN (n_posts - min(n_posts) OVER ()) / (max(n_posts) OVER () - min(n_posts) OVER ()) ELSE 0 END)
  + 0.6e0 * ((n_authors % 7) / 7)), 4) AS score FROM t) SELECT n_name, n_posts, score FROM s ORDER BY score DESC, n_name LIMIT 10""")
def recommend_top_n(spark: SparkSession, sf: str) -> DataFrame:
    totals = months(spark, sf).groupBy("n_name").agg(F.sum("n_posts").alias("n_posts"), F.sum("n_authors").alias("n_authors")).withColumn("aspect", F.col("n_authors") % 7 / 7)
    return analytics.recommend(totals, "n_name", "n_posts", "aspect", 10).select("n_name", "n_posts", "score")


@query(_POSTS + " SELECT n_name, ym, total FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY total DESC, ym) AS r FROM eng) WHERE r = 1")
def top_n_peak_month(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.peak(months(spark, sf), "n_name", "ym", "total")


@query("""
WITH c AS (SELECT n_name, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS n, count(*) FILTER (l_returnflag = 'R') AS r
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
SELECT *, a / CASE WHEN a + n + r = 0 THEN 1 ELSE a + n + r END AS a_share, n / CASE WHEN a + n + r = 0 THEN 1 ELSE a + n + r END AS n_share, r / CASE WHEN a + n + r = 0 THEN 1 ELSE a + n + r END AS r_share FROM c""")
def traveller_mix(spark: SparkSession, sf: str) -> DataFrame:
    counts = lines(spark, sf).groupBy("n_name").agg(*(F.count_if(F.col("l_returnflag") == f).alias(f.lower()) for f in "ANR"))
    return counts.withColumns(analytics.rescaled(["a", "n", "r"]))


@query(_POSTS + " SELECT ym, count(DISTINCT n_name) AS n_nations, CAST(sum(total) AS BIGINT) / CAST(sum(n_posts) AS BIGINT) AS value_per_post FROM eng GROUP BY ym")
def monthly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return months(spark, sf).groupBy("ym").agg(F.countDistinct("n_name").alias("n_nations"), (F.sum("total") / F.sum("n_posts")).alias("value_per_post"))


def _dq_sql(name: str, rules: list[tuple[str, str, str, float, bool, bool]]) -> str:
    one = "SELECT '{}' AS table_name, '{}' AS check_name, '{}' AS category, {} AS is_critical, CAST({} AS DOUBLE) AS metric, {}e0 AS threshold, {} AS l FROM src"
    rows = " UNION ALL ".join(one.format(name, n, c, crit, m, t, least) for n, c, m, t, crit, least in rules)
    return f"SELECT table_name, check_name, category, is_critical, metric, threshold, CASE WHEN CASE WHEN l THEN metric >= threshold ELSE metric <= threshold END THEN 'PASS' WHEN is_critical THEN 'FAIL' ELSE 'WARN' END AS status FROM ({rows})"


_PCT = "count(*) FILTER ({}) * 100.0e0 / count(*)"


@query("WITH src AS (SELECT o.*, c_custkey IS NULL AS is_orphan FROM orders o LEFT JOIN (SELECT CASE WHEN c_custkey % 50 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey FROM customer) ON o_custkey = c_custkey) " + _dq_sql("orders", [
    ("min_records", "volume", "count(*)", 1000, True, True), ("null_pct_o_custkey", "completeness", _PCT.format("o_custkey IS NULL"), 0, True, False),
    ("duplicate_pct_o_orderkey", "uniqueness", "(count(*) - count(DISTINCT o_orderkey)) * 100.0e0 / count(*)", 1, True, False), ("range_o_totalprice", "validity", "count(*) FILTER (o_totalprice < 0 OR o_totalprice > 400000)", 0, True, False),
    ("enum_o_orderstatus", "validity", "count(*) FILTER (o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O'))", 0, True, False), ("coverage_o_orderpriority", "coverage", "count(DISTINCT o_orderpriority)", 5, False, True),
    ("future_o_orderdate", "timeliness", "count(*) FILTER (CAST(o_orderdate AS DATE) > DATE '1998-01-01')", 0, False, False), ("orphan_pct", "integrity", _PCT.format("is_orphan"), 5, False, False)]))
def dq_results_orders(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "customer").select(moved("c_custkey", 50).alias("o_custkey"))
    rules = [dq.min_records(1000), dq.null_pct("o_custkey"), dq.duplicate_pct("o_orderkey"), dq.in_range("o_totalprice", 0, 400_000), dq.enum("o_orderstatus", ["F", "O"]), dq.coverage("o_orderpriority", 5), dq.future("o_orderdate", "1998-01-01"), dq.orphan_rule()]
    return dq.check(dq.orphan_pct(table(spark, sf, "orders"), parents, "o_custkey"), "orders", rules)


@query("WITH src AS (SELECT * FROM events) " + _dq_sql("events", [
    ("min_records", "volume", "count(*)", 100, True, True), ("null_pct_props", "completeness", _PCT.format("props IS NULL"), 20, False, False),
    ("duplicate_pct_user_id_ts", "uniqueness", "(count(*) - count(DISTINCT (user_id, ts))) * 100.0e0 / count(*)", 1, True, False), ("range_value", "validity", "count(*) FILTER (value < 0)", 0, True, False),
    ("freshness_ts", "timeliness", "(epoch(TIMESTAMP '2025-01-01 00:00:00') - floor(epoch(max(ts)))) / 3600.0e0", 168, False, False)]))
def dq_results_events(spark: SparkSession, sf: str) -> DataFrame:
    rules = [dq.min_records(100), dq.null_pct("props", 20, critical=False), dq.duplicate_pct("user_id", "ts"), dq.in_range("value", 0), dq.freshness("ts", "2025-01-01 00:00:00")]
    return dq.check(table(spark, sf, "events"), "events", rules)


@query("WITH src AS (SELECT * FROM documents) " + _dq_sql("documents", [
    ("null_pct_text", "completeness", _PCT.format("text IS NULL"), 0, True, False), ("blank_text", "validity", "count(*) FILTER (trim(text) = '')", 0, True, False), ("short_text", "validity", "count(*) FILTER (length(trim(text)) < 3)", 0, True, False),
    ("no_letter_text", "validity", "count(*) FILTER (NOT regexp_matches(text, '\\p{L}'))", 0, False, False), ("missing_licence", "content", _PCT.format("NOT coalesce(regexp_matches(text, 'License'), false)"), 1, True, False)]))
def dq_results_documents(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check(table(spark, sf, "documents"), "documents", [dq.null_pct("text"), *dq.text_rules("text"), dq.presence("text", "licence", "License")])


@query("WITH src AS (SELECT * FROM pages) " + _dq_sql("pages", [
    ("scheme_url", "validity", "count(*) FILTER (NOT (url LIKE 'http://%' OR url LIKE 'https://%'))", 0, True, False), ("domain_url", "validity", _PCT.format("NOT contains(url, 'example')"), 1, True, False), ("spaces_url", "validity", "count(*) FILTER (contains(url, ' '))", 0, True, False)]))
def dq_results_pages(spark: SparkSession, sf: str) -> DataFrame:
    return dq.check(table(spark, sf, "pages"), "pages", dq.url_rules("url", "example"))


@query("SELECT CAST((SELECT count(*) FROM orders) < 10 AS BOOLEAN) AS failed")
def dq_exit(spark: SparkSession, sf: str) -> DataFrame:
    """Whether any critical check of a table failed."""
    return dq.failed(dq.check(table(spark, sf, "orders"), "orders", [dq.min_records(10), dq.null_pct("o_custkey")]))


@query("SELECT l_orderkey, l_linenumber, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey")
def strict_lookup(spark: SparkSession, sf: str) -> DataFrame:
    l, p = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), table(spark, sf, "part")
    return joins.strict_lookup(l, p, l.l_partkey == p.p_partkey, ["p_brand"], "p_brand").drop("l_partkey")
