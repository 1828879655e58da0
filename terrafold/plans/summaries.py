"""Queries on summaries, filters, comment months and the two indices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.operators import features, filters, merge, summaries
from terrafold.plans.registry import query, table

_DESCRIBED = ("l_quantity", "l_linenumber", "l_suppkey")


def _described(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS n, count(*) - count({c}) AS n_null, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS sd,
  CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS q50 FROM lineitem"""


@query(" UNION ALL ".join(map(_described, _DESCRIBED)))
def describe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    found = summaries.describe(table(spark, sf, "lineitem"), list(_DESCRIBED), (0.5,), exact=True)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query("SELECT l_returnflag, CAST(sum(l_orderkey) AS BIGINT) AS sum_l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber, sum(l_quantity) AS sum_l_quantity FROM lineitem GROUP BY 1")
def sum_all_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.sum_numbers(table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"), ["l_returnflag"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null, CAST(min({c}) AS VARCHAR) AS lowest, CAST(max({c}) AS VARCHAR) AS highest, (count(*) - count({c})) * 100.0e0 / count(*) AS null_pct FROM (SELECT event_id, date_trunc('second', ts) AS ts, event_type FROM events)" for c, t in (("event_id", "bigint"), ("ts", "timestamp"), ("event_type", "string"))))
def profile_events(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.profile_columns(table(spark, sf, "events").select("event_id", F.date_trunc("second", "ts").alias("ts"), "event_type").withColumn("ts", F.col("ts").cast("timestamp")))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_filled, CAST(min({c}) AS VARCHAR) AS sample, round(count({c}) * 100.0e0 / count(*), 2) AS fill_pct FROM documents" for c in ("doc_id", "lang", "source")))
def load_summary_documents(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.load_summary(table(spark, sf, "documents"), ["doc_id", "lang", "source"])


@query("""
SELECT md5(event_type || '_' || strftime(ts, '%Y%m%d')) AS run_key, event_type AS table_name, CASE WHEN props IS NULL THEN 'success' ELSE 'failed' END AS status, CAST(90 AS BIGINT) AS seconds,
CASE WHEN props IS NULL THEN event_id END AS rows, props AS error FROM events""")
def job_log_entries(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return summaries.job_entries(e, e.event_type, e.ts, e.ts + F.expr("interval 90 seconds"), e.event_id, e.props)


@query("""
SELECT conv_id, turn FROM conversations WHERE text IS NOT NULL AND text <> ''""")
def non_empty_comments(spark: SparkSession, sf: str) -> DataFrame:
    return filters.with_text(table(spark, sf, "conversations"), "text").select("conv_id", "turn")


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym FROM orders
WHERE year(o_orderdate) = 1996 AND o_totalprice >= 1000 AND year(o_orderdate) * 100 + month(o_orderdate) < 199609 AND o_totalprice <= 300000""")
def filtered_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One year, flagged rows, complete months, and no outliers."""
    o = table(spark, sf, "orders").withColumns({"ym": features.year_month(F.col("o_orderdate")), "read_status": F.col("o_totalprice") >= 1000})
    kept = filters.at_most(filters.complete_months(filters.flagged(filters.of_month(o, "o_orderdate", 1996), "read_status"), "ym", 199609), F.col("o_totalprice"), 300000)
    return kept.select("o_orderkey", "ym")


@query("""
WITH s AS (SELECT o_custkey, o_orderkey FROM orders), n AS (SELECT count(DISTINCT o_custkey) AS new FROM s WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
SELECT new, (SELECT count(*) FROM s) - new AS duplicate FROM n""")
def append_stats_customers(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return merge.append_stats(known, table(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey")


_COMMENTS = """
WITH c AS (SELECT s_nationkey AS province, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym, l_linenumber - 4.0e0 AS sentiment, CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END AS label,
  CAST(l_quantity AS BIGINT) AS words, 1 / l_linenumber AS unique_ratio, CAST(l_orderkey % 4 AS INTEGER) AS emojis, CAST(l_orderkey % 4 > 1 AS INTEGER) AS pos, CAST(l_orderkey % 4 > 2 AS INTEGER) AS neg, l_linenumber AS level, l_suppkey AS likes,
  CAST(l_partkey % 5 AS INTEGER) AS food, CASE WHEN l_partkey % 2 = 0 THEN 1.0e0 END AS food_pos, CAST(l_partkey % 3 AS INTEGER) AS food_neg, 0 AS price FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
m AS (SELECT province, ym, count(*) AS total_comments, round(avg(sentiment), 6) AS avg_sentiment, round(stddev(sentiment), 6) AS sd_sentiment, count(*) FILTER (label = 'positive') / count(*) AS positive_ratio,
  count(*) FILTER (label = 'negative') / count(*) AS negative_ratio, round(avg(words), 6) AS avg_words, round(stddev(words), 6) AS sd_words, round(avg(unique_ratio), 6) AS unique_ratio,
  round(avg(CASE WHEN emojis > 0 THEN (pos - neg) / emojis ELSE 0.0 END), 6) AS emoji_sentiment, count(*) FILTER (level = 2) / count(*) AS reply_ratio, CAST(sum(likes) AS BIGINT) AS comment_likes,
  round(CASE WHEN sum(food) >= 0.5 THEN (sum(coalesce(food_pos, 0)) - sum(food_neg)) / sum(food) END, 6) AS avg_food, CAST(CASE WHEN sum(price) >= 0.5 THEN 1 END AS DOUBLE) AS avg_price FROM c GROUP BY ALL)
"""


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    l, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    own = {
        "province": "s_nationkey", "ym": "year(l_shipdate) * 100 + month(l_shipdate)", "sentiment": "l_linenumber - 4.0D", "label": "CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END",
        "words": "CAST(l_quantity AS BIGINT)", "unique_ratio": "1 / l_linenumber", "emojis": "CAST(l_orderkey % 4 AS INT)", "positive_emojis": "CAST(l_orderkey % 4 > 1 AS INT)", "negative_emojis": "CAST(l_orderkey % 4 > 2 AS INT)", "level": "l_linenumber", "likes": "l_suppkey",
        "food": "CAST(l_partkey % 5 AS INT)", "food_pos": "CASE WHEN l_partkey % 2 = 0 THEN 1.0D END", "food_neg": "CAST(l_partkey % 3 AS DOUBLE)", "price": "0", "price_pos": "CAST(NULL AS DOUBLE)", "price_neg": "CAST(NULL AS DOUBLE)",
    }
    return l.join(s, l.l_suppkey == s.s_suppkey).selectExpr(*(f"{e} AS {n}" for n, e in own.items()))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("avg_sentiment", "sd_sentiment", "avg_words", "sd_words", "unique_ratio", "emoji_sentiment", "avg_food") if c in df.columns})


@query(_COMMENTS + "SELECT * FROM m")
def comment_months_second(spark: SparkSession, sf: str) -> DataFrame:
    """The second form, with aspects, where it has rows."""
    own = _comments(spark, sf)
    return _rounded(features.comment_months_of(own, own, ["province", "ym"], ["food", "price"]))


@query(_COMMENTS + "SELECT * REPLACE (0.0e0 AS avg_food, 0.0e0 AS avg_price) FROM m")
def comment_months_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first form takes the place of an empty second one."""
    own = _comments(spark, sf)
    return _rounded(features.comment_months_of(own.limit(0), own, ["province", "ym"], ["food", "price"]))


_MEASURES = {
    "total_posts": "total_comments + province % 3", "avg_likes": "comment_likes / total_comments", "avg_saves": "avg_words * 2", "total_likes": "comment_likes + province", "total_saves": "total_comments * province",
    "word_variation": "CASE WHEN avg_words > 0 THEN coalesce(sd_words, 0) / avg_words ELSE 0.0 END", "total_emojis": "total_comments % 17", "exclamation_ratio": "positive_ratio / 3",
}


def _index_sql(families: dict) -> str:
    rank = lambda m: f"percent_rank() OVER (PARTITION BY ym ORDER BY {m} NULLS FIRST)"
    value = lambda m, less: f"(1 - {rank(m)})" if less else rank(m)
    parts = " + ".join("(" + " + ".join(f"{value(m, less)} * {w}e0" for m, (w, less) in own.items()) + f") * {weight}e0" for weight, own in families.values())
    more = ", ".join(f"{e} AS {n}" for n, e in _MEASURES.items())
    return _COMMENTS + f", x AS (SELECT *, {more} FROM m) SELECT province, ym, round(greatest(0.0e0, least(1.0e0, {parts})), 9) AS hotness FROM x"


def _index(spark: SparkSession, sf: str, families: dict) -> DataFrame:
    own = _rounded(features.comment_months(_comments(spark, sf), ["province", "ym"])).selectExpr("*", *(f"{e} AS {n}" for n, e in _MEASURES.items()))
    return features.family_index(own, "ym", families).select("province", "ym", F.round("hotness", 9).alias("hotness"))


@query(_index_sql(features.INDEX_A))
def hot_index_families(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf, features.INDEX_A)


@query(_index_sql(features.INDEX_B))
def hot_index_second_form(spark: SparkSession, sf: str) -> DataFrame:
    return _index(spark, sf, features.INDEX_B)
