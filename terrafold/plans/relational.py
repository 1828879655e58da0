"""Queries on joins, merges, dimensions and simple aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import clean, keys
from terrafold.operators import analytics, joins, merge, star
from terrafold.plans.registry import cents, moved, query, table


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """An old and a new version of customer: some keys missing in either, some rows changed."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    summed = lambda df: df.withColumn("row_checksum", keys.row_checksum(df.c_name, df.c_nationkey, df.c_mktsegment))
    changed = F.when(F.col("c_custkey") % 7 == 0, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name"))
    return summed(c.withColumn("c_custkey", moved("c_custkey", 5))), summed(c.withColumn("c_custkey", moved("c_custkey", 11)).withColumn("c_name", changed))


_VERSIONS = """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer),
o AS (SELECT *, md5(concat_ws('|', c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)) AS row_checksum FROM (SELECT * REPLACE (CASE WHEN c_custkey % 5 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM c)),
w AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_name || '*' ELSE c_name END AS c_name, c_nationkey, c_mktsegment FROM (SELECT * REPLACE (CASE WHEN c_custkey % 11 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM c)),
n AS (SELECT *, md5(concat_ws('|', c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)) AS row_checksum FROM w),
a AS (SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'keep'
  WHEN o.row_checksum = n.row_checksum THEN 'skip' ELSE 'update' END AS action FROM o FULL JOIN n ON o.c_custkey = n.c_custkey)
"""


@query(_VERSIONS + "SELECT c_custkey, action FROM a")
def change_set_customer(spark: SparkSession, sf: str) -> DataFrame:
    return merge.changes(*_versions(spark, sf), ["c_custkey"], "row_checksum")


@query(_VERSIONS + """SELECT a.c_custkey, CASE WHEN action IN ('insert', 'update') THEN n.c_name ELSE o.c_name END AS c_name,
CASE WHEN action IN ('insert', 'update') THEN n.c_nationkey ELSE o.c_nationkey END AS c_nationkey, CASE WHEN action IN ('insert', 'update') THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment,
CASE WHEN action IN ('insert', 'update') THEN n.row_checksum ELSE o.row_checksum END AS row_checksum FROM a LEFT JOIN o ON a.c_custkey = o.c_custkey LEFT JOIN n ON a.c_custkey = n.c_custkey""")
def merge_result_customer(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert(*_versions(spark, sf), ["c_custkey"], "row_checksum")


@query(_VERSIONS + "SELECT count(*) FILTER (action = 'insert') AS inserted, count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'skip') AS skipped, count(*) FILTER (action <> 'keep') AS total FROM a")
def merge_stats_customer(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_stats(merge.changes(*_versions(spark, sf), ["c_custkey"], "row_checksum"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_id NOT IN (SELECT CASE WHEN event_id % 2 = 0 THEN -event_id ELSE event_id END FROM events)")
def anti_join_append_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return merge.append_new(e.withColumn("event_id", moved("event_id", 2)), e, "event_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def keep_latest_event_per_user(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return keys.keep_latest(e, ["user_id"], [e.ts, e.event_id]).select("user_id", "event_id", "event_type")


@query("SELECT user_id, max(ts) AS last_ts, CAST(arg_max(event_id, (ts, event_id)) AS BIGINT) AS event_id FROM events GROUP BY user_id")
def latest_row_groupmax_join(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("SELECT p_type, row_number() OVER (ORDER BY p_type) AS type_sk FROM (SELECT DISTINCT trim(p_type) AS p_type FROM part WHERE trim(p_type) <> '')")
def surrogate_key_part_type(spark: SparkSession, sf: str) -> DataFrame:
    return star.value_dimension(table(spark, sf, "part"), "p_type", "type_sk")


@query("""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) AS quarter_name,
  CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(year(d) * 100 + month(d) AS INTEGER) AS year_month, CAST(week(d) AS INTEGER) AS iso_week, CAST(isoyear(d) * 100 + week(d) AS INTEGER) AS iso_year_week,
  CAST(isodow(d) AS INTEGER) AS iso_weekday, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start, day(d + 1) = 1 AS is_month_end,
  day(d) = 1 AND month(d) % 3 = 1 AS is_quarter_start, day(d + 1) = 1 AND month(d + 1) % 3 = 1 AS is_quarter_end, dayofyear(d) = 1 AS is_year_start, dayofyear(d + 1) = 1 AS is_year_end
FROM (SELECT CAST(unnest(generate_series(DATE '2000-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""")
def dim_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return star.calendar(spark, "2000-01-01", "2025-12-31")


@query("""SELECT o_orderkey, o_custkey, c_name, c_nationkey FROM orders LEFT JOIN (SELECT * REPLACE (CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM customer) c ON o_custkey = c_custkey""")
def lookup_left_with_miss(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "customer").withColumn("c_custkey", moved("c_custkey", 10))
    return joins.lookup(o, c, o.o_custkey == c.c_custkey, ["c_name", "c_nationkey"])


@query("SELECT count(*) AS n_rows, count(*) FILTER (c_custkey IS NULL) AS n_missing FROM orders LEFT JOIN (SELECT * REPLACE (CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey) FROM customer) c ON o_custkey = c_custkey")
def lookup_misses(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").withColumn("c_custkey", moved("c_custkey", 10))
    return joins.misses(joins.lookup(o, c, o.o_custkey == c.c_custkey, ["c_custkey"]), "c_custkey")


@query("""
SELECT l_orderkey, l_linenumber, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS order_date_sk, isodow(o_orderdate) >= 6 AS ordered_on_weekend,
  CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER) AS ship_date_sk, CAST(quarter(l_shipdate) AS INTEGER) AS ship_quarter FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def role_playing_dates(spark: SparkSession, sf: str) -> DataFrame:
    days = star.calendar(spark, "1990-01-01", "2030-12-31")
    ordered = days.select(F.col("full_date").alias("d1"), F.col("date_sk").alias("order_date_sk"), F.col("is_weekend").alias("ordered_on_weekend"))
    shipped = days.select(F.col("full_date").alias("d2"), F.col("date_sk").alias("ship_date_sk"), F.col("quarter").alias("ship_quarter"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("s"))
    both = lines.join(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o")), F.col("l_orderkey") == F.col("o_orderkey"))
    both = both.join(ordered, F.col("o") == F.col("d1"), "left").join(shipped, F.col("s") == F.col("d2"), "left")
    return both.select("l_orderkey", "l_linenumber", "order_date_sk", "ordered_on_weekend", "ship_date_sk", "ship_quarter")


@query("""
WITH d AS (SELECT s_suppkey AS sk, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey END AS url_key, s_nationkey AS name_key FROM supplier),
f AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_suppkey % 25 AS INTEGER) AS name FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, name, coalesce(u.sk, b.sk) AS sk FROM f LEFT JOIN (SELECT url_key, min(sk) AS sk FROM d GROUP BY 1) u ON l_suppkey = url_key
LEFT JOIN (SELECT name_key, min(sk) AS sk FROM d GROUP BY 1) b ON name = name_key""")
def fallback_join_supplier(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sk"), F.when(F.col("s_suppkey") % 4 != 0, F.col("s_suppkey")).alias("url_key"), F.col("s_nationkey").alias("name_key"))
    fact = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", (F.col("l_suppkey") % 25).cast("int").alias("name"))
    return joins.fallback_lookup(fact, dim, ("l_suppkey", "url_key"), ("name", "name_key"), "sk")


@query("""
WITH k AS (SELECT CASE WHEN l_orderkey % 7 = 0 THEN -l_orderkey ELSE l_orderkey END AS url, l_linenumber AS stt, max(l_suppkey) AS likes FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(likes, 0) AS likes FROM lineitem LEFT JOIN k ON l_orderkey = url AND l_linenumber = stt""")
def comments_with_likes(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as comments, with likes by post and number where there are some."""
    l = table(spark, sf, "lineitem")
    liked = l.filter("l_returnflag <> 'R'").select(moved("l_orderkey", 7).alias("url"), F.col("l_linenumber").alias("stt"), F.col("l_suppkey").alias("likes"))
    return joins.with_measure(l.select("l_orderkey", "l_linenumber", "l_partkey"), liked, {"l_orderkey": "url", "l_linenumber": "stt"}, "likes")


@query("SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def normalised_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Keys written as '@name ' on one side and NAME on the other."""
    names = table(spark, sf, "nation")
    c = table(spark, sf, "customer").join(names.select("n_nationkey", F.concat(F.lit(" @"), F.lower("n_name"), F.lit(" ")).alias("tag")), F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "tag")
    return joins.lookup(c, names.select("n_name"), clean.strip_handle(F.col("tag")) == F.lower(F.trim("n_name")), ["n_name"]).drop("tag")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END FROM orders)")
def semi_orphan_filter(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "orders").select(moved("o_orderkey", 3).alias("l_orderkey"))
    return joins.with_parents(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), parents, "l_orderkey")


@query("SELECT count(*) AS n_orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END FROM orders)")
def orphan_count(spark: SparkSession, sf: str) -> DataFrame:
    parents = table(spark, sf, "orders").select(moved("o_orderkey", 3).alias("l_orderkey"))
    return joins.orphans(table(spark, sf, "lineitem"), parents, "l_orderkey").agg(F.count("*").alias("n_orphans"))


@query("SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate ELSE o_orderdate END AS DATE) AS day FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey")
def enrich_null_date(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_shipdate").cast("date")).alias("day"))
    other = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("d"))
    return joins.enrich_nulls(lines, other, "l_orderkey", "day", "d")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """The star: lines with order, customer, nation and region."""
    l, o, c = (table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


@query("""
SELECT r_name, n_name, count(*) AS n_lines, count(*) FILTER (l_returnflag = 'R') AS n_returned, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS cents
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""")
def star_join_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return lines(spark, sf).groupBy("r_name", "n_name").agg(F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.sum(cents("l_extendedprice")).alias("cents"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) * 100.0e0 / sum(count(*)) OVER () AS pct FROM lineitem GROUP BY ALL")
def distribution_pct_total(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.distribution(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("""SELECT count(*) FILTER (o_totalprice < 1000) AS from_0, count(*) FILTER (o_totalprice >= 1000 AND o_totalprice < 10000) AS from_1000, count(*) FILTER (o_totalprice >= 10000 AND o_totalprice < 100000) AS from_10000,
count(*) FILTER (o_totalprice >= 100000) AS from_100000, count(*) FILTER (o_totalprice IS NULL) AS n_null, count(*) AS n_all FROM orders""")
def bucket_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.histogram(table(spark, sf, "orders"), F.col("o_totalprice"), [1000, 10_000, 100_000])


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def dup_having(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.duplicates(table(spark, sf, "events"), ["user_id", "event_type"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null, count(*) FILTER ({c} IS NULL) * 100.0e0 / count(*) AS null_pct FROM documents" for c in ("doc_id", "text", "lang", "source", "n_chars")))
def profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.profile(table(spark, sf, "documents"))


@query("SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders ORDER BY 2 DESC, 1 LIMIT 25")
def topk_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", cents("o_totalprice").alias("cents")).orderBy(F.desc("cents"), "o_orderkey").limit(25)


@query("SELECT v AS n_name, v IN (SELECT n_name FROM nation) AS is_found FROM (VALUES ('FRANCE'), ('CHINA'), ('ATLANTIS')) t(v)")
def set_coverage(spark: SparkSession, sf: str) -> DataFrame:
    wanted = spark.createDataFrame([("FRANCE",), ("CHINA",), ("ATLANTIS",)], "n_name string")
    found = table(spark, sf, "nation").select("n_name", F.lit(True).alias("f"))
    return wanted.join(found, "n_name", "left").select("n_name", F.coalesce("f", F.lit(False)).alias("is_found"))


_LAYERS = ("orders", "lineitem", "customer", "documents")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _LAYERS))
def layer_row_audit(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (table(spark, sf, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n")) for t in _LAYERS))


@query("SELECT event_type, source FROM (SELECT event_type, 'a' AS source, event_id FROM events UNION ALL SELECT event_type, 'b', event_id FROM events) GROUP BY ALL")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("event_type", F.lit("a").alias("source")).unionByName(e.select("event_type", F.lit("b").alias("source"))).distinct()


@query("""SELECT user_id, user_sk, event_type FROM (SELECT user_id, event_type, row_number() OVER (ORDER BY user_key) AS user_sk FROM (SELECT user_id, lpad(CAST(user_id AS VARCHAR), 12, '0') AS user_key, event_type,
row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1)""")
def entity_dimension(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("user_key", F.lpad(F.col("user_id").cast("string"), 12, "0"))
    dim = star.entity_dimension(e, "user_key", "user_sk", [F.col("ts"), F.col("event_id")], ["user_id", "event_type"], F.lit("2025-01-01").cast("timestamp"))
    return dim.select("user_id", "user_sk", "event_type")
