"""Queries on single rows: parsing, cleaning, checksums, text features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions import clean, keys, parse, text
from terrafold.plans.registry import query, table


@query("""
SELECT o_orderkey, md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''), coalesce(o_orderstatus, ''),
  coalesce(o_orderpriority, ''), coalesce(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), ''))) AS row_checksum FROM orders""")
def row_checksum_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    own = keys.row_checksum(o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate.cast("date"))
    return o.select("o_orderkey", own.alias("row_checksum"))


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN CAST(o_custkey % 1000 // 10 AS VARCHAR) || '.' || CAST(o_custkey % 10 AS VARCHAR) || 'K'
  WHEN 2 THEN CAST(o_custkey % 100 // 10 AS VARCHAR) || '.' || CAST(o_custkey % 10 AS VARCHAR) || 'M' WHEN 3 THEN 'N/A' ELSE '1.2k' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN CAST(raw AS BIGINT)
  WHEN regexp_matches(raw, '^[0-9.]+K$') THEN CAST(CAST(replace(raw, 'K', '') AS DECIMAL(18,6)) * 1000 AS BIGINT)
  WHEN regexp_matches(raw, '^[0-9.]+M$') THEN CAST(CAST(replace(raw, 'M', '') AS DECIMAL(18,6)) * 1000000 AS BIGINT) END AS parsed FROM t""")
def parse_compact_number(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("""CASE o_orderkey % 5 WHEN 0 THEN string(o_custkey) WHEN 1 THEN concat(o_custkey % 1000 div 10, '.', o_custkey % 10, 'K')
        WHEN 2 THEN concat(o_custkey % 100 div 10, '.', o_custkey % 10, 'M') WHEN 3 THEN 'N/A' ELSE '1.2k' END""")
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).withColumn("parsed", parse.compact_number(F.col("raw")))


@query("""
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 4 <> 3 THEN o_orderdate END AS DATE) AS review_date,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS stay_month FROM orders""")
def parse_localised_date(spark: SparkSession, sf: str) -> DataFrame:
    """Dates written out in words and read back; a month of 13 is no date."""
    d = F.col("o_orderdate").cast("date")
    long_form = F.when(F.col("o_orderkey") % 4 == 3, "ngày 5 tháng 13 năm 2024").otherwise(F.concat(F.lit("Ngày đánh giá: ngày "), F.day(d), F.lit(" tháng "), F.month(d), F.lit(" năm "), F.year(d)))
    month = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("Tháng: "), F.month(d), F.lit(" "), F.year(d))).otherwise(F.concat(F.lit("tháng "), F.month(d), F.lit("/"), F.year(d)))
    return table(spark, sf, "orders").select("o_orderkey", parse.long_form_date(long_form).alias("review_date"), parse.month_year_date(month).alias("stay_month"))


@query("""
WITH t AS (SELECT event_id, ts, CAST(1 + event_id % 40 AS INTEGER) AS n, event_id % 7 AS kind FROM events)
SELECT event_id, CAST(CASE kind WHEN 0 THEN ts - to_days(n) WHEN 1 THEN CAST(ts AS DATE) - to_days(7 * n) WHEN 2 THEN CAST(ts AS DATE) - to_months(n)
  WHEN 3 THEN ts - to_hours(n) WHEN 4 THEN ts - to_minutes(n) WHEN 5 THEN ts END AS DATE) AS parsed FROM t""")
def relative_date(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("""CASE event_id % 7 WHEN 0 THEN concat(n, ' ngày trước') WHEN 1 THEN concat(n, ' tuần trước') WHEN 2 THEN concat(n, ' tháng trước')
        WHEN 3 THEN concat(n, ' giờ trước') WHEN 4 THEN concat(n, ' phút trước') WHEN 5 THEN 'vừa xong' ELSE 'abc' END""")
    e = table(spark, sf, "events").withColumn("n", 1 + F.col("event_id") % 40).withColumn("ts", F.col("ts").cast("timestamp"))
    return e.select("event_id", parse.relative_date(raw, F.col("ts")).alias("parsed"))


@query("""
SELECT event_id, CAST(CASE WHEN event_id % 5 IN (1, 2) AND day(ts) <= 12 THEN make_date(year(ts), day(ts), month(ts))
  WHEN event_id % 5 = 4 THEN NULL ELSE ts END AS DATE) AS parsed FROM events""")
def multi_format_date(spark: SparkSession, sf: str) -> DataFrame:
    """Five ways to write a day; those with the day first read as month first where they can."""
    d = F.col("ts").cast("date")
    part = lambda sep, *fs: F.concat_ws(sep, *(f(d).cast("string") for f in fs))
    kind = F.col("event_id") % 5
    raw = F.when(kind == 0, part("/", F.month, F.day, F.year)).when(kind == 1, part("/", F.day, F.month, F.year)).when(kind == 2, part("-", F.day, F.month, F.year)).when(kind == 3, d.cast("string")).otherwise("")
    return table(spark, sf, "events").select("event_id", parse.multi_format_date(raw).alias("parsed"))


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def parse_js_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.date_format(F.col("ts").cast("timestamp"), "E MMM dd yyyy HH:mm:ss"), F.lit(" GMT+0700 (Indochina Time)"))
    return table(spark, sf, "events").select("event_id", parse.js_timestamp(raw).cast("timestamp_ntz").alias("parsed"))


@query("""
WITH t AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN ' True ' WHEN 2 THEN 'FALSE' WHEN 3 THEN '0' WHEN 4 THEN 'Yes' ELSE 'no' END AS raw FROM events)
SELECT event_id, CASE WHEN lower(trim(raw)) IN ('1', 'true') THEN true WHEN lower(trim(raw)) IN ('0', 'false') THEN false END AS flag,
  CASE lower(trim(raw)) WHEN 'yes' THEN true WHEN 'no' THEN false END AS answer, CAST(CASE lower(trim(raw)) WHEN 'yes' THEN 2 WHEN 'no' THEN 1 END AS INTEGER) AS level,
  CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN CAST(raw AS BIGINT) END AS digits FROM t""")
def text_flags(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE event_id % 6 WHEN 0 THEN '1' WHEN 1 THEN ' True ' WHEN 2 THEN 'FALSE' WHEN 3 THEN '0' WHEN 4 THEN 'Yes' ELSE 'no' END")
    return table(spark, sf, "events").select("event_id", parse.text_flag(raw).alias("flag"), parse.yes_no(raw).alias("answer"), parse.yes_no_level(raw).alias("level"), parse.digits_only(raw).alias("digits"))


@query(r"""
SELECT doc_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(text), '<[^>]+>', ' ', 'g'), 'http\S+|www\.[^\s]+', ' ', 'g'),
  '[\r\n]+', ' ', 'g'), '[^\p{L}\p{N}\p{P}\p{Z}]+', ' ', 'g')), '\s+', ' ', 'g')) AS clean FROM documents""")
def clean_text_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", clean.clean_text(F.col("text")).alias("clean"))


@query("""
WITH t AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '  ' ELSE ' ' || c_mktsegment || ' ' END AS segment, 'shop://x' AS url, c_name FROM customer)
SELECT c_custkey, CASE WHEN trim(segment) IN ('', '0') THEN NULL ELSE trim(segment) END AS segment, regexp_replace(c_name, '#', ' ') AS c_name FROM t
WHERE trim(segment) NOT IN ('', '0')""")
def bronze_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Invalid texts to NULL, trimmed, rows without a required column dropped."""
    raw = table(spark, sf, "customer").select("c_custkey", F.expr("CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '  ' ELSE concat(' ', c_mktsegment, ' ') END").alias("segment"), F.regexp_replace("c_name", "#", "+").alias("c_name"))
    kept, _ = clean.require(clean.trim_strings(clean.invalid_to_null(raw)), ["segment"])
    return kept.withColumn("c_name", clean.path_safe(F.col("c_name")))


@query("""
SELECT page_id, url, (url LIKE 'http://%' OR url LIKE 'https://%') AS has_scheme, trim(regexp_replace(url, '[+,/\\\\:*?"<>|]', ' ', 'g')) AS safe FROM pages""")
def url_predicates(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "url", clean.has_web_scheme(F.col("url")).alias("has_scheme"), clean.path_safe(F.col("url")).alias("safe"))


@query("""
SELECT p_partkey, p_brand || ', ' || p_type || ', Bar' AS amenities, p_partkey % 10000 AS first_number, CAST(p_size AS DOUBLE) + 0.5e0 AS score,
  'size: ' || CAST(p_size AS VARCHAR) AS breakdown FROM part""")
def clean_lists(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    listed = F.concat("p_brand", F.lit(",  , "), "p_type", F.lit(",,  Bar, Xem tất cả 12 tiện nghi"))
    pairs = F.concat(F.lit("{'size': '"), "p_size", F.lit("', 'none': ''}"))
    return p.select(
        "p_partkey", F.regexp_replace(clean.clean_list(listed), r",\s*", ", ").alias("amenities"), parse.first_integer(F.concat(F.col("p_partkey") % 10000, F.lit(" đánh giá"))).alias("first_number"),
        parse.decimal_comma(F.concat("p_size", F.lit(",5"))).alias("score"), clean.flatten_pairs(pairs).alias("breakdown"),
    )


REGIONS = {"FRANCE": "West", "GERMANY": "West", "CHINA": "East", "JAPAN": "East", "VIETNAM": "South"}


@query("""
SELECT n_nationkey, CASE n_name WHEN 'FRANCE' THEN 'West' WHEN 'GERMANY' THEN 'West' WHEN 'CHINA' THEN 'East' WHEN 'JAPAN' THEN 'East' WHEN 'VIETNAM' THEN 'South'
  ELSE n_name END AS merged, n_name IN ('FRANCE', 'GERMANY', 'CHINA', 'JAPAN', 'VIETNAM') AS is_listed FROM nation""")
def static_map_default(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select("n_nationkey", clean.mapped(F.col("n_name"), REGIONS).alias("merged"), F.col("n_name").isin(*REGIONS).alias("is_listed"))


@query(r"""
WITH names(name, sk) AS (VALUES ('régión', 1), ('ÉTÉ', 2), ('Für', 3), ('mañana', 4), ('données', 5), ('systeme', 6)),
w AS (SELECT lang, unnest(string_split(text, ' ')) AS w FROM documents)
SELECT w.lang, n.sk, count(*) AS n FROM w LEFT JOIN names n ON trim(regexp_replace(strip_accents(lower(w)), '\s+', ' ', 'g')) = strip_accents(lower(n.name)) GROUP BY ALL""")
def accent_fold_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Words looked up in a list of names by their folded forms; words without a match have no sk."""
    words = table(spark, sf, "documents").select("lang", F.explode(F.split("text", " ")).alias("w")).withColumn("folded", clean.fold_accents(F.col("w")))
    names = spark.createDataFrame([("régión", 1), ("ÉTÉ", 2), ("Für", 3), ("mañana", 4), ("données", 5), ("systeme", 6)], "name string, sk int").select(clean.fold_accents(F.col("name")).alias("folded"), "sk")
    return words.join(names, "folded", "left").groupBy("lang", "sk").agg(F.count("*").alias("n"))


@query(r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS words, text FROM documents)
SELECT doc_id, len(words) AS n_words, CASE WHEN len(words) > 0 THEN CAST(len(list_distinct(words)) AS DOUBLE) / len(words) ELSE 0.0 END AS unique_ratio,
  length(text) - length(replace(text, '!', '')) AS n_exclaim FROM t""")
def word_stats(spark: SparkSession, sf: str) -> DataFrame:
    return text.word_stats(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


def _hits_sql(words: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains(lower(text), '{w}') AS INTEGER)" for w in words)


@query(f"""
SELECT doc_id, CAST(sign(({_hits_sql(text.POSITIVE)}) - ({_hits_sql(tuple(w for w in text.NEGATIVE if len(w) > 2))})
  - CAST(regexp_matches(lower(text), '(^|[^\\p{{L}}])tệ([^\\p{{L}}]|$)') AS INTEGER) - CAST(regexp_matches(lower(text), '(^|[^\\p{{L}}])dở([^\\p{{L}}]|$)') AS INTEGER)) AS INTEGER) AS sentiment FROM documents""")
def lexicon_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.sentiment(F.col("text")).alias("sentiment"))


def _told_sql(column: str, words: tuple[str, ...]) -> str:
    """How many of the words occur in a lower-case text; those of two characters or less must stand alone."""
    alone = lambda w: f"regexp_matches({column}, '(^|[^\\p{{L}}]){w}([^\\p{{L}}]|$)')"
    return "(" + " + ".join(f"CAST({alone(w) if len(w) <= 2 else f'contains({column}, {w!r})'} AS INTEGER)" for w in words) + ")"


def _tokens_sql(column: str) -> str:
    return f"list_filter(regexp_split_to_array({column}, '\\s+'), lambda w: w <> '')"


def _lean_sql(column: str) -> str:
    return f"sign({_told_sql(column, text.POSITIVE)} - {_told_sql(column, text.NEGATIVE)})"


_TIDY_SQL = r"""
WITH t AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), 'https?://\S+', '', 'g'), '@\w+', '', 'g'), '\s+', ' ', 'g')) AS t FROM conversations),
w AS (SELECT *, lower(t) AS low, """ + _tokens_sql("lower(t)") + " AS words, length(t) - length(replace(t, '!', '')) AS marks FROM t)"


@query(_TIDY_SQL + f""", s AS (SELECT *, {_lean_sql('low')} AS mood, {_told_sql('low', text.POSITIVE)} AS p, {_told_sql('low', text.NEGATIVE)} AS n, {_told_sql('low', text.POSITIVE_EMOJI)} AS pe, {_told_sql('low', text.NEGATIVE_EMOJI)} AS ne,
  regexp_split_to_array(low, '[.,!?;\\n]|\\b(?:but|however|nhưng)\\b') AS clauses FROM w),
g AS (SELECT *, least(3, p) + least(3, pe) + CASE WHEN marks >= 2 THEN 1 ELSE 0 END + CASE WHEN mood > 0 THEN 2 ELSE 0 END AS glad, least(3, n) + least(3, ne) + CASE WHEN mood < 0 THEN 2 ELSE 0 END AS sad FROM s),
l AS (SELECT *, CASE WHEN length(t) < 3 OR glad = sad THEN 'neutral' WHEN glad > sad THEN 'positive' ELSE 'negative' END AS label, glad + sad + CASE WHEN mood = 0 THEN 1 ELSE 0 END AS signals FROM g)
SELECT conv_id, turn, label, round(CASE WHEN length(t) < 3 THEN 0.3e0 WHEN glad = 0 AND sad = 0 THEN 0.4e0 WHEN glad = sad THEN 0.5e0 ELSE least(0.95e0, 0.4e0 + greatest(glad, sad) / signals * 0.55e0 * least(signals / 5, 1.0e0)) END, 6) AS confidence, """ + ", ".join(f"""
CAST(CASE WHEN len({a}) = 0 THEN 0 WHEN list_sum({a}) <> 0 THEN sign(list_sum({a})) WHEN label = 'positive' THEN 1 WHEN label = 'negative' THEN -1 ELSE 0 END AS INTEGER) AS aspect_{a}""" for a in text.ASPECTS) + " FROM (SELECT *, " + ", ".join(
    f"list_transform(list_filter(clauses, lambda c: {_told_sql('c', own)} >= 2 OR ({_told_sql('c', own)} = 1 AND len({_tokens_sql('c')}) <= 15)), lambda c: {_lean_sql('c')}) AS {a}" for a, own in text.ASPECTS.items()) + " FROM l)")
def weak_labels(spark: SparkSession, sf: str) -> DataFrame:
    return text.weak_labels(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text").drop("text")


@query(_TIDY_SQL + f"""
SELECT conv_id, turn, CAST(len(words) AS INTEGER) AS n_words, CASE WHEN len(words) > 0 THEN round(len(list_distinct(words)) / len(words), 4) ELSE 0.0e0 END AS unique_ratio, CAST(marks AS INTEGER) AS n_exclaim, CAST({_lean_sql('low')} AS INTEGER) AS sentiment,
{_told_sql('low', text.POSITIVE_EMOJI + text.NEGATIVE_EMOJI)} AS n_emoji, {_told_sql('low', text.POSITIVE)} AS n_positive, {_told_sql('low', text.NEGATIVE)} AS n_negative FROM w""")
def comment_features(spark: SparkSession, sf: str) -> DataFrame:
    return text.comment_features(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text").drop("text")


@query("""
SELECT doc_id, quality, source FROM (SELECT l.doc_id, quality, source, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(l.doc_id AS VARCHAR)), l.doc_id) AS r
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id) WHERE r <= 50""")
def stratified_cap(spark: SparkSession, sf: str) -> DataFrame:
    both = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id").select("doc_id", "quality", "source")
    return text.stratified_cap(both, "quality", 50, [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")])


@query("""
WITH t AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label, CAST(doc_id % 100 AS DOUBLE) / 100 AS confidence FROM labels)
SELECT doc_id, label, confidence, false AS is_weak FROM t WHERE confidence >= CASE WHEN label = 'negative' THEN 0.5e0 ELSE 0.6e0 END
UNION ALL SELECT * FROM (SELECT doc_id, label, confidence, true AS is_weak FROM t WHERE label = 'neutral' AND confidence >= 0.35e0 AND confidence < 0.6e0 ORDER BY doc_id LIMIT 20)""")
def confident_union(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    rows = table(spark, sf, "labels").select("doc_id", label.alias("label"), ((F.col("doc_id") % 100).cast("double") / 100).alias("confidence"))
    return text.confident(rows, 20, [F.col("doc_id")])


@query("""
SELECT s_suppkey, [CAST(s_nationkey % 2 = 0 AS INTEGER), CAST(s_nationkey % 3 = 0 AS INTEGER), 0] AS aspects FROM supplier""")
def multi_hot_labels(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat_ws(", ", F.when(F.col("s_nationkey") % 2 == 0, "food"), F.when(F.col("s_nationkey") % 3 == 0, "price"))
    return table(spark, sf, "supplier").select("s_suppkey", text.multi_hot(raw, ["food", "price", "service"]).alias("aspects"))
