"""Merges, tables, raw files, streams, data quality and segments."""

import pytest
from pyspark.sql import functions as F

from terrafold.functions import clean, keys
from terrafold.functions.keys import row_checksum
from terrafold.operators import dq, features, filters, forecast, joins, merge, star, summaries
from terrafold.sources import files
from terrafold.sources.tables import Catalog, Tables, added_columns, ddl
from terrafold.streaming.incremental import stream_upsert


def rows(spark, data):
    df = spark.createDataFrame(data, "k string, p int, v string")
    return df.withColumn("row_checksum", row_checksum(df.v))


def test_merge_null_keys_and_idempotence(spark):
    target = rows(spark, [("a", 1, "x"), ("b", None, "y"), ("c", 3, "z")])
    source = rows(spark, [("a", 1, "x2"), ("b", None, "y"), ("d", None, "n")])
    actions = {(r.k, r.p): r.action for r in merge.changes(target, source, ["k", "p"], "row_checksum").collect()}
    assert actions == {("a", 1): "update", ("b", None): "skip", ("c", 3): "keep", ("d", None): "insert"}
    after = merge.upsert(target, source, ["k", "p"], "row_checksum")
    assert {(r.k, r.v) for r in after.collect()} == {("a", "x2"), ("b", "y"), ("c", "z"), ("d", "n")}
    again = merge.merge_stats(merge.changes(after, source, ["k", "p"], "row_checksum")).first()
    assert (again.inserted, again.updated, again.skipped, again.total) == (0, 0, 3, 3)
    kept = merge.upsert(target.withColumn("sk", F.lit(1)), source.withColumn("sk", F.lit(9)), ["k", "p"], "row_checksum", keep=("sk",))
    assert {r.k: r.sk for r in kept.collect()} == {"a": 1, "b": 1, "c": 1, "d": 9}


def test_log(spark):
    log = spark.createDataFrame([("s1", "silver", "success"), ("s2", "silver", "failed")], "file_checksum string, layer string, status string")
    new = spark.createDataFrame([("s2", "silver", "success"), ("s3", "gold", "success")], log.schema)
    log = merge.log_upsert(log, new.unionByName(new.filter("layer = 'gold'")))
    assert log.count() == 3
    found = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "file_checksum string")
    assert [r.file_checksum for r in merge.skip_processed(found, log, "silver").collect()] == ["s3"]


def test_strict_lookup_fails(spark):
    fact, dim = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 10)], "d int, sk int")
    with pytest.raises(Exception, match="no match"):
        joins.strict_lookup(fact, dim, fact.k == dim.d, ["sk"], "sk").collect()


def test_tables(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string")
    t.overwrite_partitions(df, "gold.f", ["p"])
    t.overwrite_partitions(spark.createDataFrame([(3, "b")], df.schema), "gold.f", ["p"])
    assert {(r.x, r.p) for r in t.read("gold.f").collect()} == {(1, "a"), (3, "b")}
    wide = spark.createDataFrame([], "x int, p string, y double").schema
    assert added_columns(df, wide) == ["y"] and t.read("gold.f", wide).columns == ["x", "p", "y"] and t.read("gold.none", wide).count() == 0
    assert ddl("g.t", wide, ["p"]) == "CREATE TABLE IF NOT EXISTS `g`.`t` (`x` INT, `p` STRING, `y` DOUBLE) USING parquet PARTITIONED BY (`p`)"


def test_append_and_exports(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "a"), (2, 'say "b", c'), (3, "a"), (4, "a")], "x int, p string")
    t.append(df, "s.t", ["p"])
    t.append(df.limit(1), "s.t", ["p"])
    assert t.read("s.t").count() == 5
    t.export(df.repartition(4), "s.few")
    assert len([f for f in (tmp_path / "s/few").iterdir() if f.suffix == ".parquet"]) == 1
    t.export_sample(df, "s.sample", "p", 2, [F.col("x").desc()])
    got = files.read_csv(spark, f"{tmp_path}/s/sample", multi_line=True)
    assert sorted((r.x, r.p) for r in got.collect()) == [("2", 'say "b", c'), ("3", "a"), ("4", "a")]


def test_catalog(spark, tmp_path):
    c = Catalog(spark)
    schema = spark.createDataFrame([], "`select` int, `a b` string, `c.d` double").schema
    c.create_namespace("plain_ns", f"{tmp_path}/ns")
    try:
        c.create("plain_ns.first", schema, ["a b"], {"owner's": "x"}, f"{tmp_path}/it's here")
        c.create("plain_ns.first", schema)
        assert c.tables("plain_ns") == ["first"] and spark.table("plain_ns.first").columns == ["select", "c.d", "a b"]
        c.create("plain_ns.first", spark.createDataFrame([], "z int").schema, replace=True)
        assert spark.table("plain_ns.first").columns == ["z"]
        c.drop("plain_ns.first")
        assert c.tables("plain_ns") == []
    finally:
        c.drop_namespace("plain_ns", tables_too=True)
    assert "LOCATION" not in ddl("t", schema) and ddl("t", schema, location="/x").endswith("USING parquet LOCATION '/x'")


def test_stamps_shares_and_job_log(spark, tmp_path):
    old, now = F.lit("2024-01-01").cast("timestamp"), F.lit("2025-01-01").cast("timestamp")
    target = rows(spark, [("a", 1, "x"), ("b", 2, "y")]).withColumn("updated_at", old)
    source = rows(spark, [("a", 1, "x2"), ("b", 2, "y"), ("c", 3, "z")])
    after = {r.k: r.updated_at.year for r in merge.upsert(target, source, ["k", "p"], "row_checksum", stamp=("updated_at", now)).collect()}
    assert after == {"a": 2025, "b": 2024, "c": 2025}
    texts = spark.createDataFrame([("wifi",), ("pool",), (None,)], "t string")
    got = {r.check_name: (r.status, round(r.metric, 2)) for r in dq.check(texts, "t", [dq.share("t", "wifi", "wifi", 50), dq.share("t", "pool", "pool")]).collect()}
    assert got == {"share_wifi": ("INFO", 33.33), "share_pool": ("PASS", 33.33)}
    tables, runs = Tables(spark, str(tmp_path)), spark.createDataFrame([("t", "2025-01-01 10:00:00", "2025-01-01 10:00:45", 7, "boom"), ("u", "2025-01-01 10:00:00", "2025-01-01 10:00:01", 3, None)], "t string, a string, b string, n long, e string")
    entries = summaries.job_entries(runs, F.col("t"), F.col("a").cast("timestamp"), F.col("b").cast("timestamp"), F.col("n"), F.col("e"))
    tables.overwrite(entries, "log.first")
    again = entries.filter("table_name = 't'").withColumns({"status": F.lit("success"), "rows": F.lit(9).cast("long"), "error": F.lit(None).cast("string")})
    log = merge.upsert(tables.read("log.first"), again, ["run_key"], "status")
    tables.overwrite(log, "log.second")
    assert {r.table_name: (r.status, r.seconds, r["rows"]) for r in tables.read("log.second").collect()} == {"t": ("success", 45, 9), "u": ("success", 1, 3)}


def test_dimension_columns(spark):
    at = F.lit("2025-01-01").cast("timestamp")
    df = spark.createDataFrame([("b", 1, "old"), ("b", 2, "new"), ("a", 1, "x"), (None, 1, "y")], "k string, t int, v string")
    got = {r.k: r for r in star.entity_dimension(df, "k", "sk", [F.col("t")], ["v"], at).collect()}
    assert {k: (r.sk, r.v, r.is_active, r.created_at.year, r.updated_at.year) for k, r in got.items()} == {"a": (1, "x", True, 2025, 2025), "b": (2, "new", True, 2025, 2025)}


def test_small_cleaners(spark):
    df = spark.createDataFrame([("", "Yes", 1.0, 0.0, "No. 5"), ("a", "odd", 1.0, 2.0, "5")], "t string, level string, a double, b double, p string")
    got = clean.empty_to_null(df, ["t"]).select("t", clean.in_enum(F.col("level"), ["Yes", "No"]).alias("ok"), clean.guarded_ratio(F.col("a"), F.col("b")).alias("r"), clean.strip_prefix(F.col("p"), r"No\. ").alias("p")).collect()
    assert [tuple(r) for r in got] == [(None, True, 0.0, "5"), ("a", False, 0.5, "5")]
    scaled = forecast.coordinates(df.select("a", F.col("b")), ["b"]).select("scaled").collect()
    assert sorted(round(r.scaled[0], 6) for r in scaled) == [-0.707107, 0.707107]


def test_files(spark, tmp_path):
    for name in ("a_20240101_000000_x.csv", "a_20240201_000000_y.csv", "b_20230101_000000.csv"):
        (tmp_path / name).write_text("﻿Hotel Name,Note\n x ,\"two\nlines \"\"q\"\"\"\n")
    latest = {r.base: r.path for r in files.latest_files(files.listing(spark, str(tmp_path))).collect()}
    assert latest["a"].endswith("y.csv") and len(latest) == 2
    got = files.read_csv(spark, latest["a"], multi_line=True)
    assert got.columns == ["hotel_name", "note"] and got.first().note == 'two\nlines "q"'
    assert files.checksums(spark, str(tmp_path)).select("file_checksum").distinct().count() == 1


def test_stream(spark, tmp_path):
    folder, tables = f"{tmp_path}/in", Tables(spark, f"{tmp_path}/t")
    first = rows(spark, [("a", 1, "x"), ("b", 2, "y")])
    for data in ([("a", 1, "x"), ("b", 2, "y")], [("a", 5, "x5"), ("c", 3, "z")]):
        rows(spark, data).write.mode("append").parquet(folder)
        stream_upsert(spark, folder, first.schema, tables, "dim", "k", "p", "row_checksum", f"{tmp_path}/c").awaitTermination()
    assert {(r.k, r.v) for r in tables.read("dim_1").collect()} == {("a", "x5"), ("b", "y"), ("c", "z")}


def test_dq_and_empty_tables(spark):
    df = spark.createDataFrame([], "k string, v double")
    got = {r.check_name: r.status for r in dq.check(df, "t", [dq.min_records(1), dq.null_pct("k"), dq.freshness("k", "2025-01-01 00:00:00")]).collect()}
    assert got == {"min_records": "FAIL", "null_pct_k": "PASS", "freshness_k": "WARN"}


def test_recursive_forecast(spark):
    df = spark.createDataFrame([("e", 202411, 10.0), ("e", 202412, 20.0), ("f", 202412, 5.0)], "k string, m int, v double")
    got = {(r.k, r.m): r.forecast for r in forecast.recursive(df, "k", "m", "v", 2).collect()}
    assert got == {("e", 202501): 16.25, ("e", 202502): 0.5 * 16.25 + 0.3 * 20 + 0.2 * 10, ("f", 202501): 5.0, ("f", 202502): 5.0}
    assert features.rolling_stddev(df, "k", "m", "v").filter("stddev_3 <> 0").count() == 0


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([("https://b",), ("https://a",), (None,), ("https://a/x",)], "k string")
    assert [(r.k, r.sk) for r in keys.surrogate_keys(df, "k", "sk").orderBy("sk").collect()] == [(None, 1), ("https://a", 2), ("https://a/x", 3), ("https://b", 4)]
    assert keys.surrogate_keys(df.limit(0), "k", "sk").count() == 0
    target = spark.createDataFrame([(None, "x", "1"), (1, "y", "2")], "k int, v string, s string")
    source = spark.createDataFrame([(None, "x", "1"), (1, "z", "3"), (1, "w", "4"), (2, "n", "5"), (2, "n", "5")], "k int, v string, s string")
    assert sorted(map(tuple, merge.upsert(target, source, ["k"], "s").collect()), key=str) == sorted([(None, "x", "1"), (1, "w", "4"), (2, "n", "5")], key=str)
    assert [tuple(r) for r in merge.append_new(target, source, "k").collect()] == [(2, "n", "5")]
    assert tuple(merge.append_stats(target, source, "k").first()) == (1, 4)
    other = spark.createDataFrame([(1, "b"), (1, "a")], "k int, d string")
    assert [r.v for r in joins.enrich_nulls(spark.createDataFrame([(1, None)], "k int, v string"), other, "k", "v", "d").collect()] == ["a"]


def test_filters(spark):
    df = spark.createDataFrame([("2024-02-01", "", True, 5.0), ("2024-03-01", "x", False, None), ("2023-03-01", None, None, 9.0)], "d string, t string, f boolean, v double")
    assert filters.with_text(df, "t").count() == 1 and filters.flagged(df, "f").count() == 1
    assert [filters.of_month(df, "d", *x).count() for x in ((2024, None), (None, 3), (2024, 3), (None, None))] == [2, 2, 1, 3]
    assert filters.at_most(df, F.col("v"), 6).count() == 2 and filters.at_most(df, F.col("v")).count() == 3
