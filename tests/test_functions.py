"""Edge cases of parsing, cleaning, keys and text features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrafold.functions import clean, keys, parse, text


def one(spark, column, *values, names="abc"):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names[: len(values)]))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(("raw", "want"), [("1234", 1234), ("36.6K", 36600), ("32.3K", 32300), ("4.1M", 4100000), ("22K", 22000), (" 7 ", 7), ("N/A", None), ("", None), ("1.2k", None), ("1,234", None), ("..K", None), (None, None)])
def test_compact_number(spark, raw, want):
    assert one(spark, parse.compact_number(F.col("a")), raw) == want


@pytest.mark.parametrize(("raw", "want"), [("Ngày đánh giá: ngày 5 tháng 10 năm 2024", dt.date(2024, 10, 5)), ("ngày 31 tháng 2 năm 2024", None), ("?", None), (None, None)])
def test_long_date(spark, raw, want):
    assert one(spark, parse.long_form_date(F.col("a")), raw) == want


@pytest.mark.parametrize(("raw", "want"), [("tháng 10/2024", dt.date(2024, 10, 1)), ("Tháng: 9 2023", dt.date(2023, 9, 1)), ("tháng 13/2024", None), (None, None)])
def test_month_date(spark, raw, want):
    assert one(spark, parse.month_year_date(F.col("a")), raw) == want


@pytest.mark.parametrize(("raw", "want"), [("6/9/2025", dt.date(2025, 6, 9)), ("30/11/2024", dt.date(2024, 11, 30)), ("30-11-2024", dt.date(2024, 11, 30)), ("2025-04-17", dt.date(2025, 4, 17)), ("", None)])
def test_multi_format(spark, raw, want):
    assert one(spark, parse.multi_format_date(F.col("a")), raw) == want


@pytest.mark.parametrize(("raw", "want"), [("8-9-2025", dt.date(2025, 9, 8)), ("08-09-2025", dt.date(2025, 9, 8)), ("2025-09-08", dt.date(2025, 9, 8)), ("3 ngày trước", dt.date(2025, 3, 28)), ("2 tuần trước", dt.date(2025, 3, 17)), ("1 tháng trước", dt.date(2025, 2, 28)), ("5 giờ trước", dt.date(2025, 3, 30)), ("10 phút trước", dt.date(2025, 3, 31)), ("vừa xong", dt.date(2025, 3, 31)), ("abc", None), (None, None)])
def test_relative(spark, raw, want):
    assert one(spark, parse.relative_date(F.col("a"), F.to_timestamp(F.lit("2025-03-31 02:00:00"))), raw) == want


def test_timestamps_and_flags(spark):
    assert one(spark, parse.js_timestamp(F.col("a")), "Sat Sep 27 2025 00:52:04 GMT+0700 (Indochina Time)") == dt.datetime(2025, 9, 27, 0, 52, 4)
    assert one(spark, parse.scrape_timestamp(F.col("a")), "2025-09-27T00-52-04") == dt.datetime(2025, 9, 27, 0, 52, 4)
    assert [one(spark, parse.text_flag(F.col("a")), x) for x in ("0", "TRUE", "x", None)] == [False, True, None, None]
    assert [one(spark, parse.yes_no_level(F.col("a")), x) for x in ("Yes", " no", "?")] == [2, 1, None]
    assert one(spark, parse.number(F.col("a")), "Điểm 8.7") == 8.7 and one(spark, parse.number(F.col("a")), "") is None
    assert one(spark, parse.first_integer(F.col("a")), "1.234 đánh giá") == 1 and one(spark, parse.decimal_comma(F.col("a")), "8,5") == 8.5
    assert spark.range(1).select(parse.shift_month(F.lit(202411), 3).alias("x"), parse.days_in_month(F.lit(202402)).alias("y")).first() == (202502, 29)


def test_cleaning(spark):
    assert one(spark, clean.clean_text(F.col("a")), " <b>Đẹp</b> 😍! https://x.y/z\n+1 ") == "đẹp ! 1"
    assert one(spark, clean.clean_list(F.col("a")), "WiFi,  , Hồ bơi,, Bar, Xem tất cả 12 tiện nghi") == "WiFi, Hồ bơi, Bar"
    assert [one(spark, clean.flatten_pairs(F.col("a")), x) for x in ("{'Sạch sẽ': '8,1', 'Tiện nghi': ''}", "{}", "broken", None)] == ["Sạch sẽ: 8,1", None, None, None]
    assert one(spark, clean.fold_accents(F.col("a")), "  Việt  ÉTÉ") == "viet ete"
    assert one(spark, clean.fold_accents(F.col("a")), "ÉTÉ  ñ Đường") == "ete n đuong"
    assert one(spark, clean.clean_text(F.col("a")), "one<br>two www.x.y/z three") == "one two three"
    assert one(spark, clean.aliased(F.col("a"), clean.PROVINCE_ALIASES), "Huế") == "Thừa Thiên Huế"
    df = spark.createDataFrame([("0", " x ", 1), (" ", "y", 2), (None, "0", 3)], "a string, b string, n int")
    assert [tuple(r) for r in clean.trim_strings(clean.invalid_to_null(df)).collect()] == [(None, "x", 1), (None, "y", 2), (None, None, 3)]
    kept, rejected = clean.require(clean.invalid_to_null(df), ["b", "a"])
    assert kept.count() == 0 and {r.n: r.reject_reason for r in rejected.collect()} == {1: "a", 2: "a", 3: "b"}


def test_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("bb", 1, None)], "k string, t int, v string")
    assert {(r.k, r.v) for r in keys.keep_latest(df, ["k"], [df.t]).collect()} == {("a", "y"), ("bb", None)}
    many = spark.createDataFrame([(f"{i:03d}",) for i in range(250)] + [("",), ("é",)], "k string")
    got = [r.sk for r in keys.surrogate_keys(many, "k", "sk").orderBy("sk").collect()]
    assert got == list(range(1, 253))
    new = keys.next_keys(spark.createDataFrame([("a", 7)], "k string, sk long"), spark.createDataFrame([("b",), ("c",)], "k string"), "k", "sk")
    assert {(r.k, r.sk) for r in new.collect()} == {("b", 8), ("c", 9)}
    same = df.select(keys.row_checksum(F.lit(None).cast("string"), F.lit("a")).alias("x"), keys.row_checksum(F.lit(""), F.lit("a")).alias("y")).first()
    assert same.x == same.y


def test_words_after_many_characters(spark):
    df = spark.createDataFrame([("x " * 3000 + "good great love, cheap food!! 😍",)], "t string")
    r, w = text.comment_features(df, "t").first(), text.weak_labels(df, "t").first()
    assert (r.n_words, r.n_exclaim, r.sentiment, r.n_positive, r.n_emoji) == (3006, 2, 1, 3, 1)
    assert (w.label, w.aspect_price) == ("positive", 1)


def test_weak_labels(spark):
    rows = [(1, "Great great food, love it!!"), (2, "awful trash. but good price"), (3, "ok"), (4, ""), (5, None), (6, "plain words here"), (7, "good bad")]
    got = {r.i: r for r in text.weak_labels(spark.createDataFrame(rows, "i int, t string"), "t").collect()}
    assert (got[1].label, got[1].aspect_food) == ("positive", 1) and got[1].confidence > 0.6
    assert got[2].label == "negative" and got[2].aspect_price == 1
    assert [got[i].label for i in (3, 4, 5, 6, 7)] == ["neutral"] * 5 and [got[i].confidence for i in (4, 6, 7)] == [0.3, 0.4, 0.5]
    assert one(spark, text.multi_hot(F.col("a"), ["x", "y"]), "y, z") == [0, 1]
