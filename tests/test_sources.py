"""Embedded files, batches of files, inferred CSV, runs and lines."""

import datetime

import pytest
from pyspark.sql import functions as F

from terrafold.sources import embedded, files
from terrafold.sources.tables import Tables
from terrafold.streaming.ingest import ingest_embedded

HEAD = """Thời gian cào: Sat Sep 27 2025 00:52:04 GMT+0700 (Indochina Time)
Post URL: "https://example.org/@a/video/1"
Người đăng: An "B" C
Tag người đăng: @an
URL người đăng: https://example.org/@a
Thời gian đăng: 8-9-2025
Số lượt tym: 36.6K
Số lượt comment: 1234
Số lượt lưu:
Số lượt share: N/A
"""
AFTER = """Số bình luận cấp 1: 3
Số bình luận cấp 2: 1
Tổng số bình luận thực tế đã load: 4
Số bình luận TikTok hiển thị: 5
Chênh lệch số bình luận: 1

"""
TABLE = "STT,Tên,Tag tên,URL,Comment,Time,Likes,Level Comment,Replied To Tag Name,Number of Replies\n"
ROWS = [
    '1,An,@an,u,"hi, ""you""\nall",3 ngày trước,22K,No,---,2\n',
    ",Bình,@b,u,blank number,vừa xong,,Yes,@an,0\n",
    "2,C,@c,u,shifted, by a comma,1 tuần trước,5,No,,\n",
    "3,D,@d,u,,x,1,No,,0\n",
    "4,E\n",
    "\n",
    "5,F,@f,u,last,8-9-2025,1,,,0,more\n",
]
ONE, THREE = 'Mô tả của bài đăng: "short"\n', 'Mô tả của bài đăng: "first\n  second: Post URL: no\n third" \n'
NAME = "tiktok_comments_optimized_2025-09-27T10-40-30_20251030_081316_0c64460f.csv"


def test_header_and_rows():
    for text, told in ((ONE, "short"), (THREE, "first\nsecond: Post URL: no\nthird")):
        found = embedded.parse(HEAD + text + AFTER + TABLE + "".join(ROWS))
        assert found.reason is None
        assert found.fields == {
            "crawl_time": "Sat Sep 27 2025 00:52:04 GMT+0700 (Indochina Time)", "post_url": "https://example.org/@a/video/1", "author": 'An "B" C', "author_tag": "@an",
            "author_url": "https://example.org/@a", "post_date": "8-9-2025", "likes": "36.6K", "comments_count": "1234", "saves": None, "shares": "N/A", "post_description": told,
            "comments_level1": "3", "comments_level2": "1", "comments_loaded": "4", "comments_displayed_tiktok": "5", "comments_difference": "1",
        }
        assert found.rows[0] == ["1", "An", "@an", "u", 'hi, "you"\nall', "3 ngày trước", "22K", "No", "---", "2"]
        assert found.rows[4] == ["4", "E", *[None] * 8] and found.rows[5][4] == "last" and len(found.rows) == 6


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("", "too few lines"),
        ("\n".join(HEAD.splitlines()[:9]) + "\n" + ONE + AFTER, "too few lines"),
        (HEAD + AFTER + TABLE * 3, "no description"),
        (HEAD + ONE + TABLE * 8, "description without end"),
        (HEAD.replace("Post URL:", "Post:") + ONE + AFTER + TABLE, "no post_url"),
        (HEAD.replace('"https://example.org/@a/video/1"', '""') + ONE + AFTER + TABLE, "no post_url"),
    ],
)
def test_rejected(text, reason):
    assert embedded.parse(text) == (reason, {}, [])


def test_tables_that_are_missing_or_empty():
    for rest in (TABLE, TABLE.replace("Likes", "Liked") + "".join(ROWS), ""):
        found = embedded.parse((HEAD + ONE + AFTER + rest).replace("\n", "\r\n"))
        assert found.reason is None and found.rows == [] and found.fields["author_tag"] == "@an"
    assert len(embedded.parse(HEAD + 'Mô tả của bài đăng:  x\x85\n' + AFTER + TABLE + ROWS[1]).rows) == 1


def test_other_format():
    form = embedded.Format({"id=": "id"}, ("note=", "note"), {"end=": "n"}, {"A": "a", "B": "b"}, "id", 3, 1)
    assert embedded.parse('id= 7\nnote=x\n y\nend=2\nA,B\n1,"2\n3"\n', form) == (None, {"id": "7", "note": "x\ny", "n": "2"}, [["1", "2\n3"]])


def test_frames(spark, tmp_path):
    (tmp_path / NAME).write_text(HEAD + THREE + AFTER + TABLE + "".join(ROWS))
    (tmp_path / "plain.csv").write_text(HEAD.replace("video/1", "video/2") + ONE + AFTER + TABLE)
    (tmp_path / "short.csv").write_text("nothing")
    (tmp_path / "mark.csv").write_text("\ufeff" + HEAD + ONE + AFTER + TABLE)
    found = embedded.read_embedded(spark, str(tmp_path))
    posts = {r.source_file: r for r in embedded.posts(found).collect()}
    assert set(posts) == {NAME, "plain.csv", "mark.csv"} and posts[NAME].scrape_timestamp == "2025-09-27T10-40-30" and posts["plain.csv"].scrape_timestamp is None
    assert posts[NAME].source_file_size_bytes == (tmp_path / NAME).stat().st_size and posts["plain.csv"].post_description == "short"
    whole, broken = embedded.split_comments(embedded.comments(found))
    assert sorted(r.comment for r in whole.collect()) == ["blank number", 'hi, "you"\nall']
    assert {r.stt: r.reject_reason for r in broken.collect()} == {"2": "shifted columns", "3": "no text", "4": "no text", "5": "shifted columns"}
    assert [(r.source_file, r.reason) for r in embedded.rejected_files(found).collect()] == [("short.csv", "too few lines")]


def test_ingest(spark, tmp_path):
    folder, tables = tmp_path / "in", Tables(spark, f"{tmp_path}/t")
    folder.mkdir()
    names, run = ("s.posts", "s.comments", "s.log"), lambda: ingest_embedded(spark, str(folder), tables, ("s.posts", "s.comments", "s.log"), f"{tmp_path}/c", batch_files=2)
    for i in range(5):
        (folder / f"f{i}.csv").write_text(HEAD.replace("video/1", f"video/{i}") + ONE + AFTER + TABLE + "".join(ROWS))
    (folder / "bad.csv").write_bytes(b"\xff\xfe\x00broken")
    stream = run()
    stream.awaitTermination()
    assert len([p for p in stream.recentProgress if p["numInputRows"]]) == 3
    log = {r.source_file: r for r in tables.read("s.log").collect()}
    assert len(log) == 6 and log["bad.csv"].status == "failed" and log["bad.csv"].error_message == "not UTF-8" and log["f0.csv"].records == 7
    assert tables.read("s.posts").count() == 5 and tables.read("s.comments").count() == 10
    again = run()
    again.awaitTermination()
    assert not any(p["numInputRows"] for p in again.recentProgress) and tables.read(names[0]).count() == 5
    (folder / "late.csv").write_text(HEAD.replace("video/1", "video/9") + ONE + AFTER + TABLE)
    run().awaitTermination()
    assert tables.read("s.posts").count() == 6 and tables.read("s.log").filter("source_file = 'late.csv'").first().batch == 3


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Id,Some Day,Mixed,Flag,Text,Empty\n1,2024-01-02,5,true,\"a\nb, \"\"c\"\"\",\n 2 ,,6,FALSE,x,\n")
    (tmp_path / "b.csv").write_text("Mixed,Id,Some Day,Extra\n1.5,30000000000,2024-02-30,2024-01-01 10:00:00\n,,2024-03-01,\n")
    (tmp_path / "c.csv").write_text("﻿Id,Some Day,Mixed,Flag,Text,Empty\n")
    df = files.read_csv_inferred(spark, str(tmp_path))
    assert dict(df.dtypes) == {"id": "bigint", "some_day": "string", "mixed": "double", "flag": "boolean", "text": "string", "empty": "string", "extra": "timestamp"}
    got = {r.id: r for r in df.collect()}
    assert len(got) == 4 and got[1].text == 'a\nb, "c"' and got[1].mixed == 5.0 and got[2].flag is False and got[30000000000].extra == datetime.datetime(2024, 1, 1, 10) and got[None].mixed is None
    one = files.read_csv_inferred(spark, str(tmp_path), "a.csv")
    assert dict(one.dtypes)["id"] == "int" and dict(one.dtypes)["some_day"] == "date"


def test_lines_runs_and_sources(spark, tmp_path):
    (tmp_path / "x.txt").write_text("one\n\ntwo")
    assert sorted((r.line, r.source_file) for r in files.read_lines(spark, f"{tmp_path}/x.txt").collect()) == [("", "x.txt"), ("one", "x.txt"), ("two", "x.txt")]
    for run, v in (("run_20240101_000000", 1), ("run_20250101_000000", 2)):
        spark.createDataFrame([(v, "p"), (v, "q")], "v int, part string").write.partitionBy("part").parquet(f"{tmp_path}/{run}")
    newest = files.read_latest_run(spark, str(tmp_path))
    assert sorted((r.v, r.part) for r in newest.collect()) == [(2, "p"), (2, "q")]
    runs = files.latest_run(files.listing(spark, str(tmp_path), "*.parquet"))
    assert {r.run for r in runs.collect()} == {"run_20250101_000000"}
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no run"):
        files.read_latest_run(spark, f"{tmp_path}/none")
    found = files.with_source(spark.read.parquet(f"{tmp_path}/run_20240101_000000"), F.timestamp_seconds(F.lit(0))).collect()
    assert {r.source_file.endswith(".parquet") and r.source_file_size_bytes > 0 and r.ingestion_timestamp.year == 1970 for r in found} == {True}
