"""Files with a header of labelled lines, a description of many lines, and a table below: posts, comments, rejects.

A file is read whole and parsed where it is read, line by line, by a
machine with four states: labels before the description, the description, labels
after it, and the table. What labels there are, and where they stand, is a
Format; the values of the format's own are fixed.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines end as Spark's text source ends them; other separators belong to a line.
_LINE_END = re.compile("\r\n|\n|\r")


class Format(NamedTuple):
    """Labels and the fields they fill, in the three parts of a header, and the names of the table's columns."""

    before: dict[str, str]
    description: tuple[str, str]
    after: dict[str, str]  # the first of these labels ends the description
    table: dict[str, str]
    required: str  # a file without this field is rejected
    least_lines: int  # with fewer, there is no header
    reach: int  # lines from the end of the description in which the labels after it are looked for

    @property
    def fields(self) -> list[str]:
        return [*self.before.values(), self.description[1], *self.after.values()]


#: Labels and columns of files of post comments.
POST_COMMENTS = Format(
    before={
        "Thời gian cào:": "crawl_time",
        "Post URL:": "post_url",
        "Người đăng:": "author",
        "Tag người đăng:": "author_tag",
        "URL người đăng:": "author_url",
        "Thời gian đăng:": "post_date",
        "Số lượt tym:": "likes",
        "Số lượt comment:": "comments_count",
        "Số lượt lưu:": "saves",
        "Số lượt share:": "shares",
    },
    description=("Mô tả của bài đăng:", "post_description"),
    after={
        "Số bình luận cấp 1:": "comments_level1",
        "Số bình luận cấp 2:": "comments_level2",
        "Tổng số bình luận thực tế đã load:": "comments_loaded",
        "Số bình luận TikTok hiển thị:": "comments_displayed_tiktok",
        "Chênh lệch số bình luận:": "comments_difference",
    },
    table={
        "STT": "stt",
        "Tên": "ten",
        "Tag tên": "tag_ten",
        "URL": "url",
        "Comment": "comment",
        "Time": "time",
        "Likes": "likes",
        "Level Comment": "level_comment",
        "Replied To Tag Name": "replied_to_tag_name",
        "Number of Replies": "number_of_replies",
    },
    required="post_url",
    least_lines=17,
    reach=10,
)
#: How those files are named, with the time they were scraped at.
POST_COMMENTS_NAME = r"tiktok_comments_(?:optimized_)?(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})_\d{8}_\d{6}_[a-f0-9]{8}\.csv"


class Parsed(NamedTuple):
    reason: str | None
    fields: dict[str, str | None]
    rows: list[list[str | None]]


def _value(text: str) -> str | None:
    """Stripped, without a pair of quotes around it; empty is None."""
    text = text.strip()
    if text.startswith('"') and text.endswith('"'):
        text = text[1:-1]
    return text or None


def parse(text: str, form: Format = POST_COMMENTS) -> Parsed:
    """The header's fields and the table's rows; or a reason why there are none.

    A label's first line counts, even where its value is empty. Rows are shorter or longer than the table's columns in
    broken files: what is missing is None, what is too much goes. Blank lines of the table are skipped. A table
    without a header row has no rows, which is no reason to reject the file.
    """
    lines = _LINE_END.split(text)
    if lines and not lines[-1]:
        lines.pop()
    if len(lines) < form.least_lines:
        return Parsed("too few lines", {}, [])
    label, name = form.description
    anchor = next(iter(form.after))
    fields: dict[str, str | None] = dict.fromkeys(form.fields)
    found: set[str] = set()

    def labelled(line: str, labels: dict[str, str]) -> None:
        for own, field in labels.items():
            if own not in found and own in line:
                found.add(own)
                fields[field] = _value(line.split(own, 1)[1])

    state, told, since = "before", [], 0
    body: list[str] | None = None
    for line in lines:
        if state == "before":
            if label in line:
                state, told = "description", [line.split(label, 1)[1].strip()]
            else:
                labelled(line, form.before)
            if anchor in line:
                if state == "before":
                    return Parsed("no description", {}, [])
                state = "after"
        elif state == "description":
            if anchor in line:
                state = "after"
            else:
                told.append(line.strip())
        if state == "after":
            if since < form.reach:
                labelled(line, form.after)
            since += 1
            if line.strip().startswith(f"{next(iter(form.table))},") and all(c in line for c in form.table):
                state, body = "table", [line]
        elif state == "table":
            body.append(line)
    if state == "before":
        return Parsed("no description", {}, [])
    if state == "description":
        return Parsed("description without end", {}, [])
    whole = _value("\n".join(told))
    fields[name] = whole.strip() or None if whole else None
    if not fields[form.required]:
        return Parsed(f"no {form.required}", {}, [])
    return Parsed(None, fields, list(_rows(body or [], form)))


def _rows(body: list[str], form: Format) -> Iterator[list[str | None]]:
    records = csv.reader(f"{line}\n" for line in body)
    place = {c.strip(): i for i, c in enumerate(next(records, []))}
    for record in records:
        if record:
            yield [record[i] if (i := place.get(c, len(record))) < len(record) else None for c in form.table]


def read_embedded(spark: SparkSession, path: str, pattern: str = "*.csv", form: Format = POST_COMMENTS, name: str = POST_COMMENTS_NAME) -> DataFrame:
    """A row for each file below path: source_file, source_file_size_bytes, scrape_timestamp, reason, fields, rows."""
    return parsed(spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path), form, name)


def parsed(files: DataFrame, form: Format = POST_COMMENTS, name: str = POST_COMMENTS_NAME) -> DataFrame:
    """The same of files read as binaryFile, by batch or stream. scrape_timestamp is NULL where the name has none.

    A task holds one file at a time, whole. A file that cannot be parsed is a row with a reason, and stops no other.
    """
    schema = "path string, size long, reason string, fields map<string,string>, rows array<array<string>>"

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size, content in zip(batch["path"], batch["length"], batch["content"], strict=True):
                try:
                    found = parse(content.decode("utf-8-sig"), form)
                except UnicodeDecodeError:
                    found = Parsed("not UTF-8", {}, [])
                except csv.Error as broken:
                    found = Parsed(f"broken table: {broken}", {}, [])
                yield pd.DataFrame([[path, size, found.reason, found.fields, found.rows]], columns=["path", "size", "reason", "fields", "rows"])

    rows = files.select("path", "length", "content").mapInPandas(task, schema)
    file = F.element_at(F.split("path", "/"), -1)
    stamp = F.nullif(F.regexp_extract(file, name, 1), F.lit(""))
    return rows.select(file.alias("source_file"), F.col("size").alias("source_file_size_bytes"), stamp.alias("scrape_timestamp"), "reason", "fields", "rows")


_SOURCE = ("source_file", "source_file_size_bytes", "scrape_timestamp")


def posts(files: DataFrame, form: Format = POST_COMMENTS) -> DataFrame:
    """A row for each file that was parsed, with the header's fields as columns."""
    return files.filter("reason is null").select(*(F.col("fields")[f].alias(f) for f in form.fields), *_SOURCE)


def comments(files: DataFrame, form: Format = POST_COMMENTS) -> DataFrame:
    """A row for each row of each table, with its post's required field."""
    rows = files.filter("reason is null").select(F.col("fields")[form.required].alias(form.required), F.explode("rows").alias("row"), *_SOURCE)
    return rows.select(form.required, *(F.col("row")[i].alias(c) for i, c in enumerate(form.table.values())), *_SOURCE)


def rejected_files(files: DataFrame) -> DataFrame:
    return files.filter("reason is not null").select(*_SOURCE, "reason")


def split_comments(rows: DataFrame, text: str = "comment", level: str = "level_comment", levels: tuple[str, ...] = ("Yes", "No", "yes", "no", "YES", "NO")) -> tuple[DataFrame, DataFrame]:
    """Comments that are whole, and the others with reject_reason: columns shifted by a broken row, or no text."""
    shifted = F.col(level).isNotNull() & ~F.col(level).isin(*levels)
    reason: Column = F.when(shifted, "shifted columns").when(F.coalesce(F.trim(text), F.lit("")) == "", "no text")
    marked = rows.withColumn("reject_reason", reason)
    return marked.filter("reject_reason is null").drop("reject_reason"), marked.filter("reject_reason is not null")
