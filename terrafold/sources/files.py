"""Raw files: listing, latest versions and runs, checksums, CSV with and without given types."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from terrafold.functions.clean import unify_columns

def read_csv(spark: SparkSession, path: str, multi_line: bool = False, schema: StructType | None = None) -> DataFrame:
    """A CSV with header; all columns are strings unless a schema is given. Quotes are doubled inside quotes."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    if multi_line:
        reader = reader.option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    first = df.columns[0].lstrip("﻿")
    return unify_columns(df.withColumnRenamed(df.columns[0], first))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length, modified of the files below path; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"))


def checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """The same with the md5 of each file's bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", F.md5("content").alias("file_checksum"))


def latest_files(files: DataFrame, key: str = r"^(.*?)_\d{8}_\d{6}") -> DataFrame:
    """Of files named <base>_YYYYMMDD_HHMMSS..., the newest of each base."""
    stamped = files.withColumns({"base": F.regexp_extract("name", key, 1), "stamp": F.regexp_extract("name", r"(\d{8}_\d{6})", 1)}).filter("stamp <> ''")
    return stamped.groupBy("base").agg(F.max("stamp").alias("stamp"), F.max_by("path", F.struct("stamp", "path")).alias("path"))


def latest_run(files: DataFrame) -> DataFrame:
    """The files of the newest run_YYYYMMDD_HHMMSS folder."""
    runs = files.withColumn("run", F.regexp_extract("path", r"/(run_\d{8}_\d{6})/", 1)).filter("run <> ''")
    return runs.join(F.broadcast(runs.agg(F.max("run").alias("run"))), "run")


def read_lines(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(line, source_file): a row for each line of the text files below path."""
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).text(path)
    return lines.select(F.col("value").alias("line"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("source_file"))


def with_source(df: DataFrame, taken: Column | None = None) -> DataFrame:
    """df, read from files, with where each row comes from: source_file, source_file_size_bytes, ingestion_timestamp.

    taken is the time of ingestion, else now.
    """
    file = F.col("_metadata")
    return df.select("*", file["file_name"].alias("source_file"), file["file_size"].alias("source_file_size_bytes"), (F.current_timestamp() if taken is None else taken).alias("ingestion_timestamp"))


def read_latest_run(spark: SparkSession, root: str) -> DataFrame:
    """The Parquet files of the newest run_YYYYMMDD_HHMMSS folder below root, all partitions of it.

    The folder's name is the only thing that comes to the driver. ValueError if there is no run.
    """
    newest = latest_run(listing(spark, root, "*.parquet")).select(F.regexp_extract("path", r"^(.*/run_\d{8}_\d{6})/", 1).alias("folder")).first()
    if newest is None:
        raise ValueError(f"no run below {root}")
    return spark.read.parquet(newest.folder)


#: Types that a column of texts may have, the narrowest first; a text column is left where none fits.
_KINDS = ("int", "bigint", "double", "boolean", "date", "timestamp")


def read_csv_inferred(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """The CSV files below path as one table, with types that hold for all of them.

    Each file's first row names its columns, in any order; a byte-order mark is no part of the first name. Files that
    lack a column have NULL there. Names are stripped, lower-cased, with blanks as underscores, before anything is
    inferred. A column has the narrowest type that all its texts in all files can be read as; empty texts are NULL,
    and a column of those is text. Cells may hold newlines in quotes. What comes to the driver is the different
    header rows, and one row of types. Rows equal to their file's header are headers.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("encoding", "UTF-8")
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    heads = lines.filter("at = 0").groupBy("path").agg(F.first("value").alias("head")).select("path", F.regexp_replace("head", "^\ufeff", "").alias("head"))
    kinds = [r.head for r in heads.select("head").distinct().orderBy("head").collect()]
    names = {h: [c.strip().replace(" ", "_").lower() for c in next(csv.reader([h]), [])] for h in kinds}
    width = max(map(len, names.values()), default=0)
    if not width:
        return spark.createDataFrame([], StructType())
    schema = StructType([StructField(f"_c{i}", StringType()) for i in range(width)])
    cells = reader.option("multiLine", True).option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).schema(schema).csv(path)
    told = cells.select("*", F.col("_metadata.file_path").alias("path")).join(heads, "path")
    columns = list(dict.fromkeys(c for own in names.values() for c in own))
    tables = []
    for head, own in names.items():
        written = [c.strip() for c in next(csv.reader([head]))]
        is_head = reduce(lambda a, b: a & b, (F.regexp_replace(F.col(f"_c{i}"), "^\ufeff", "").eqNullSafe(F.lit(c)) for i, c in enumerate(written)))
        place = {c: i for i, c in enumerate(own)}
        rows = told.filter((F.col("head") == head) & ~is_head)
        tables.append(rows.select(*((F.nullif(F.col(f"_c{place[c]}"), F.lit("")) if c in place else F.lit(None).cast("string")).alias(c) for c in columns)))
    texts = reduce(DataFrame.unionByName, tables)
    quoted = {c: f"`{c.replace('`', '``')}`" for c in columns}
    fits = lambda c, kind: F.bool_and(F.col(quoted[c]).isNull() | _as(F.col(quoted[c]), kind).isNotNull())
    found = texts.agg(*(F.coalesce(fits(c, kind), F.lit(False)).alias(f"{i}_{kind}") for i, c in enumerate(columns) for kind in _KINDS), *(F.count(quoted[c]).alias(f"{i}_n") for i, c in enumerate(columns))).first()
    chosen = {c: next((k for k in _KINDS if found[f"{i}_n"] and found[f"{i}_{k}"]), "string") for i, c in enumerate(columns)}
    return texts.select(*(_as(F.col(quoted[c]), chosen[c]).alias(c) for c in columns))


def _as(text: Column, kind: str) -> Column:
    """text as that type, NULL where it cannot be."""
    if kind == "boolean":
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    if kind == "date":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    if kind == "timestamp":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return text if kind == "string" else text.try_cast(kind)
