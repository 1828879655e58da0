"""Calendar, dimensions and facts of a star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.functions.keys import keep_latest, surrogate_keys


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A row a day: keys, names, ISO week and year, weekday, and boundary flags."""
    day = F.col("day")
    days = spark.sql("SELECT explode(sequence(to_date(:a), to_date(:b), interval 1 day)) AS day", args={"a": first, "b": last})
    ends = lambda unit: F.date_trunc(unit, day).cast("date") == day
    last_of = lambda unit: F.date_trunc(unit, F.date_add(day, 1)).cast("date") == F.date_add(day, 1)
    return days.select(
        (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).alias("date_sk"), day.alias("full_date"), F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), F.concat(F.lit("Q"), F.quarter(day)).alias("quarter_name"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), (F.year(day) * 100 + F.month(day)).alias("year_month"), F.weekofyear(day).alias("iso_week"),
        (F.expr("extract(yearofweek FROM day)") * 100 + F.weekofyear(day)).alias("iso_year_week"), (F.weekday(day) + 1).alias("iso_weekday"),
        (F.weekday(day) >= 5).alias("is_weekend"), ends("month").alias("is_month_start"), last_of("month").alias("is_month_end"),
        ends("quarter").alias("is_quarter_start"), last_of("quarter").alias("is_quarter_end"), ends("year").alias("is_year_start"), last_of("year").alias("is_year_end"),
    )


def value_dimension(df: DataFrame, column: str, sk: str) -> DataFrame:
    """The distinct, trimmed, non-empty values of a column with surrogate keys."""
    values = df.select(F.trim(F.col(column)).alias(column)).filter(F.col(column) != "").distinct()
    return surrogate_keys(values, column, sk)


def entity_dimension(df: DataFrame, key: str, sk: str, newest: list[Column], columns: list[str], at: Column) -> DataFrame:
    """The latest row of each key, with surrogate key and SCD-1 columns."""
    latest = keep_latest(df.filter(F.col(key).isNotNull()), [key], newest).select(key, *(c for c in columns if c != key))
    return surrogate_keys(latest, key, sk).withColumns({"created_at": at, "updated_at": at, "is_active": F.lit(True)})
