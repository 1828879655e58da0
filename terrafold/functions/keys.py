"""Row checksums, surrogate keys and keep-latest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.operators.positions import positions


def row_checksum(*columns: Column) -> Column:
    """md5 over the columns' texts, NULL as empty, parted by a pipe."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)))


def keep_latest(df: DataFrame, keys: list[str], newest: list[Column]) -> DataFrame:
    """One row a key: that with the greatest newest, NULLs last. Give tiebreakers to make it stable. NULL keys are one key.

    The greatest is kept within tasks first, so a hot key does not gather its rows.
    """
    whole = df.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(F.max_by(F.struct(*df.columns), F.struct(*newest)).alias("_row"))
    return whole.select("_row.*")


def surrogate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Consecutive numbers from 1 in order of a key, without one global sort. NULL keys come first.

    Rows are numbered within ranges of the key, after the rows of earlier ranges, however keys are spread; see
    positions. The table in that order is written to the shared folder when this is called.
    """
    return positions(df, [F.col(key).asc_nulls_first()], "_place").withColumn(name, F.col("_place") + 1).drop("_place")


def next_keys(existing: DataFrame, new: DataFrame, key: str, name: str) -> DataFrame:
    """New rows numbered after the largest number given so far, so kept rows never change theirs."""
    top = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("_top"))
    return surrogate_keys(new, key, name).crossJoin(top).withColumn(name, F.col(name) + F.col("_top")).drop("_top")
