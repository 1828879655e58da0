"""Filters that jobs take as parameters."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_text(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is neither NULL nor empty."""
    return df.filter(F.col(column) != "")


def of_month(df: DataFrame, date: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """Rows of a year, of a month, or of both; all rows where neither is given.

    With a year, dates are compared with the two ends of the period, so partitions and row groups outside it are not read.
    """
    if year is None:
        return df if month is None else df.filter(F.month(date) == month)
    first = datetime.date(year, month or 1, 1)
    after = datetime.date(year + 1, 1, 1) if month in (None, 12) else datetime.date(year, month + 1, 1)
    return df.filter((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(after)))


def flagged(df: DataFrame, column: str) -> DataFrame:
    """Rows whose boolean flag is true."""
    return df.filter(F.col(column))


def complete_months(df: DataFrame, month: str, as_of: int) -> DataFrame:
    """Rows of the months (yyyymm) before as_of, which is not complete yet."""
    return df.filter(F.col(month) < as_of)


def at_most(df: DataFrame, value: Column, most: float | None = None) -> DataFrame:
    """Rows whose value is at most most; NULL stays, and all rows where no limit is given."""
    return df if most is None else df.filter(value.isNull() | (value <= most))
