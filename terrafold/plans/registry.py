"""Queries by name, each with the SQL that must give the same rows, where there is such."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moved(key: str, every: int) -> F.Column:
    """The key, made negative where every divides it: rows of which all take part, and some find no match."""
    return F.when(F.col(key) % every == 0, -F.col(key)).otherwise(F.col(key))


def cents(column: str) -> F.Column:
    """Money as whole cents: sums of those are the same in any order."""
    return F.round(F.col(column) * 100).cast("long")
