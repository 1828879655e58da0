"""Dimension lookups and incremental joins. Which side is broadcast is left to Catalyst, which knows the sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on: Column, columns: list[str]) -> DataFrame:
    """Left join; every fact row stays once if the dimension's key is unique."""
    return fact.join(dim, on, "left").select(*fact.columns, *columns)


def misses(joined: DataFrame, key: str) -> DataFrame:
    """One row: rows, and how many found nothing."""
    return joined.agg(F.count("*").alias("n_rows"), F.count_if(F.col(key).isNull()).alias("n_missing"))


def strict_lookup(fact: DataFrame, dim: DataFrame, on: Column, columns: list[str], key: str) -> DataFrame:
    """A lookup that fails on the first row without a match."""
    joined = lookup(fact, dim, on, columns)
    return joined.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"no match for {key}"))).otherwise(F.col(key)))


def fallback_lookup(fact: DataFrame, dim: DataFrame, first: tuple[str, str], second: tuple[str, str], sk: str) -> DataFrame:
    """dim's sk by the first pair of keys, else by the second. Each lookup side has one row a key: the least sk."""
    sides = [dim.filter(F.col(d).isNotNull()).groupBy(F.col(d).alias(f"_k{i}")).agg(F.min(sk).alias(f"_sk{i}")) for i, (_, d) in enumerate((first, second))]
    joined = fact.join(sides[0], F.col(first[0]) == F.col("_k0"), "left").join(sides[1], F.col("_sk0").isNull() & (F.col(second[0]) == F.col("_k1")), "left")
    return joined.select(*fact.columns, F.coalesce("_sk0", "_sk1").alias(sk))


def enrich_nulls(df: DataFrame, other: DataFrame, key: str, column: str, source: str) -> DataFrame:
    """column filled from other's source column where it is NULL; the least value where other repeats a key."""
    side = other.groupBy(F.col(key).alias("_key")).agg(F.min(source).alias("_value"))
    return df.join(side, F.col(column).isNull() & (F.col(key) == F.col("_key")), "left").withColumn(column, F.coalesce(column, "_value")).drop("_key", "_value")


def with_measure(rows: DataFrame, side: DataFrame, keys: dict[str, str], measure: str, default: float = 0) -> DataFrame:
    """rows with a measure of another table by several keys (of rows to those of side), such as comments with their likes.

    The greatest where side repeats its keys, so rows never fan out; default where it has none, or a key is NULL.
    """
    once = side.groupBy(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys.values()))).agg(F.max(measure).alias("_value"))
    match = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_{i}") for i, k in enumerate(keys)))
    return rows.join(once, match, "left").select(*rows.columns, F.coalesce("_value", F.lit(default)).alias(measure))


def with_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key), key, "left_anti")
