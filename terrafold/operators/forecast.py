"""Segments and recursive forecasts on pyspark.ml and grouped pandas functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.functions.parse import shift_month
from terrafold.operators import clusters


def _scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    vectors = VectorAssembler(inputCols=columns, outputCol="_raw").transform(df)
    return StandardScaler(inputCol="_raw", outputCol="features", withMean=True).fit(vectors).transform(vectors).drop("_raw")


def segments(df: DataFrame, columns: list[str], k: int = 3, seed: int = 7, starts: int = 1) -> tuple[DataFrame, float]:
    """Rows with their cluster, the best of starts fits, and the silhouette of the clustering."""
    scaled = _scaled(df, columns).persist()
    found = clusters.best_kmeans(scaled, "features", k, starts, 20, seed).transform(scaled)
    score = ClusteringEvaluator().evaluate(found)
    scaled.unpersist()
    return found.withColumnRenamed("prediction", "cluster").drop("features"), score


def named_segments(df: DataFrame, value: str) -> DataFrame:
    """Clusters named by how their mean value compares with that of all rows."""
    means = df.groupBy("cluster").agg(F.avg(value).alias("_own"), F.count("*").alias("n")).crossJoin(F.broadcast(df.agg(F.avg(value).alias("_all"))))
    name: Column = F.when(F.col("_own") >= F.col("_all") * 1.1, "premium").when(F.col("_own") <= F.col("_all") * 0.9, "budget").otherwise("standard")
    return means.select("cluster", "n", name.alias("segment"))


def boosted(train: DataFrame, test: DataFrame, columns: list[str], target: str) -> DataFrame:
    """test with the predictions of boosted trees."""
    assemble = VectorAssembler(inputCols=columns, outputCol="features")
    return GBTRegressor(labelCol=target, maxIter=10, seed=7).fit(assemble.transform(train)).transform(assemble.transform(test)).drop("features")


def recursive(df: DataFrame, entity: str, month: str, value: str, steps: int = 12, weights: tuple[float, ...] = (0.5, 0.3, 0.2)) -> DataFrame:
    """steps months ahead for each entity: each is the weighted mean of the last values, forecasts included.

    An entity has one row a month, so its group is as long as its history; entities are forecast apart.
    """
    n = len(weights)
    recent = df.groupBy(entity).agg(F.slice(F.sort_array(F.collect_list(F.struct(F.col(month).alias("m"), F.col(value).cast("double").alias("v"))), asc=False), 1, n).alias("last"))

    def ahead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, last in zip(batch["key"], batch["last"], strict=True):
                past = [r["v"] for r in last]
                base = int(last[0]["m"])
                for h in range(1, steps + 1):
                    new = total = 0.0
                    for w, v in zip(weights, past, strict=False):  # added in order, as SQL adds
                        new, total = new + w * v, total + w
                    new /= total
                    change = None if not past or past[0] == 0 else (new - past[0]) / past[0] * 100
                    out.append((key, base, h, new, change))
                    past = [new, *past][:n]
            yield pd.DataFrame(out, columns=["key", "base", "horizon", "forecast", "growth_pct"])

    kind = df.schema[entity].dataType.simpleString()
    rows = recent.select(F.col(entity).alias("key"), "last").mapInPandas(ahead, f"key {kind}, base int, horizon int, forecast double, growth_pct double")
    return rows.select(F.col("key").alias(entity), shift_month(F.col("base"), F.col("horizon")).alias(month), "horizon", "forecast", "growth_pct")


def cluster_features(counts: DataFrame, groups: list[str], total: str) -> dict[str, Column]:
    """Ratios and log size that segments are built on."""
    return {f"{g}_ratio": F.when(F.col(total) > 0, F.col(g) / F.col(total)).otherwise(0.0) for g in groups} | {"log_total": F.round(F.log1p(F.col(total)), 4)}


def coordinates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Standardised columns as one array, for reports."""
    return _scaled(df, columns).withColumn("scaled", vector_to_array("features")).drop("features")
