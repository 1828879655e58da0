"""Tree regressors on lag features: forests and boosted trees, folds in order of time, search, and recursive forecasts."""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.parse import shift_month
from terrafold.operators.analytics import forecast_metrics

#: The lags of a forecast that knows nothing but its own past and the season.
LAGS = (1, 2, 3, 12)
FEATURES = ("month_no", "month_sin", "month_cos", *(f"lag_{k}" for k in LAGS), "mean_3")
KINDS = {"forest": RandomForestRegressor, "boosted": GBTRegressor}


def _season(month: Column) -> dict[str, Column]:
    n = month % 100
    return {"month_no": n.cast("double"), "month_sin": F.sin(2 * math.pi * n / 12), "month_cos": F.cos(2 * math.pi * n / 12)}


def _of_history(history: Column) -> dict[str, Column]:
    """Lags of a history, the newest value first; a history that is too short gives its oldest value."""
    size = F.size(history)
    lag = {f"lag_{k}": F.element_at(history, F.least(F.lit(k), size)) for k in LAGS}
    last = F.slice(history, 1, 3)
    return lag | {"mean_3": F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last)}


def history_rows(df: DataFrame, entity: str, month: str, value: str) -> DataFrame:
    """entity, month, value and FEATURES for each row of an entity that has one before; at most 12 values are kept a row."""
    before = Window.partitionBy(entity).orderBy(month).rowsBetween(-max(LAGS), -1)
    past = df.select(entity, month, F.col(value).cast("double").alias(value)).withColumn("_past", F.reverse(F.collect_list(value).over(before)))
    return past.filter(F.size("_past") > 0).withColumns(_season(F.col(month)) | _of_history(F.col("_past"))).drop("_past")


def time_blocks(df: DataFrame, month: str, folds: int) -> DataFrame:
    """df with block, 0 to folds: the months in order, cut into equal stretches. Only the months meet in one task."""
    months = df.select(month).distinct()
    place = (F.row_number().over(Window.orderBy(month)) - 1) * (folds + 1) / F.count("*").over(Window.partitionBy())
    return df.join(months.select(month, F.floor(place).cast("int").alias("block")), month)


def fit(df: DataFrame, target: str, kind: str, params: dict, features: tuple[str, ...] = FEATURES, seed: int = 7) -> PipelineModel:
    """Trees of that kind (forest or boosted) on rows of features, as a pipeline that assembles them."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return PipelineModel([assembler, KINDS[kind](featuresCol="features", labelCol=target, seed=seed, **params).fit(assembler.transform(df))])


def search(df: DataFrame, month: str, target: str, kind: str, grid: list[dict], folds: int = 3, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """params (JSON), fold, n, rmse, mae, wape of every choice in the grid: fold i learns from blocks before i, and is tested on block i.

    So nothing is ever learnt from a later month. There are as many fits as choices and folds; the errors are
    computed when the result is read.
    """
    blocks = time_blocks(df, month, folds)
    scores = []
    for params in grid:
        for fold in range(1, folds + 1):
            model = fit(blocks.filter(F.col("block") < fold), target, kind, params, features)
            found = forecast_metrics(model.transform(blocks.filter(F.col("block") == fold)), target, "prediction", [])
            scores.append(found.select(F.lit(json.dumps(params, sort_keys=True)).alias("params"), F.lit(fold).alias("fold"), "n", "rmse", "mae", "wape"))
    return reduce(DataFrame.unionByName, scores)


def chosen(scores: DataFrame) -> dict:
    """The parameters with the least mean error over the folds; the first in order of equals."""
    best = scores.groupBy("params").agg(F.avg("rmse").alias("rmse")).orderBy("rmse", "params").first()
    return json.loads(best.params)


def forecast(df: DataFrame, entity: str, month: str, value: str, model: PipelineModel, steps: int = 12, low: float | None = None, high: float | None = None) -> DataFrame:
    """entity, month, horizon, forecast: steps months ahead by the fitted trees, forecasts feeding the next lags.

    An entity's state is its last 12 values. All steps are one chain of projections without a shuffle: Spark sends the
    trees to the tasks, and each entity's row is carried on there. Forecasts are kept between low and high, if given.
    """
    last = Window.partitionBy(entity).orderBy(F.desc(month))
    recent = df.select(entity, F.col(month).alias("_m"), F.col(value).cast("double").alias("_v"), F.row_number().over(last).alias("_n")).filter(F.col("_n") <= max(LAGS))
    ordered = F.sort_array(F.collect_list(F.struct("_n", "_m", "_v")))
    state = recent.groupBy(entity).agg(ordered.alias("_rows")).select(entity, F.col("_rows")[0]["_m"].alias("_base"), F.transform("_rows", lambda r: r["_v"]).alias("_past"), F.array().cast("array<double>").alias("_ahead"))
    for h in range(1, steps + 1):
        rows = model.transform(state.withColumns(_season(shift_month(F.col("_base"), F.lit(h))) | _of_history(F.col("_past"))))
        new = F.col("prediction")
        if low is not None:
            new = F.greatest(new, F.lit(low))
        if high is not None:
            new = F.least(new, F.lit(high))
        rows = rows.withColumn("_new", new)
        state = rows.select(entity, "_base", F.slice(F.concat(F.array("_new"), "_past"), 1, max(LAGS)).alias("_past"), F.concat("_ahead", F.array("_new")).alias("_ahead"))
    out = state.select(entity, "_base", F.posexplode("_ahead").alias("_at", "forecast"))
    return out.select(entity, shift_month(F.col("_base"), F.col("_at") + 1).alias(month), (F.col("_at") + 1).alias("horizon"), "forecast")
