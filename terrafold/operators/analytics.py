"""Reports, forecast metrics and recommendations over feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.operators import quantiles


def distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    """Count and percent of all rows by key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def histogram(df: DataFrame, value: Column, edges: list[int]) -> DataFrame:
    """One row: rows in [0, edge), [edge, next), ..., from the last on, NULL, and all."""
    counts, low = [], None
    for e in [*edges, None]:
        inside = (F.lit(True) if low is None else value >= low) & (F.lit(True) if e is None else value < e)
        counts.append(F.count_if(inside & value.isNotNull()).alias(f"from_{low or 0}"))
        low = e
    return df.agg(*counts, F.count_if(value.isNull()).alias("n_null"), F.count("*").alias("n_all"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def profile(df: DataFrame) -> DataFrame:
    """column_name, n_rows, n_null, n_distinct_approx-free null percent of every column, from one pass."""
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(c).alias("n_null")) for c in df.columns))).alias("r")
    return one.select(rows).select("r.*").withColumn("null_pct", F.when(F.col("n_rows") > 0, F.col("n_null") * 100.0 / F.col("n_rows")).otherwise(0.0))


def forecast_metrics(df: DataFrame, actual: str, predicted: str, keys: list[str]) -> DataFrame:
    """RMSE, MAE, R2, SMAPE, WAPE and MAPE (of positive actuals), by keys."""
    a, p = F.col(actual), F.col(predicted)
    e = F.abs(a - p)
    mean = F.avg(a)
    out = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("mae"),
        (1 - F.sum(e * e) / F.nullif(F.sum(a * a) - F.count(a) * mean * mean, F.lit(0.0))).alias("r2"),
        F.avg(F.when(F.abs(a) + F.abs(p) > 0, 2 * e / (F.abs(a) + F.abs(p))).otherwise(0.0)).alias("smape"),
        (F.sum(e) / F.nullif(F.sum(F.abs(a)), F.lit(0.0))).alias("wape"), F.avg(F.when(a > 0, e / a)).alias("mape"),
    )
    return out.select(*keys, "n", *(F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2", "smape", "wape", "mape")))


def tiers(df: DataFrame, entity: str, value: str) -> DataFrame:
    """low, mid and high entities by thirds of their mean value; the exact thirds are found when this is called."""
    means = df.groupBy(entity).agg((F.sum(value) / F.count(value)).alias("mean_value"))
    cuts = quantiles.exact(means, {"mean_value": [1 / 3, 2 / 3]}, between=True)
    low, middle = (F.lit(cuts["mean_value", q]) for q in (1 / 3, 2 / 3))
    return means.select(entity, F.when(F.col("mean_value") <= low, "low").when(F.col("mean_value") <= middle, "mid").otherwise("high").alias("tier"))


def time_split(df: DataFrame, month: str, train: float = 0.75, valid: float = 0.125) -> DataFrame:
    """train, valid or test by distinct months in order; only the months meet in one task."""
    months = df.select(month).distinct()
    place = F.row_number().over(Window.orderBy(month)) / F.count("*").over(Window.partitionBy())
    split = months.select(month, F.when(place <= train, "train").when(place <= train + valid, "valid").otherwise("test").alias("split"))
    return df.join(split, month)


def min_max(df: DataFrame, x: str, name: str) -> DataFrame:
    """df with x scaled to 0..1 as name; 0 where all are equal. One row of limits joins all rows."""
    limits = df.agg(F.min(x).alias("_low"), F.max(x).alias("_high"))
    scaled = F.when(F.col("_high") > F.col("_low"), (F.col(x) - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    return df.crossJoin(F.broadcast(limits)).withColumn(name, scaled).drop("_low", "_high")


def recommend(df: DataFrame, entity: str, volume: str, aspect: str, top: int) -> DataFrame:
    """The best entities by 0.4 of normalised volume and 0.6 of aspect, as an index of 0 to 100."""
    scored = min_max(df, volume, "_volume").withColumn("score", F.round(100 * (0.4 * F.col("_volume") + 0.6 * F.coalesce(F.col(aspect), F.lit(0.5))), 4))
    return scored.drop("_volume").orderBy(F.desc("score"), entity).limit(top)


def peak(df: DataFrame, entity: str, month: str, value: str) -> DataFrame:
    """Each entity's month with the most; the earliest of equals."""
    best = df.groupBy(entity).agg(F.max(F.struct(F.col(value).alias("v"), (-F.col(month)).alias("m"))).alias("best"))
    return best.select(entity, (-F.col("best.m")).alias(month), F.col("best.v").alias(value))


def rescaled(parts: list[str]) -> dict[str, Column]:
    """Columns scaled to sum to 1; a sum of 0 stays."""
    total = sum((F.col(p) for p in parts), start=F.lit(0))
    return {f"{p}_share": F.col(p) / F.when(total == 0, 1).otherwise(total) for p in parts}


def sequence_counts(df: DataFrame, entity: str, month: str, lengths: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """How many windows each length leaves: the sum over entities of max(months - length, 0)."""
    n = df.groupBy(entity).agg(F.countDistinct(month).alias("n"))
    return n.select("n", F.explode(F.array(*map(F.lit, lengths))).alias("length")).groupBy("length").agg(F.sum(F.greatest(F.col("n") - F.col("length"), F.lit(0))).alias("n_sequences"), F.count("*").alias("n_entities"))


def top_by_ratio(df: DataFrame, entity: str, value: str, count: str, top: int, name: str) -> DataFrame:
    """The entities with the highest sum of values over sum of counts."""
    sums = df.groupBy(entity).agg(F.sum(count).alias(count), F.sum(value).alias("_v"))
    return sums.select(entity, count, (F.col("_v") / F.nullif(F.col(count), F.lit(0))).alias(name)).orderBy(F.desc(name), entity).limit(top)


def layer_ratio(lower: DataFrame, upper: DataFrame, keys: list[str], lower_name: str, upper_name: str) -> DataFrame:
    """One row: rows of a layer and of the one made from it, their ratio, and the upper one's rows for each of its keys (inflation).

    Over 1, rows of a key were taken in more than once, or joined to several. Ratios over nothing are NULL.
    """
    a = lower.agg(F.count("*").alias("lower_rows"))
    b = upper.agg(F.count("*").alias("upper_rows"), F.countDistinct(*keys).alias("upper_keys"))
    over = lambda x, y: F.col(x) / F.nullif(F.col(y), F.lit(0))
    return a.crossJoin(b).select(F.lit(lower_name).alias("lower_table"), F.lit(upper_name).alias("upper_table"), "lower_rows", "upper_rows", "upper_keys", over("upper_rows", "lower_rows").alias("layer_ratio"), over("upper_rows", "upper_keys").alias("inflation"))
