"""K-means from many starts, and how well clusters part: Calinski-Harabasz, Davies-Bouldin and the silhouette."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_kmeans(df: DataFrame, features: str, k: int, starts: int = 20, most_rounds: int = 300, seed: int = 7) -> KMeansModel:
    """The cheapest of as many fits as there are starts, by the summed squared distance to the centres; the first of equals.

    features is a vector column. df is read in each round of each fit; cache or store it before, if it is dear.
    """
    best = None
    for i in range(starts):
        model = KMeans(featuresCol=features, k=k, seed=seed + i, maxIter=most_rounds).fit(df)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    return best


def scores(df: DataFrame, label: str, point: str) -> DataFrame:
    """n, k, inertia, calinski_harabasz, davies_bouldin of points (array of doubles) with given labels: one row.

    The sums of the clusters come from one pass, the mean distances to their centres from a second, joined by label.
    What meets in one row is one centre for each label. A figure is NULL where it has no meaning: with one cluster, as
    many clusters as points, or no spread. Rows without label or point are left out; an empty table has n 0.
    """
    points = df.filter(F.col(label).isNotNull() & F.col(point).isNotNull()).select(F.col(label).alias("label"), F.col(point).cast("array<double>").alias("x"))
    norm = lambda x: F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v)
    far = lambda a, b: norm(F.zip_with(a, b, lambda u, v: u - v))
    mean = vector_to_array(Summarizer.metrics("mean").summary(array_to_vector("x"))["mean"])
    centres = points.groupBy("label").agg(F.count("*").alias("n"), mean.alias("centre"))
    near = points.join(centres.select("label", "centre"), "label").groupBy("label").agg(F.sum(far(F.col("x"), F.col("centre"))).alias("within"), F.avg(F.sqrt(far(F.col("x"), F.col("centre")))).alias("spread"))
    one = centres.join(near, "label").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum("within").alias("inertia"), F.collect_list(F.struct("label", "n", "centre", "spread")).alias("own"))
    total = F.aggregate("own", F.transform(F.col("own")[0]["centre"], lambda _: F.lit(0.0)), lambda a, c: F.zip_with(a, c["centre"], lambda u, v: u + v * c["n"] / F.col("n")))
    between = F.aggregate("own", F.lit(0.0), lambda a, c: a + c["n"] * far(c["centre"], F.col("whole")))
    # the worst neighbour of each cluster: spreads over the distance of the centres
    alike = lambda c, d: (c["spread"] + d["spread"]) / F.nullif(F.sqrt(far(c["centre"], d["centre"])), F.lit(0.0))
    worst = F.transform("own", lambda c: F.array_max(F.transform(F.filter("own", lambda d: d["label"] != c["label"]), lambda d: alike(c, d))))
    told = one.withColumn("whole", total).withColumn("between", between).withColumn("worst", worst)
    spread = F.nullif(F.col("inertia"), F.lit(0.0))
    ch = F.when((F.col("k") > 1) & (F.col("n") > F.col("k")), (F.col("between") / (F.col("k") - 1)) / (spread / (F.col("n") - F.col("k"))))
    db = F.when(F.col("k") > 1, F.aggregate("worst", F.lit(0.0), lambda a, w: a + w) / F.col("k"))
    return told.select(F.coalesce("n", F.lit(0)).alias("n"), "k", "inertia", ch.alias("calinski_harabasz"), db.alias("davies_bouldin"))


def silhouette(df: DataFrame, label: str, point: str) -> float:
    """The mean silhouette by squared distances; its sums by cluster stand for the other points, so no pairs are made."""
    points = df.select(F.col(label).cast("double").alias("prediction"), array_to_vector(F.col(point).cast("array<double>")).alias("features"))
    return ClusteringEvaluator().evaluate(points)
