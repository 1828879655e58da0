"""Entity-by-month features: engagement, indices on percent ranks, lags and rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.clean import clamp, guarded_ratio
from terrafold.operators import quantiles

#: Our own weights of a short index, by rank of each measure.
INDEX_WEIGHTS = {"n_posts": 0.15, "avg_value": 0.35, "n_authors": 0.20, "hot_ratio": 0.15, "total": 0.15}


def year_month(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def engagement(posts: DataFrame, entity: str, month: str, post: str, author: str, cents: str) -> DataFrame:
    """A row per entity and month: posts, authors, total, mean, median, p90, and the share of posts above p90.

    Values are integer cents, so sums are exact in any order. percentile_approx is a mergeable sketch: partial before
    the shuffle, so a hot entity does not gather its rows. The share needs p90, so posts are read twice: a sketch's
    ranks are only told of constants.
    """
    limits = posts.groupBy(entity, month).agg(F.percentile_approx(cents, 0.9, 10000).alias("p90"), F.percentile_approx(cents, 0.5, 10000).alias("median"))
    both = posts.join(limits, [entity, month])
    return both.groupBy(entity, month).agg(
        F.countDistinct(post).alias("n_posts"), F.countDistinct(author).alias("n_authors"), F.sum(cents).alias("total"),
        (F.sum(cents) / F.count(cents)).alias("avg_value"), F.max("median").alias("median"), F.max("p90").alias("p90"),
        (F.count_if(F.col(cents) > F.col("p90")) / F.count("*")).alias("hot_ratio"),
    )


def rank_index(df: DataFrame, month: str, weights: dict[str, float]) -> DataFrame:
    """hotness: the weighted mean of percent ranks of measures within each month, clamped to 0..1. See family_index."""
    ranks = {f"rank_{m}": _rank_in(month, m) for m in weights}
    total = sum((F.col(f"rank_{m}") * F.lit(w) for m, w in weights.items()), start=F.lit(0.0))
    return df.withColumns(ranks).withColumn("hotness", clamp(total)).drop(*ranks)


def _rank_in(month: str, measure: str) -> Column:
    """The percent rank of a measure, to nine places, within a month."""
    return F.percent_rank().over(Window.partitionBy(month).orderBy(F.round(F.col(measure), 9).asc_nulls_first()))


#: The families of the attractiveness index, their weights, and their measures with the weights within. True: less is better.
INDEX_A = {
    "volume": (0.25, {"total_posts": (0.6, False), "total_comments": (0.4, False)}),
    "engagement": (0.35, {"avg_likes": (0.45, False), "avg_saves": (0.35, False), "comment_likes": (0.20, False)}),
    "sentiment": (0.20, {"positive_ratio": (0.5, False), "avg_sentiment": (0.3, False), "negative_ratio": (0.2, True)}),
    "emoji": (0.05, {"emoji_sentiment": (1.0, False)}),
    "richness": (0.15, {"avg_words": (0.45, False), "unique_ratio": (0.45, False), "word_variation": (0.10, False)}),
}
#: The second form, with totals of likes and saves, emoji intensity, and exclamations.
INDEX_B = INDEX_A | {
    "engagement": (0.35, {"total_likes": (0.45, False), "total_saves": (0.35, False), "comment_likes": (0.20, False)}),
    "emoji": (0.05, {"total_emojis": (0.5, False), "emoji_sentiment": (0.5, False)}),
    "richness": (0.15, {"avg_words": (0.45, False), "unique_ratio": (0.45, False), "exclamation_ratio": (0.10, False)}),
}


def family_index(df: DataFrame, month: str, families: dict[str, tuple[float, dict[str, tuple[float, bool]]]], name: str = "hotness") -> DataFrame:
    """df with the weighted sum of families of percent ranks within each month, clamped to 0..1.

    A month has a row for each entity at most, so a month's rows, which one task sorts for each measure, are few.
    Measures are ranked by nine places, so that equal ones tie in whatever order they were added up.
    """
    ranks = {m for _, own in families.values() for m in own}
    ranked = df.withColumns({f"_r_{m}": _rank_in(month, m) for m in sorted(ranks)})
    value = lambda m, less: 1 - F.col(f"_r_{m}") if less else F.col(f"_r_{m}")
    parts = [sum((value(m, less) * F.lit(w) for m, (w, less) in own.items()), start=F.lit(0.0)) * F.lit(weight) for weight, own in families.values()]
    return ranked.withColumn(name, clamp(sum(parts, start=F.lit(0.0)))).drop(*(f"_r_{m}" for m in ranks))


def comment_months(comments: DataFrame, keys: list[str], aspects: list[str] = (), least: float = 0.5) -> DataFrame:
    """A row per key: counts, sentiment, words, emoji, replies, likes, and the net sentiment of each aspect.

    comments has sentiment, label, words, unique_ratio, emojis, positive_emojis, negative_emojis, level, likes, and for
    each aspect its mention weight and, as aspect_pos and aspect_neg, its shares. An aspect under least
    mentions in all is NULL. Comments of the first form have no aspects. Rows with a NULL key are left out.
    """
    part = lambda c: F.count_if(c) / F.count("*")
    emoji = F.when(F.col("emojis") > 0, (F.col("positive_emojis") - F.col("negative_emojis")) / F.col("emojis")).otherwise(0.0)
    net = lambda a: F.when(F.sum(a) >= least, (F.sum(F.coalesce(f"{a}_pos", F.lit(0.0))) - F.sum(F.coalesce(f"{a}_neg", F.lit(0.0)))) / F.sum(a))
    return comments.dropna(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("total_comments"), F.avg("sentiment").alias("avg_sentiment"), F.stddev("sentiment").alias("sd_sentiment"),
        part(F.col("label") == "positive").alias("positive_ratio"), part(F.col("label") == "negative").alias("negative_ratio"),
        F.avg("words").alias("avg_words"), F.stddev("words").alias("sd_words"), F.avg("unique_ratio").alias("unique_ratio"), F.avg(emoji).alias("emoji_sentiment"),
        part(F.col("level") == 2).alias("reply_ratio"), F.sum("likes").alias("comment_likes"), *(net(a).alias(f"avg_{a}") for a in aspects),
    )


def comment_months_of(second: DataFrame | None, first: DataFrame, keys: list[str], aspects: list[str]) -> DataFrame:
    """comment_months of the second form where that table exists and has rows, else of the first with aspects of 0."""
    if second is not None and not second.isEmpty():
        return comment_months(second, keys, aspects)
    return comment_months(first, keys).withColumns({f"avg_{a}": F.lit(0.0) for a in aspects})


def lags(df: DataFrame, entity: str, month: str, value: str, steps: tuple[int, ...] = (1, 2, 3, 12)) -> DataFrame:
    """Row lags, the mean of the three rows before, and what follows from them. Gaps in months are not filled."""
    order = Window.partitionBy(entity).orderBy(month)
    before = order.rowsBetween(-3, -1)
    out = df.withColumns({f"lag_{k}": F.lag(value, k).over(order) for k in steps})
    mean = F.sum(value).over(before) / F.nullif(F.count(value).over(before), F.lit(0))
    out = out.withColumn("mean_3", mean)
    return out.withColumns({"momentum": F.col("lag_1") - F.col("lag_3"), "growth": F.when(F.col("lag_1") > 0, (F.col(value) - F.col("lag_1")) / F.col("lag_1")).otherwise(0.0)})


def clipped_growth(df: DataFrame, entity: str, month: str, value: str, low: float = -1.0, high: float = 5.0) -> DataFrame:
    """growth from the row before, between low and high; 0 where that row is missing or not positive."""
    before = F.lag(value, 1).over(Window.partitionBy(entity).orderBy(month))
    return df.withColumn("growth", clamp(F.coalesce(guarded_ratio(F.col(value) - before, before), F.lit(0.0)), low, high))


def rolling_stddev(df: DataFrame, entity: str, month: str, value: str) -> DataFrame:
    before = Window.partitionBy(entity).orderBy(month).rowsBetween(-3, -1)
    return df.withColumn("stddev_3", F.coalesce(F.round(F.stddev(value).over(before), 6), F.lit(0.0)))


def rolling_inclusive(df: DataFrame, entity: str, order: str, value: str) -> DataFrame:
    own = Window.partitionBy(entity).orderBy(order).rowsBetween(-2, 0)
    return df.withColumn("mean_own_3", F.sum(value).over(own) / F.count(value).over(own))


def dense_months(df: DataFrame, entity: str, month: str) -> DataFrame:
    """A row for every month between an entity's first and last, measures NULL where there was none."""
    span = df.groupBy(entity).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    day = lambda c: F.make_date(F.floor(F.col(c) / 100).cast("int"), (F.col(c) % 100).cast("int"), F.lit(1))
    days = span.select(entity, F.explode(F.sequence(day("_a"), day("_b"), F.expr("interval 1 month"))).alias("_day"))
    months = days.select(entity, year_month(F.col("_day")).alias(month))
    return months.join(df, [entity, month], "left")


def sequences(df: DataFrame, entity: str, order: str, values: list[str], length: int) -> DataFrame:
    """Windows of the length rows before each row, where there are that many."""
    before = Window.partitionBy(entity).orderBy(order).rowsBetween(-length, -1)
    out = df.withColumns({f"{v}_window": F.collect_list(v).over(before) for v in values})
    return out.filter(F.size(f"{values[0]}_window") == length)


def season(df: DataFrame, month: str, peaks: tuple[int, ...] = (1, 4, 6, 7, 8, 12)) -> DataFrame:
    m = F.col(month) % 100
    angle = m * (2 * 3.141592653589793 / 12)
    return df.withColumns({"sin_month": F.round(F.sin(angle), 6) + F.lit(0.0), "cos_month": F.round(F.cos(angle), 6) + F.lit(0.0), "is_peak": m.isin(*peaks)})


def quality(reviews: DataFrame, keys: list[str], score: str, country: str, kind: str, home: str, high: float = 4.0, low: float = 2.0, kinds: dict[str, str] | None = None) -> DataFrame:
    """Per key: reviews, mean and spread of scores, shares of high, low, domestic, and of kinds of traveller.

    kinds has a column's name for each share, and what the kind of a review must contain to count.
    """
    share = lambda c: F.count_if(c) / F.count("*")
    return reviews.groupBy(*keys).agg(
        F.count("*").alias("n_reviews"), F.avg(score).alias("avg_score"), F.round(F.stddev(score), 6).alias("sd_score"),
        share(F.col(score) >= high).alias("high_ratio"), share(F.col(score) < low).alias("low_ratio"), F.countDistinct(country).alias("n_countries"),
        share(F.col(country) == home).alias("domestic_ratio"), *(share(F.col(kind).contains(part)).alias(name) for name, part in (kinds or {"kind_a_ratio": "A"}).items()),
    )


def net_sentiment(df: DataFrame, key: str, positive: Column, negative: Column, mention: Column, least: int = 1) -> DataFrame:
    """(sum of positive - sum of negative) / sum of mentions, NULL under least mentions."""
    sums = df.groupBy(key).agg(F.sum(positive).alias("_p"), F.sum(negative).alias("_n"), F.sum(mention).alias("_m"))
    return sums.select(key, F.when(F.col("_m") >= least, (F.col("_p") - F.col("_n")) / F.col("_m")).alias("net_sentiment"))


def entropy(parts: list[Column], total: Column) -> Column:
    """Of the parts' shares of total, in nats; 0 where all parts are 0."""
    shares = [F.when(total > 0, p / total).otherwise(0.0) for p in parts]
    return sum((F.when(s > 0, -s * F.log(s)).otherwise(0.0) for s in shares), start=F.lit(0.0))


def zscores(df: DataFrame, columns: list[str]) -> DataFrame:
    """is_outlier: any column three or more deviations from its mean. One row of statistics joins all rows."""
    stats = df.agg(*(F.avg(c).alias(f"_m_{c}") for c in columns), *(F.stddev_pop(c).alias(f"_s_{c}") for c in columns))
    z = [F.abs((F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0))) for c in columns]
    return df.crossJoin(F.broadcast(stats)).withColumn("is_outlier", F.coalesce(F.greatest(*z, F.lit(0.0)) >= 3, F.lit(False))).select(*df.columns, "is_outlier")


def robust_scale(df: DataFrame, column: str, train: Column, clip: float = 0.99) -> DataFrame:
    """log1p of the value clipped at the training rows' quantile, less their median, over their quartile range.

    The quantiles are exact, and found when this is called; see quantiles.exact.
    """
    own = df.withColumn("_t", F.when(train, F.col(column)))
    top = quantiles.exact(own, {"_t": [clip]}, between=True)["_t", clip]
    logged = own.withColumn("_x", F.log1p(F.least(F.col(column), F.lit(top)))).withColumn("_t", F.when(train, F.col("_x")))
    found = quantiles.exact(logged, {"_t": [0.25, 0.5, 0.75]}, between=True)
    low, middle, high = (found["_t", q] for q in (0.25, 0.5, 0.75))
    width = high - low if middle is not None and high > low else 1.0
    return logged.withColumn("scaled", F.round((F.col("_x") - F.lit(middle)) / F.lit(width), 6)).select(*df.columns, "scaled")


def anchors(df: DataFrame, entity: str, value: str, floor: float = 0.05) -> DataFrame:
    """The value over its entity's median, or over the floor quantile of all, found when this is called, where the median is less."""
    least = quantiles.exact(df, {value: [floor]}, between=True)[value, floor]
    own = df.groupBy(entity).agg(F.percentile(value, F.lit(0.5)).alias("_median"))
    return df.join(own.select(entity, F.greatest("_median", F.lit(least)).alias("anchor")), entity).withColumn("relative", F.round(F.col(value) / F.col("anchor"), 6))
