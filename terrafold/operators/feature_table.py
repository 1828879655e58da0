"""The whole feature table of entities by month: posts, comments and reviews joined, with what follows from them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.functions.clean import guarded_ratio, smoothed_ratio
from terrafold.functions.parse import days_in_month
from terrafold.operators import features

KEYS = ("entity", "year_month")
ASPECTS = ("scenery", "food", "price", "service", "transport", "accommodation")
#: Months of the high season, and the names of traveller kinds with what their texts contain.
PEAK_MONTHS = (1, 4, 6, 7, 8, 12)
TRAVELLERS = {"couple_ratio": "Cặp đôi", "family_ratio": "Gia đình", "business_ratio": "Nhóm", "solo_ratio": "Khách lẻ"}
#: The columns of the table, in order.
COLUMNS = (
    *KEYS, "entity_name", "region", "year", "month",
    "total_posts", "total_comments", "total_hotel_reviews", "unique_authors", "comments_per_post", "post_frequency",
    "avg_likes_per_post", "avg_saves_per_post", "avg_shares_per_post", "median_likes_per_post", "p90_likes_per_post", "viral_post_ratio", "engagement_score",
    "avg_sentiment", "sentiment_std", "positive_ratio", "negative_ratio", "sentiment_polarity", "avg_word_count", "word_count_std", "avg_unique_word_ratio", "emoji_sentiment_ratio", "reply_ratio",
    *(f"avg_aspect_{a}" for a in ASPECTS),
    "avg_hotel_score", "hotel_score_std", "hotel_review_volume", "high_score_ratio", "low_score_ratio", "unique_reviewer_countries", "domestic_review_ratio", *TRAVELLERS, "hotel_vol_growth",
    "social_to_booking_ratio", "sentiment_polarity_change", "hotel_vol_std_rolling_3m",
    "month_sin", "month_cos", "is_peak_season", "hotness_score",
    "hotness_lag_1", "hotness_lag_2", "hotness_lag_3", "hotness_lag_12", "hotness_rolling_3m", "hotness_momentum",
    "hotel_vol_lag_1", "hotel_vol_lag_2", "hotel_vol_lag_3", "hotel_vol_lag_12", "hotel_vol_rolling_3m", "hotel_vol_momentum",
)
_COMMENT_NAMES = {"sd_sentiment": "sentiment_std", "avg_words": "avg_word_count", "sd_words": "word_count_std", "unique_ratio": "avg_unique_word_ratio", "emoji_sentiment": "emoji_sentiment_ratio"}
_REVIEW_NAMES = {"n_reviews": "hotel_review_volume", "avg_score": "avg_hotel_score", "sd_score": "hotel_score_std", "n_countries": "unique_reviewer_countries", "domestic_ratio": "domestic_review_ratio", "high_ratio": "high_score_ratio", "low_ratio": "low_score_ratio"}
#: The index's measures by what they are called here.
_MEASURES = {
    "total_posts": "total_posts", "total_comments": "total_comments", "avg_likes": "avg_likes_per_post", "avg_saves": "avg_saves_per_post", "comment_likes": "comment_likes",
    "positive_ratio": "positive_ratio", "avg_sentiment": "avg_sentiment", "negative_ratio": "negative_ratio", "emoji_sentiment": "emoji_sentiment_ratio", "avg_words": "avg_word_count",
    "unique_ratio": "avg_unique_word_ratio", "word_variation": "word_variation",
}


def post_months(posts: DataFrame) -> DataFrame:
    """Of posts (KEYS, post, author, likes, saves, shares, comments: whole numbers), a row for each KEYS.

    Posts and authors, three means and four sums, the median and ninth decile of likes, the share of posts above that,
    and the sum of all four. Rows with a NULL key are left out. The quantiles are sketches that merge before the
    shuffle; the share needs them, so posts are read twice.
    """
    own = posts.dropna(subset=list(KEYS))
    measures = ("likes", "saves", "shares", "comments")
    limits = own.groupBy(*KEYS).agg(F.percentile_approx("likes", 0.9, 10000).alias("p90"))
    mean = lambda c: (F.sum(c) / F.count(c)).alias(f"avg_{c}_per_post")
    return own.join(limits, list(KEYS)).groupBy(*KEYS).agg(
        F.countDistinct("post").alias("total_posts"), F.countDistinct("author").alias("unique_authors"), *map(mean, measures[:3]), *(F.sum(c).alias(f"sum_{c}") for c in measures),
        F.percentile_approx("likes", 0.5, 10000).cast("double").alias("median_likes_per_post"), F.max("p90").cast("double").alias("p90_likes_per_post"),
        (F.count_if(F.col("likes") > F.col("p90")) / F.count("*")).alias("viral_post_ratio"), F.sum(sum(map(F.col, measures[1:]), start=F.col("likes"))).alias("engagement_score"),
    )


def comment_months(comments: DataFrame) -> DataFrame:
    """features.comment_months with the six aspects, and the polarity: positive less negative shares."""
    found = features.comment_months(comments, list(KEYS), list(ASPECTS))
    named = found.withColumnsRenamed(_COMMENT_NAMES | {f"avg_{a}": f"avg_aspect_{a}" for a in ASPECTS})
    return named.withColumn("sentiment_polarity", F.col("positive_ratio") - F.col("negative_ratio"))


def review_months(reviews: DataFrame, home: str, high: float = 4.0, low: float = 2.0, kinds: dict[str, str] | None = None) -> DataFrame:
    """features.quality of reviews (KEYS, score, country, kind) with four kinds of travellers."""
    return features.quality(reviews.dropna(subset=list(KEYS)), list(KEYS), "score", "country", "kind", home, high, low, kinds or TRAVELLERS).withColumnsRenamed(_REVIEW_NAMES)


def harmonics(month: Column, orders: tuple[int, ...] = (1, 2)) -> dict[str, Column]:
    """Sine and cosine of the month of a year, for each order of the yearly wave."""
    return {f"{name}_{k}": of(2 * math.pi * k * month / 12) for k in orders for name, of in (("month_sin", F.sin), ("month_cos", F.cos))}


def lagged(df: DataFrame, value: str, name: str, steps: tuple[int, ...] = (1, 2, 3, 12)) -> dict[str, Column]:
    """Row lags of a value by entity, the mean of the three rows before, and the first lag less the third."""
    order = Window.partitionBy("entity").orderBy("year_month")
    lag = {f"{name}_lag_{k}": F.lag(value, k).over(order) for k in steps}
    return lag | {f"{name}_rolling_3m": F.avg(value).over(order.rowsBetween(-3, -1)), f"{name}_momentum": F.lag(value, 1).over(order) - F.lag(value, 3).over(order)}


def polarity_change(polarity: str) -> Column:
    """A month's polarity less that of the row before; 0 for an entity's first."""
    before = F.lag(polarity, 1).over(Window.partitionBy("entity").orderBy("year_month"))
    return F.when(before.isNotNull(), F.col(polarity) - before).otherwise(0.0)


def feature_table(posts: DataFrame, comments: DataFrame, reviews: DataFrame, entities: DataFrame) -> DataFrame:
    """COLUMNS for each row of posts (post_months), with comments, reviews and entities (entity, entity_name, region).

    The three sides are joined by KEYS, posts first; what comments and reviews lack is 0, as are aspects without
    mentions. Lags are of rows, so gaps in months are not filled. All sides have a row for each entity and month,
    so the windows by month and by entity are over few rows each.
    """
    zero = [c for c in (*comments.columns, *reviews.columns) if c not in KEYS]
    df = posts.join(comments, list(KEYS), "left").join(reviews, list(KEYS), "left").join(entities, "entity", "left").fillna(0, zero)
    month = F.col("year_month") % 100
    df = df.withColumns({
        "year": F.floor(F.col("year_month") / 100).cast("int"), "month": month.cast("int"), "total_hotel_reviews": F.col("hotel_review_volume"),
        "comments_per_post": guarded_ratio(F.col("total_comments"), F.col("total_posts")), "post_frequency": F.col("total_posts") / days_in_month(F.col("year_month")),
        "social_to_booking_ratio": smoothed_ratio(F.col("total_comments"), F.col("hotel_review_volume")), "is_peak_season": month.isin(*PEAK_MONTHS),
        "word_variation": guarded_ratio(F.col("word_count_std"), F.col("avg_word_count")), "sentiment_polarity_change": polarity_change("sentiment_polarity"),
    } | {name.removesuffix("_1"): c for name, c in harmonics(month, (1,)).items()})
    families = {f: (w, {_MEASURES[m]: part for m, part in own.items()}) for f, (w, own) in features.INDEX_A.items()}
    df = features.family_index(df, "year_month", families, "hotness_score")
    df = df.withColumns(lagged(df, "hotness_score", "hotness") | lagged(df, "hotel_review_volume", "hotel_vol"))
    before = Window.partitionBy("entity").orderBy("year_month").rowsBetween(-3, -1)
    change = guarded_ratio(F.col("hotel_review_volume") - F.col("hotel_vol_lag_1"), F.col("hotel_vol_lag_1"))
    df = df.withColumns({"hotel_vol_growth": F.coalesce(change, F.lit(0.0)), "hotel_vol_std_rolling_3m": F.coalesce(F.stddev("hotel_review_volume").over(before), F.lit(0.0))})
    return df.select(*COLUMNS)
