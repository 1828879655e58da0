"""Comment features by word lists: counts, sentiment, aspects and weak labels, all as Column expressions.

The lists are parameters. Sentiment and labels follow fixed scores, so any other
scorer with the same output columns can stand in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITIVE = ("good", "great", "love", "beautiful", "tuyệt", "đẹp", "thích", "tốt")
NEGATIVE = ("bad", "awful", "hate", "trash", "disgusting", "chán", "tệ", "dở")
POSITIVE_EMOJI = ("😍", "😊", "👍", "❤")
NEGATIVE_EMOJI = ("😡", "😢", "👎")
ASPECTS = {"food": ("food", "eat", "ăn", "món"), "price": ("price", "cheap", "giá", "rẻ"), "service": ("staff", "service", "phục vụ")}


def tidy(text: Column) -> Column:
    """The whole text without urls and mentions, single spaces."""
    t = F.coalesce(text, F.lit(""))
    t = F.regexp_replace(F.regexp_replace(t, r"https?://\S+", ""), r"@\w+", "")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def tokens(text: Column) -> Column:
    """The lower-case words between white space."""
    t = F.btrim(F.lower(text), F.lit(" \t\n\x0b\f\r"))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def unique_ratio(text: Column) -> Column:
    n = word_count(text)
    return F.when(n > 0, F.size(F.array_distinct(tokens(text))) / n).otherwise(F.lit(0.0))


def word_stats(df: DataFrame, column: str) -> DataFrame:
    """df with n_words, unique_ratio and n_exclaim of a text; its words are cut once."""
    words = df.withColumn("_words", tokens(F.col(column))).withColumns({"n_words": F.size("_words").cast("long"), "n_exclaim": exclamations(F.col(column)).cast("long")})
    ratio = F.when(F.col("n_words") > 0, F.size(F.array_distinct("_words")) / F.col("n_words")).otherwise(0.0)
    return words.withColumn("unique_ratio", ratio).drop("_words")


def exclamations(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))


def hits(text: Column, words: Sequence[str]) -> Column:
    """How many of the words occur. Those of two characters or less must stand alone."""
    t = F.lower(text)
    found = [t.rlike(rf"(?<!\p{{L}}){w}(?!\p{{L}})") if len(w) <= 2 else t.contains(w) for w in words]
    return reduce(lambda a, b: a + b, (f.cast("int") for f in found))


def sentiment(text: Column) -> Column:
    """1, -1 or 0 by which list has more hits."""
    return F.signum(hits(text, POSITIVE) - hits(text, NEGATIVE)).cast("int")


def comment_features(df: DataFrame, column: str) -> DataFrame:
    t = tidy(F.col(column))
    return df.withColumns({
        "n_words": word_count(t), "unique_ratio": F.round(unique_ratio(t), 4), "n_exclaim": exclamations(t), "sentiment": sentiment(t),
        "n_emoji": hits(t, POSITIVE_EMOJI + NEGATIVE_EMOJI), "n_positive": hits(t, POSITIVE), "n_negative": hits(t, NEGATIVE),
    })


def weak_labels(df: DataFrame, column: str) -> DataFrame:
    """label (positive, negative, neutral), confidence, and an aspect column each: 1, -1 or 0.

    Signals: up to 3 keywords and 3 emoji a side, one for two or more exclamation marks, and the sentiment: 2 for its
    side, or 1 for the total alone. confidence = min(0.95, 0.4 + side/total * 0.55 * min(total/5, 1)); ties are
    neutral at 0.5, no signal at 0.4, texts under 3 characters at 0.3.
    """
    t = tidy(F.col(column))
    cap = lambda words: F.least(F.lit(3), hits(t, words))
    mood = sentiment(t)
    positive = cap(POSITIVE) + cap(POSITIVE_EMOJI) + F.when(exclamations(t) >= 2, 1).otherwise(0) + F.when(mood > 0, 2).otherwise(0)
    negative = cap(NEGATIVE) + cap(NEGATIVE_EMOJI) + F.when(mood < 0, 2).otherwise(0)
    scored = df.withColumns({"_p": positive, "_n": negative, "_t": positive + negative + F.when(mood == 0, 1).otherwise(0), "_len": F.length(t)})
    side = F.greatest("_p", "_n")
    confidence = F.least(F.lit(0.95), 0.4 + side / F.col("_t") * 0.55 * F.least(F.col("_t") / 5, F.lit(1.0)))
    flat = F.col("_p") == F.col("_n")
    label = F.when((F.col("_len") < 3) | flat, "neutral").when(F.col("_p") > F.col("_n"), "positive").otherwise("negative")
    sure = F.when(F.col("_len") < 3, 0.3).when((F.col("_p") == 0) & (F.col("_n") == 0), 0.4).when(flat, 0.5).otherwise(confidence)
    out = scored.withColumns({"label": label, "confidence": F.round(sure, 6)})
    clauses = F.split(F.lower(t), r"[.,!?;\n]|\b(?:but|however|nhưng)\b")

    def of_aspect(words: Sequence[str]) -> Column:
        about = F.filter(clauses, lambda c: (hits(c, words) >= 2) | ((hits(c, words) == 1) & (F.size(tokens(c)) <= 15)))
        total = F.aggregate(about, F.lit(0), lambda a, c: a + F.signum(hits(c, POSITIVE) - hits(c, NEGATIVE)).cast("int"))
        return F.when(F.size(about) == 0, 0).when(total != 0, F.signum(total).cast("int")).otherwise(F.when(F.col("label") == "positive", 1).when(F.col("label") == "negative", -1).otherwise(0))

    return out.withColumns({f"aspect_{a}": of_aspect(w) for a, w in ASPECTS.items()}).drop("_p", "_n", "_t", "_len")


def confident(df: DataFrame, most_weak: int, order: list[Column]) -> DataFrame:
    """Labels sure enough (negative from 0.5, others from 0.6), and at most most_weak weak neutrals (0.35 to 0.6), flagged."""
    sure = df.filter(F.col("confidence") >= F.when(F.col("label") == "negative", 0.5).otherwise(0.6)).withColumn("is_weak", F.lit(False))
    weak = df.filter((F.col("label") == "neutral") & (F.col("confidence") >= 0.35) & (F.col("confidence") < 0.6)).orderBy(*order).limit(most_weak)
    return sure.unionByName(weak.withColumn("is_weak", F.lit(True)))


def stratified_cap(df: DataFrame, label: str, most: int, order: list[Column], salts: int = 32) -> DataFrame:
    """At most so many rows a label, the first by order; a label's rows are first cut within salted parts."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    for keys in ([label, "_salt"], [label]):
        salted = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= most).drop("_rank")
    return salted.drop("_salt")


def multi_hot(text: Column, names: Sequence[str]) -> Column:
    """'a,b' as an array of 0 and 1 in the order of names."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.array(*(F.array_contains(parts, n).cast("int") for n in names))
