"""Upserts on plain tables: one null-safe full join says what happens to every key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _once(source: DataFrame, keys: list[str], checksum: str) -> DataFrame:
    """One row a key: that with the greatest checksum. Callers with a better order use keep_latest first."""
    whole = source.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max_by(F.struct(*source.columns), F.coalesce(F.col(checksum).cast("string"), F.lit(""))).alias("_row"))
    return whole.select("_row.*")


def changes(target: DataFrame, source: DataFrame, keys: list[str], checksum: str) -> DataFrame:
    """keys and action: insert, update, skip, or keep for rows of the target alone. NULL keys match NULL keys."""
    t = target.select(*(F.col(k).alias(f"t_{k}") for k in keys), F.col(checksum).alias("t_sum"), F.lit(True).alias("t_in"))
    s = _once(source, keys, checksum).select(*(F.col(k).alias(f"s_{k}") for k in keys), F.col(checksum).alias("s_sum"), F.lit(True).alias("s_in"))
    match = reduce(lambda a, b: a & b, (F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in keys))
    action = F.when(F.col("t_in").isNull(), "insert").when(F.col("s_in").isNull(), "keep").when(F.col("t_sum").eqNullSafe(F.col("s_sum")), "skip").otherwise("update")
    return t.join(s, match, "full_outer").select(*(F.when(F.col("t_in").isNotNull(), F.col(f"t_{k}")).otherwise(F.col(f"s_{k}")).alias(k) for k in keys), action.alias("action"))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], checksum: str, keep: tuple[str, ...] = (), stamp: tuple[str, Column] | None = None) -> DataFrame:
    """The target after a merge, with its columns: changed rows take the source's values but for those in keep.

    A key that the source repeats counts once, with its greatest checksum; NULL keys match NULL keys. stamp names a
    column, such as updated_at, that new and changed rows take the given value in.
    """
    own = lambda c: F.lit(None) if stamp and c == stamp[0] else F.col(c)
    s = _once(source, keys, checksum).select(*(own(c).alias(f"s_{c}") for c in target.columns), F.lit(True).alias("s_in"))
    t = target.withColumn("t_in", F.lit(True))
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in keys))
    new = F.col("t_in").isNull()
    changed = F.col("s_in") & F.col("t_in") & ~F.col(checksum).eqNullSafe(F.col(f"s_{checksum}"))
    joined = t.join(s, match, "full_outer")
    written = new | F.coalesce(changed, F.lit(False))
    value = lambda c: stamp[1] if stamp and c == stamp[0] else F.col(f"s_{c}")
    return joined.select(*(F.when(new if c in keep else written, value(c)).otherwise(F.col(c)).alias(c) for c in target.columns))


def merge_stats(actions: DataFrame) -> DataFrame:
    """One row: inserted, updated, skipped, total of the source."""
    count = lambda a: F.count_if(F.col("action") == a)
    return actions.agg(count("insert").alias("inserted"), count("update").alias("updated"), count("skip").alias("skipped"), F.count_if(F.col("action") != "keep").alias("total"))


def append_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of source whose key the target does not hold, once each: of several the least by a hash of the row. NULL keys match NULL keys."""
    once = source.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*source.columns), F.struct(F.xxhash64(*source.columns))).alias("_row"))
    known = target.select(F.col(key).alias("_known"))
    return once.join(known, F.col("_key").eqNullSafe(F.col("_known")), "left_anti").select("_row.*")


def append_stats(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: how many rows of source append_new takes, and how many repeat a key or are in the target already."""
    taken = append_new(target, source, key).agg(F.count("*").alias("new"))
    return source.agg(F.count("*").alias("_all")).crossJoin(F.broadcast(taken)).select("new", (F.col("_all") - F.col("new")).alias("duplicate"))


def skip_processed(files: DataFrame, log: DataFrame, layer: str) -> DataFrame:
    """Files whose checksum the log does not hold as a success of that layer."""
    done = log.filter((F.col("layer") == layer) & (F.col("status") == "success")).select("file_checksum")
    return files.join(done, "file_checksum", "left_anti")


def log_upsert(log: DataFrame, entries: DataFrame) -> DataFrame:
    """The log with entries in place of those of the same checksum and layer. Of entries that share both, one counts: the least by a hash of the row."""
    keys = ["file_checksum", "layer"]
    once = entries.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min_by(F.struct(*entries.columns), F.struct(F.xxhash64(*entries.columns))).alias("_row")).select("_row.*")
    return log.join(once.select(*keys), keys, "left_anti").unionByName(once, allowMissingColumns=True)
