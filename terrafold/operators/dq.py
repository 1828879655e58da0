"""Declarative data-quality rules: all rules of a table become one aggregation, then long rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A metric over the table, and its limit: at_least, else at most. Failing is FAIL where critical, INFO for what is only told, else WARN."""

    name: str
    category: str
    metric: Column
    limit: float
    critical: bool = True
    at_least: bool = False
    info: bool = False


def _pct(bad: Column) -> Column:
    return F.when(F.count("*") > 0, F.count_if(bad) * 100.0 / F.count("*")).otherwise(0.0)


def min_records(n: int) -> Rule:
    return Rule("min_records", "volume", F.count("*").cast("double"), n, at_least=True)


def null_pct(column: str, limit: float = 0.0, critical: bool = True) -> Rule:
    return Rule(f"null_pct_{column}", "completeness", _pct(F.col(column).isNull()), limit, critical)


def duplicate_pct(*keys: str, limit: float = 1.0) -> Rule:
    n = F.count("*")
    return Rule(f"duplicate_pct_{'_'.join(keys)}", "uniqueness", F.when(n > 0, (n - F.count_distinct(F.struct(*keys))) * 100.0 / n).otherwise(0.0), limit)


def violations(name: str, category: str, bad: Column, limit: float = 0, critical: bool = True) -> Rule:
    return Rule(name, category, F.count_if(bad).cast("double"), limit, critical)


def in_range(column: str, low: float, high: float | None = None) -> Rule:
    c = F.col(column)
    return violations(f"range_{column}", "validity", (c < low) | (F.lit(False) if high is None else c > high))


def text_rules(column: str) -> list[Rule]:
    c = F.col(column)
    return [
        violations(f"blank_{column}", "validity", F.trim(c) == ""),
        violations(f"short_{column}", "validity", F.length(F.trim(c)) < 3),
        violations(f"no_letter_{column}", "validity", ~c.rlike(r"\p{L}"), critical=False),
    ]


def url_rules(column: str, domain: str) -> list[Rule]:
    c = F.col(column)
    return [
        violations(f"scheme_{column}", "validity", ~(c.startswith("http://") | c.startswith("https://"))),
        Rule(f"domain_{column}", "validity", _pct(~c.contains(domain)), 1.0),
        violations(f"spaces_{column}", "validity", c.contains(" ")),
    ]


def enum(column: str, values: list[str]) -> Rule:
    return violations(f"enum_{column}", "validity", F.col(column).isNull() | ~F.col(column).isin(*values))


def coverage(column: str, least: int) -> Rule:
    return Rule(f"coverage_{column}", "coverage", F.count_distinct(F.col(column)).cast("double"), least, critical=False, at_least=True)


def presence(column: str, name: str, pattern: str) -> Rule:
    return Rule(f"missing_{name}", "content", _pct(~F.coalesce(F.col(column).rlike(pattern), F.lit(False))), 1.0)


def share(column: str, name: str, pattern: str, least: float = 0.0) -> Rule:
    """How many percent of rows hold the pattern: told, and INFO below least."""
    return Rule(f"share_{name}", "content", _pct(F.coalesce(F.col(column).rlike(pattern), F.lit(False))), least, critical=False, at_least=True, info=True)


def future(column: str, today: str) -> Rule:
    return violations(f"future_{column}", "timeliness", F.to_date(F.col(column)) > F.to_date(F.lit(today)), critical=False)


def freshness(column: str, now: str, hours: float = 168) -> Rule:
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(F.max(F.col(column)).cast("timestamp"))) / 3600.0
    return Rule(f"freshness_{column}", "timeliness", age, hours, critical=False)


def orphan_pct(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """child with is_orphan, for a rule on it."""
    known = parent.select(F.col(key).alias("_key")).distinct()
    return child.join(known, F.col(key) == F.col("_key"), "left").withColumn("is_orphan", F.col("_key").isNull()).drop("_key")


def orphan_rule(limit: float = 5.0) -> Rule:
    return Rule("orphan_pct", "integrity", _pct(F.col("is_orphan")), limit, critical=False)


def check(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """table_name, check_name, category, status, is_critical, metric, threshold: one row a rule, from one pass."""
    one = df.agg(*(r.metric.alias(f"_{i}") for i, r in enumerate(rules)))
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(r.name).alias("check_name"), F.lit(r.category).alias("category"), F.lit(r.critical).alias("is_critical"), F.col(f"_{i}").cast("double").alias("metric"), F.lit(float(r.limit)).alias("threshold"), F.lit(r.at_least).alias("_least"), F.lit(r.info).alias("_info")) for i, r in enumerate(rules)]
    long = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    good = F.when(F.col("_least"), F.col("metric") >= F.col("threshold")).otherwise(F.col("metric") <= F.col("threshold"))
    status = F.when(F.coalesce(good, F.lit(False)), "PASS").when(F.col("is_critical"), "FAIL").when(F.col("_info"), "INFO").otherwise("WARN")
    return long.withColumn("status", status).drop("_least", "_info")


def failed(results: DataFrame) -> DataFrame:
    """One row: whether any critical check failed."""
    return results.agg(F.coalesce(F.bool_or((F.col("status") == "FAIL") & F.col("is_critical")), F.lit(False)).alias("failed"))


def union(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
