"""Summaries of tables and of jobs, each one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from terrafold.operators import quantiles


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _of(column: str) -> Column:
    """A column of that name, whatever characters it has."""
    return F.col(f"`{column.replace('`', '``')}`")


def _long(one: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """A row for each column of a one-row frame, whose figures are named by the column's number and the figure."""
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), *(F.col(f"{i}_{n}").alias(n) for n in names)) for i, c in enumerate(columns)))).alias("r")
    return one.select(rows).select("r.*")


def _figures(columns: list[str], names: list[str], of) -> list[Column]:
    return [v.alias(f"{i}_{n}") for i, c in enumerate(columns) for v, n in zip(of(_of(c)), names, strict=True)]


def describe(df: DataFrame, columns: list[str] | None = None, at: tuple[float, ...] = (0.25, 0.5, 0.75), exact: bool = False) -> DataFrame:
    """column_name, n, n_null, min, max, mean, sd and q25, q50, ... of number columns, as doubles, from one pass.

    Quantiles are mergeable sketches of relative error 1/10000. With exact they are exact, found when this is called
    by some more passes.
    """
    own = numeric(df) if columns is None else columns
    names = ["n", "n_null", "min", "max", "mean", "sd", *(f"q{round(100 * q)}" for q in at)]
    known = quantiles.exact(df, {c: list(at) for c in own}) if exact else {}

    def figures(column: str) -> list[Column]:
        x = _of(column).cast("double")
        ends = [F.lit(known[column, q]).cast("double") if exact else F.percentile_approx(x, q, 10000) for q in at]
        return [F.count(x), F.count_if(x.isNull()), F.min(x), F.max(x), F.avg(x), F.stddev(x), *ends]

    return _long(df.agg(*(v.alias(f"{i}_{n}") for i, c in enumerate(own) for v, n in zip(figures(c), names, strict=True))), names, own)


def profile_columns(df: DataFrame) -> DataFrame:
    """column_name, type, n_rows, n_null, null_pct, lowest and highest (as text) of every column, from one pass; newest dates are the highest."""
    names = ["n_rows", "n_null", "lowest", "highest"]
    figures = _figures(df.columns, names, lambda c: (F.count("*"), F.count_if(c.isNull()), F.min(c).cast("string"), F.max(c).cast("string")))
    kinds = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    pct = F.when(F.col("n_rows") > 0, F.col("n_null") * 100.0 / F.col("n_rows")).otherwise(0.0)
    return _long(df.agg(*figures), names, df.columns).withColumns({"type": kinds[F.col("column_name")], "null_pct": pct})


def sum_numbers(df: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of all number columns by keys."""
    return df.groupBy(*map(_of, keys)).agg(*(F.sum(_of(c)).alias(f"sum_{c}") for c in numeric(df) if c not in keys))


def load_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """After a load: column_name, n_rows, n_filled, fill_pct and one value of each column, the least."""
    names = ["n_rows", "n_filled", "sample"]
    pct = F.when(F.col("n_rows") > 0, F.round(F.col("n_filled") * 100.0 / F.col("n_rows"), 2)).otherwise(0.0)
    return _long(df.agg(*_figures(columns, names, lambda c: (F.count("*"), F.count(c), F.min(c).cast("string")))), names, columns).withColumn("fill_pct", pct)


def job_entries(runs: DataFrame, table: Column, started: Column, ended: Column, rows: Column, error: Column) -> DataFrame:
    """Log entries: run_key (md5 of table_yyyymmdd), table, status, seconds, rows and error. A run without an error is a success.

    Entries go into the log by merge.upsert or log_upsert on run_key, so a run of the same day replaces the one before.
    """
    key = F.md5(F.concat_ws("_", table, F.date_format(started, "yyyyMMdd")))
    status = F.when(error.isNull(), "success").otherwise("failed")
    return runs.select(key.alias("run_key"), table.alias("table_name"), status.alias("status"), (F.unix_timestamp(ended) - F.unix_timestamp(started)).alias("seconds"), F.when(error.isNull(), rows).alias("rows"), error.alias("error"))
