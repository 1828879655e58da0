"""Positions in a global order without a global window: range partitions, their sizes, and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.sources.shared import stored

#: monotonically_increasing_id() keeps the partition above these bits and the row in it below.
ROW_BITS = 33


def positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """df with each row's place (from 0) in the order given, which may have nulls and descending columns.

    Rows are dealt out by ranges of the order and sorted within those, so no task holds more than its range; equal
    rows of the order are in one range, and among them any order is taken. The sorted table is written to the shared
    folder, so that a range read twice is the same; the only thing joined to it is one offset a partition, which is
    broadcast. An empty table gives no rows.
    """
    spot, part = f"{name}_spot", f"{name}_part"
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(spot, F.monotonically_increasing_id()))
    split = ranged.withColumn(part, F.shiftrightunsigned(spot, ROW_BITS))
    sizes = split.groupBy(part).agg(F.count("*").alias("n"))
    # one row a partition; the window over them is as small as the list of tasks
    before = F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(part, (F.coalesce(before, F.lit(0)) - F.shiftleft(F.col(part), ROW_BITS)).alias("n"))
    return split.join(F.broadcast(offsets), part).withColumn(name, F.col(spot) + F.col("n")).select(*df.columns, name)


def row_split(df: DataFrame, order: list[Column], parts: dict[str, float]) -> DataFrame:
    """df with split: the first rows of the order are of the first part, and so on, by shares of the row count.

    A part has the rows whose position is below the whole number of its share of all rows, and of those before it; the
    last part has the rest. Give an order that tells all rows apart, or equal ones fall on either side of an edge.
    """
    placed = positions(df, order, "_position").crossJoin(F.broadcast(df.agg(F.count("*").alias("_n"))))  # one row
    share, out = 0.0, F.lit(list(parts)[-1])
    edges = []
    for name, own in list(parts.items())[:-1]:
        share += own
        edges.append((name, share))
    for name, edge in reversed(edges):
        out = F.when(F.col("_position") < F.floor(F.col("_n") * F.lit(edge) + F.lit(1e-9)), name).otherwise(out)
    return placed.withColumn("split", out).drop("_position", "_n")
