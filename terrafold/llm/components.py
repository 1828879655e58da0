"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.common import stored

#: Edges that a task contracts at once.
STRETCH = 200_000


def stars(edges: DataFrame) -> DataFrame:
    """(node, component) of edges (a, b) that are stars: a is the smallest node of its component, and each b has one a."""
    children = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return children.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a stretch as stars: fewer edges, the same components."""

    def close(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        label = np.arange(len(nodes))
        while True:
            least = np.minimum(label[x], label[y])
            new = label.copy()
            for end in (label[x], label[y]):  # roots move, and with them all below
                np.minimum.at(new, end, least)
            new = new[new]
            new = np.minimum(new, new[label])
            if (new == label).all():
                break
            label = new
        i = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.record_batch([pa.array(nodes[label[i]]), pa.array(nodes[i])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= STRETCH:
            yield close(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b")))
            held = []
    if held:
        yield close(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("a", "b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b: long) reaches.

    Edges are contracted within tasks first. Every round halves distances to the smallest node at least in the long
    run; rounds are written to the shared folder, so no lineage grows. Aggregates are partial before they are
    shuffled, and the joins after them are with written or aggregated tables, so the edges of one node with very many
    are split where adaptive execution is on. Edges with a null end, and those of a node with itself, are ignored;
    nodes without edges are not in the result; an empty table gives no rows.
    """
    ends = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stored(ends.mapInArrow(contracted, "a long, b long").distinct())
    ends_of = lambda t: t.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(t.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    # stars: no node is a child twice, or both a child and a parent
    while ends_of(now).groupBy("node").agg(F.max("up").alias("up"), F.sum("down").alias("down")).filter("up + down > 1").limit(1).count():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        # small star: the smaller neighbours of each node, and itself, meet at the smallest of them
        root = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(root, "b").select(F.col("m").alias("x"), "a").filter("x <> a").select(F.col("x").alias("a"), F.col("a").alias("b"))
        now = stored(small.unionByName(root.select(F.col("m").alias("a"), "b")).distinct())
    return stars(now)
