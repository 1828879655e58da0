"""Quantiles from mergeable sketches that are stored by key and month, and merged upwards; exact ones by narrowing sketches."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrafold.sources.shared import stored

#: Items a sketch keeps at least; the error of a rank is about 2.3 / K ** 0.9 of all, 0.13 % here. Up to K values are exact.
K = 4096


def sketched(df: DataFrame, keys: list[str], value: str, k: int = K, where: Column | None = None) -> DataFrame:
    """keys and sketch, of the values that are not NULL, in rows where the condition holds.

    Sketches are partial before the shuffle, so a hot key sends one sketch a task and not its rows. They are binary
    columns of bounded size, and may be written and merged later.
    """
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(x if where is None else F.when(where, x), F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """Sketches of fewer keys, from those of more: of entities from entity and month, or of all from none."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantiles(sketches: DataFrame, at: dict[str, float]) -> DataFrame:
    """Sketches with n and a column for each quantile: the least value whose rank reaches it. NULL where nothing was sketched."""
    n = F.kll_sketch_get_n_double("sketch")
    own = {name: F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))) for name, q in at.items()}
    return sketches.withColumns({"n": n} | own).drop("sketch")


def exact_by(df: DataFrame, keys: list[str], value: str, at: dict[str, float], sketches: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """As quantiles, exact for any number of values: keys, n and a column for each quantile, the value of rank ceil(q * n), at least the first.

    Sketches of the same values, by these keys, may be given. Up to K values they are exact. For more, they only say
    where to cut a key's values: those of each piece are counted, so the piece of each rank is known for sure, and
    in these alone equal values are counted and added up in order. A sketch that is off makes a piece larger, and the result
    is the same; a piece has some hundredth of a key's rows, and is streamed. The cuts are written to the shared folder.
    """
    k = [f"_k{i}" for i in range(len(keys))]
    x = F.col(value).cast("double")
    x = F.when(~F.isnan(x) if where is None else where & ~F.isnan(x), x)
    rows = df.select(*(F.col(c).alias(a) for c, a in zip(keys, k, strict=True)), x.alias("_x"))
    own = sketched(rows, k, "_x") if sketches is None else sketches.select(*(F.col(c).alias(a) for c, a in zip(keys, k, strict=True)), "sketch")
    n = F.kll_sketch_get_n_double("sketch")
    few = quantiles(own, at)
    error = 0.004  # three times a sketch's
    edges = F.array_sort(F.array_distinct(F.array(*(F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(q + e, 0.0), 1.0))) for q in at.values() for e in (-error, error)))))
    ranks = F.array(*(F.struct(F.lit(name).alias("name"), F.greatest(F.ceil(F.round(n * F.lit(float(q)), 9)), F.lit(1)).alias("rank")) for name, q in at.items()))
    # stored, since a sketch that is made again may cut elsewhere
    many = stored(own.filter(n > K).select(*k, edges.alias("_edges"), ranks.alias("_ranks")))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in k]

    def meet(left: DataFrame, right: DataFrame, *more: Column, how: str = "inner") -> DataFrame:
        on = [*same, *more]
        return left.alias("l").join(right.alias("r"), functools.reduce(lambda a, b: a & b, on) if on else F.lit(True), how)

    # a row's piece is how many edges lie below it
    cut = meet(rows.filter("_x is not null"), many).select(*(f"l.{c}" for c in k), "_x", F.expr("size(filter(_edges, e -> e < _x))").alias("_piece"))
    sizes = cut.groupBy(*k, "_piece").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.partitionBy(*k).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = sizes.withColumn("_before", before)  # a few rows a key
    asked = meet(pieces, many.select(*k, F.explode("_ranks").alias("_rank"))).filter("_rank.rank > _before AND _rank.rank <= _before + _size")
    asked = asked.groupBy(*(F.col(f"l.{c}") for c in k), "_piece", "_before").agg(F.collect_list("_rank").alias("_own"))
    equal = meet(cut, asked, F.col("l._piece") == F.col("r._piece")).groupBy(*(F.col(f"l.{c}").alias(c) for c in k), F.col("l._piece").alias("_piece"), "_x").agg(F.count("*").alias("_same"), F.first("_before").alias("_before"), F.first("_own").alias("_own"))
    upto = F.col("_before") + F.sum("_same").over(Window.partitionBy(*k, "_piece").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    hits = equal.withColumn("_upto", upto).withColumn("_rank", F.explode("_own")).filter("_rank.rank <= _upto AND _rank.rank > _upto - _same")
    found = hits.groupBy(*k).agg(*(F.max(F.when(F.col("_rank.name") == name, F.col("_x"))).alias(name) for name in at))
    both = meet(few, found, how="left")
    return both.select(*(F.col(f"l.{a}").alias(c) for c, a in zip(keys, k, strict=True)), F.col("l.n").alias("n"), *(F.when(F.col("l.n") > K, F.col(f"r.`{name}`")).otherwise(F.col(f"l.`{name}`")).alias(name) for name in at))


class _Rank:
    """The value of one rank (from 1) of a column, between two values that are known to lie outside."""

    def __init__(self, column: str, rank: int) -> None:
        self.column, self.rank = column, rank
        self.low: float | None = None  # fewer than rank values are at or below it
        self.high: float | None = None  # at least rank values are below it
        self.probes: tuple[float, float] | None = None
        self.value: float | None = None

    def figures(self, i: int) -> list[Column]:
        """What a pass counts: rows below and up to each probe, and a sketch of those between."""
        x = _number(self.column)
        a, b = self.probes or (self.low, self.high)
        inside = F.lit(True)
        if a is not None:
            inside = inside & (x > a)
        if b is not None:
            inside = inside & (x < b)
        counts = []
        for name, c in (("below_a", None if a is None else x < a), ("to_a", None if a is None else x <= a), ("below_b", None if b is None else x < b), ("to_b", None if b is None else x <= b)):
            counts.append((F.lit(0).cast("long") if c is None else F.count_if(c)).alias(f"{i}_{name}"))
        sketch = F.kll_sketch_agg_double(F.when(inside, x), F.lit(K))
        return [*counts, F.kll_sketch_get_n_double(sketch).alias(f"{i}_n"), sketch.alias(f"{i}_sketch")]

    def settle(self, i: int, row) -> str | None:
        """Takes in a pass. What is left is a rank among the n values of its sketch: the rank's place comes as name of a column."""
        a, b = self.probes or (self.low, self.high)
        below_a, to_a, below_b, to_b = (row[f"{i}_{c}"] for c in ("below_a", "to_a", "below_b", "to_b"))
        self.probes = None
        if a is not None and self.rank <= below_a:
            self.high = a
        elif a is not None and self.rank <= to_a:
            self.value = a
        elif b is not None and below_b < self.rank <= to_b:
            self.value = b
        elif b is not None and self.rank > to_b:
            self.low = b
        else:
            self.low, self.high = a, b
            self.left, self.n = self.rank - to_a, row[f"{i}_n"]
            return f"{i}_sketch"
        return None


def _number(column: str) -> Column:
    """A column as double; what is not a number is NULL."""
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


def _ranks(df: DataFrame, wanted: list[_Rank]) -> None:
    """Finds the values of all ranks, by passes over df that narrow them down.

    A pass counts around two probes for each rank, and sketches what lies between, some 300 times fewer rows than
    before; so a few passes do for any table, and a table of up to K rows takes one. A pass always ends with a value
    or with bounds that are closer, so ties and unlucky sketches cost passes, and never the result.
    """
    error = 0.004  # three times a sketch's
    while open_ := [r for r in wanted if r.value is None]:
        figures = [f for i, r in enumerate(open_) for f in r.figures(i)]
        row = df.agg(*figures).first()
        asked: list[tuple[_Rank, str, float]] = []
        for i, r in enumerate(open_):
            if sketch := r.settle(i, row):
                place = (r.left - 0.5) / r.n
                asked += [(r, sketch, place)] if r.n <= K else [(r, sketch, max(place - error, 0.0)), (r, sketch, min(place + error, 1.0))]
        if asked:
            one = df.sparkSession.createDataFrame([[row[s] for _, s, _ in asked]], ", ".join(f"s{j} binary" for j in range(len(asked))))
            found = one.select(*(F.kll_sketch_get_quantile_double(f"s{j}", F.lit(q)) for j, (*_, q) in enumerate(asked))).first()
            for (r, *_), v in zip(asked, found, strict=True):
                if r.n <= K:
                    r.value = v
                else:
                    r.probes = (v, v) if r.probes is None else (r.probes[0], v)


def exact(df: DataFrame, wanted: dict[str, list[float]], between: bool = False) -> dict[tuple[str, float], float | None]:
    """The quantiles asked for of number columns, exact, without sorting or gathering rows; None where a column has no numbers.

    A quantile q of n numbers is the one of rank ceil(q * n), at least the first; with between, it lies between the
    two nearest to q * (n - 1) in proportion. df is read once for the counts and some times more; see _ranks.
    """
    counts = df.agg(*(F.count(_number(c)).alias(str(i)) for i, c in enumerate(wanted))).first()
    ranks: dict[tuple[str, int], _Rank] = {}
    parts: dict[tuple[str, float], list[tuple[_Rank, float]]] = {}
    for n, (column, qs) in zip(counts, wanted.items(), strict=True):
        for q in qs:
            at = q * (n - 1) if between else max(math.ceil(round(q * n, 9)), 1) - 1
            own = [(math.floor(at), 1 - at % 1), (math.ceil(at), at % 1)] if at % 1 else [(int(at), 1.0)]
            parts[column, q] = [(ranks.setdefault((column, i + 1), _Rank(column, i + 1)), w) for i, w in own] if n else []
    _ranks(df, list(ranks.values()))

    def value(own: list[tuple[_Rank, float]]) -> float | None:
        if len(own) == 2:
            (low, _), (high, w) = own
            return low.value + (high.value - low.value) * w
        return own[0][0].value if own else None

    return {key: value(own) for key, own in parts.items()}
