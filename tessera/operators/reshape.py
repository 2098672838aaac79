"""Aggregation, reshaping and windows (D, E)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tessera.operators.ordering import group_running, join_null_safe
from tessera.session import cut_lineage


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# D: aggregation


def approx_distinct(df: DataFrame, col: str, rsd: float = 0.05, name: str = "approx") -> DataFrame:
    """HyperLogLog++ distinct count (partial sketches merged per task)."""
    return df.agg(F.approx_count_distinct(col, rsd).alias(name))


def distinct_sketches(df: DataFrame, by: Sequence[str], cols: Sequence[str], bits: int = 14) -> DataFrame:
    """One HyperLogLog sketch per slice (``by``) and column, to be stored
    and united later: ``(*by, col_sketch, ..)``. NULLs are not counted. A
    sketch of ``bits`` has 2^bits registers and a relative error of about
    1.04 / sqrt(2^bits)."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(c, F.lit(bits)).alias(f"{c}_sketch") for c in cols])


def distinct_from_sketches(sketches: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Distinct counts of any union of stored slices: the sketches of each
    ``by`` group are merged (a value in several slices counts once), and
    ``(*by, col, ..)`` has the estimates. New slices need no old data."""
    out = sketches.groupBy(*by) if by else sketches.groupBy()
    return out.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(c) for c in cols])


def string_agg(df: DataFrame, by: Sequence[str], col: str, sep: str = ", ",
               name: str = "string_agg") -> DataFrame:
    """``STRING_AGG(col, sep) WITHIN GROUP (ORDER BY col)``.

    Duplicates kept, NULLs skipped. The result of one group is one value, so
    the group's text is gathered by design; values are first counted per
    (group, value) with a map-side combine, so repeated values do not travel
    one by one.
    """
    counted = (df.where(F.col(col).isNotNull())
               .groupBy(*by, col).agg(F.count(F.lit(1)).alias("_n")))
    return counted.groupBy(*by).agg(
        F.array_join(
            F.flatten(F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(col).alias("v"), F.col("_n").alias("n")))),
                lambda x: F.array_repeat(x["v"], x["n"].cast("int")))),
            sep).alias(name))


def percentiles(df: DataFrame, by: Sequence[str], col: str, points: Mapping[str, float],
                partitions: int | None = None, accuracy: int = 10_000) -> DataFrame:
    """Exact ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY col)`` per group.

    Linear interpolation between the values at ranks floor((N-1)p) and
    ceil((N-1)p); NULLs do not count, a NaN is larger than any number. Two
    passes, neither of which orders the table:

    1. a quantile sketch per group (combined map-side, rank error 1 in
       ``accuracy``) gives, with a margin, values between which both ranks of a
       point must lie;
    2. the rows below each bracket are counted, the few inside it are counted by
       value, and running counts over those values find the ranks.

    Groups without values give no row. A bracket without its ranks, which the sketch's bound rules out, is an
    error. ``partitions`` divides the values inside the brackets over range
    partitions whatever their number.
    """
    keys, names = list(by), list(points)
    if not names:
        raise ValueError("no points")
    if not keys:
        return percentiles(df.withColumn("_all", F.lit(0)), ["_all"], col, points, partitions, accuracy).drop("_all")
    # the sketch works on doubles; the mapping keeps the order (values it makes equal fall on one side together)
    s = F.col(col).cast("double")
    s = F.when(F.isnan(s), float("inf")).otherwise(s)
    rows = df.where(F.col(col).isNotNull()).select(*keys, F.col(col).alias("_x"), s.alias("_s"))
    margin = 3.0 / accuracy
    ends = [x for n in names for x in (max(0.0, points[n] - margin), min(1.0, points[n] + margin))]
    sketch = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_s", ends, accuracy).alias("_q"),
                                     F.min("_s").alias("_min"), F.max("_s").alias("_max"))
    bounds = []
    for i, n in enumerate(names):
        # near the ends, and in groups too small for the margin, the bracket is open
        open_lo = (points[n] - margin <= 0) | (F.col("_n") <= accuracy)
        open_hi = (points[n] + margin >= 1) | (F.col("_n") <= accuracy)
        h = (F.col("_n") - 1) * F.lit(float(points[n]))
        bounds.append(F.struct(F.lit(i).alias("i"), F.when(open_lo, F.col("_min")).otherwise(F.col("_q")[2 * i]).alias("lo"),
                               F.when(open_hi, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias("hi"), h.alias("h")))
    brackets = cut_lineage(sketch.select(*keys, F.array(*bounds).alias("_b")))
    inside = lambda b: (F.col("_s") >= b["lo"]) & (F.col("_s") <= b["hi"])
    placed = join_null_safe(rows, brackets, keys)
    below = placed.groupBy(*keys).agg(*[F.count_if(F.col("_s") < F.col("_b")[i]["lo"]).alias(f"_below{i}") for i in range(len(names))])
    values = (placed.withColumn("_b", F.explode(F.filter("_b", inside)))
              .groupBy(*keys, F.col("_b.i").alias("_i"), "_x").agg(F.first("_b.h").alias("_h"), F.count(F.lit(1)).alias("_c")))
    running = group_running(cut_lineage(values), [*keys, "_i"], ["_x"], ["_c"], ["_upto"], partitions)
    ranked = join_null_safe(running, below, keys)
    before = F.element_at(F.array(*[F.col(f"_below{i}") for i in range(len(names))]), F.col("_i") + 1)
    first, end = before + F.col("_upto") - F.col("_c"), before + F.col("_upto")
    holds = lambda rank: (first <= rank) & (rank < end)
    aggs = []
    for i, n in enumerate(names):
        mine = F.col("_i") == i
        for tag, rank in (("lo", F.floor("_h")), ("hi", F.ceil("_h"))):
            aggs.append(F.max(F.when(mine & holds(rank), F.col("_x"))).alias(f"_{tag}{i}"))
        aggs.append(F.max(F.when(mine, F.col("_h"))).alias(f"_h{i}"))
    picked = ranked.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for i, n in enumerate(names):
        lo, hi, h = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double"), F.col(f"_h{i}")
        lost = F.col(f"_lo{i}").isNull() | F.col(f"_hi{i}").isNull()
        found = F.when((h == F.floor(h)) | (lo == hi), lo).otherwise(lo + (h - F.floor(h)) * (hi - lo))
        out.append(F.when(lost, F.raise_error(F.lit(f"the bracket of {n} lost its rank")).cast("double")).otherwise(found).alias(n))
    return picked.select(*out)


def grouping(df: DataFrame, sets: Sequence[Sequence[str | Column]], aggs: Sequence[Column],
             keys: Sequence[str | Column] | None = None, with_id: bool = True) -> DataFrame:
    """GROUPING SETS with an optional ``grouping_id`` so a real NULL
    key stays apart from the NULL of a rolled-up level. One Expand + partial
    aggregate, so each set is combined map-side before the shuffle."""
    if keys is None:
        keys = []
        for s in sets:
            for c in s:
                if not any(c is k or (isinstance(c, str) and c == k) for k in keys):
                    keys.append(c)
    extra = [F.grouping_id().alias("grouping_id")] if with_id else []
    return df.groupingSets([list(s) for s in sets], *keys).agg(*aggs, *extra)


def rollup(df: DataFrame, cols: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """ROLLUP(a, b, c) = sets (a,b,c), (a,b), (a), ()."""
    return df.rollup(*cols).agg(*aggs)


def cube(df: DataFrame, cols: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """CUBE over all subsets of the columns."""
    return df.cube(*cols).agg(*aggs)


def pivot_sum(df: DataFrame, by: Sequence[str], on: str, values: Sequence, col: str,
              names: Sequence[str]) -> DataFrame:
    """PIVOT SUM over fixed values, one output column per value (NULL when
    no rows). Fixed values mean no extra pass to discover them."""
    out = df.groupBy(*by).pivot(on, list(values)).agg(F.sum(col))
    for v, n in zip(values, names):
        out = out.withColumnRenamed(str(v), n)
    return out


def unpivot_dropping_nulls(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                           name: str, value: str) -> DataFrame:
    """UNPIVOT, which drops NULL values (DataFrame.unpivot keeps them)."""
    return (df.unpivot(list(ids), list(cols), name, value)
            .where(F.col(value).isNotNull()))


# --------------------------------------------------------------------------
# E: windows


@dataclass(frozen=True)
class NamedWindow:
    """A resolved window: its parts, and the Spark specification they make."""

    partition_by: tuple = ()
    order_by: tuple = ()
    frame: tuple | None = None

    @property
    def spec(self) -> WindowSpec:
        w = Window.partitionBy(*[_c(k) for k in self.partition_by])
        if self.order_by:
            w = w.orderBy(*[_c(k) for k in self.order_by])
        if self.frame:
            kind, lo, hi = self.frame
            w = (w.rowsBetween if kind == "rows" else w.rangeBetween)(lo, hi)
        return w


class NamedWindows:
    """The WINDOW clause: names for specifications that extend one another.

    A window may name a base and add what the base does not have: a partition,
    an order, a frame; giving any of them a second time is an error, as is a
    base with a frame. ``select`` adds functions over windows (by name, or by a
    base extended in place) in one projection, so that functions over equal
    partition and order share one exchange and one sort.
    """

    def __init__(self):
        self._windows: dict[str, NamedWindow] = {}

    def resolve(self, base: str | None = None, partition_by: Sequence = (), order_by: Sequence = (), frame: tuple | None = None) -> NamedWindow:
        if base is not None and base not in self._windows:
            raise ValueError(f"no window named {base}")
        under = self._windows[base] if base else NamedWindow()
        for part, mine, given in (("partition", partition_by, under.partition_by), ("order", order_by, under.order_by)):
            if mine and given:
                raise ValueError(f"window {base} has its {part} already")
        if under.frame:
            raise ValueError(f"window {base} has a frame and cannot be extended")
        if frame and not (order_by or under.order_by):
            raise ValueError("a frame needs an order")
        return NamedWindow(tuple(partition_by) or under.partition_by, tuple(order_by) or under.order_by, frame)

    def define(self, name: str, base: str | None = None, **parts) -> NamedWindows:
        if name in self._windows:
            raise ValueError(f"window {name} is defined twice")
        self._windows[name] = self.resolve(base, **parts)
        return self

    def select(self, df: DataFrame, functions: Mapping[str, tuple[Column, str | NamedWindow]], keep: Sequence[str] | None = None) -> DataFrame:
        """``keep`` columns (all by default) and one column for each ``name: (function, window)``.

        A window without a partition is one task's work in Spark; for running
        sums, counts and ranks over a whole table use ``ordering.running_total``.
        """
        unknown = {w for _, w in functions.values() if isinstance(w, str)} - set(self._windows)
        if unknown:
            raise ValueError(f"no window named {sorted(unknown)}")
        over = {name: fn.over((self._windows[w] if isinstance(w, str) else w).spec) for name, (fn, w) in functions.items()}
        return df.select(*(keep or df.columns), *[c.alias(name) for name, c in over.items()])
