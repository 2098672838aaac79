"""Whole-table and per-group order without one task per group.

A window with an ORDER BY and no PARTITION BY runs in a single task in Spark,
and a partitioned window puts each group in one task. That is right for groups of
up to ``GROUP_ROWS`` rows, so the groups are counted first (one column of the input,
combined map-side) and Spark's own window takes all that are not larger. Larger
groups get the same answers in two levels, all of it DataFrame operations:

1. range-partition the rows on (group keys, order keys); partitions are
   balanced by sampling, and a group holding a third of the table is split
   across many partitions;
2. checkpoint into the shared folder, so the partition a row landed in is
   fixed even if an executor is lost and the work is redone;
3. only the first and the last group of a partition can go on in another one:
   their rows are summed up, one or two rows a partition, and a window over
   these rows gives what each partition carries in from the ones before it (or
   after it, for LEAD);
4. the carried value joins its group as one more row, before the first (after
   the last) of the partition, and Spark's own window over (partition, group)
   does the rest.

No rows reach the driver, and no window holds more than ``GROUP_ROWS`` rows of a
group, one range partition's share of it, or two rows a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tessera.session import cut_lineage, default_parallelism

_LOW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


# Upper bound on range partitions: keeps the summaries small, which have one or
# two rows a partition (200k partitions is about 500 MB each at 100 TB).
MAX_RANGE_PARTITIONS = 200_000
# Groups of more rows are divided over range partitions.
GROUP_ROWS = 4_000_000
# Summaries of up to this many partitions are broadcast, larger ones are joined.
_BROADCAST_PARTITIONS = 10_000
_UNKNOWN_SIZE = 2 ** 63 - 1


def _plan_bytes(df: DataFrame) -> int | None:
    """Size estimate of a plan, bounded by the total size of its leaf inputs
    (join estimates alone can be absurd). None when any input's size is
    unknown (in-memory or checkpointed data)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    est = int(str(plan.stats().sizeInBytes()))
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = int(str(leaves.apply(i).stats().sizeInBytes()))
        if leaf >= _UNKNOWN_SIZE:
            total = None
            break
        total += leaf
    if total is None:  # an input of unknown size: no estimate is trustworthy
        return None
    return min(est, total)


def target_partitions(df: DataFrame) -> int:
    """Partitions for an explicit range repartition (which AQE does not
    coalesce): the estimated size over the advisory partition size, at
    least the cluster's task slots. When the size is unknown (an in-memory
    or checkpointed frame) the shuffle setting is used."""
    spark = df.sparkSession
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    per = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory))
    try:
        size = _plan_bytes(df)
    except Py4JError:  # a plan without an estimate
        size = None
    if size is None:
        return default_parallelism(spark)
    slots = max(1, spark.sparkContext.defaultParallelism)
    return max(slots, min(MAX_RANGE_PARTITIONS, -(-size // max(per, 1))))


def _ranged(df: DataFrame, order: Sequence[str | Column], partitions: int | None) -> tuple[DataFrame, int]:
    """Range-partition and sort, stamp each row with ``__rid`` (its place: partition
    id in the high bits, position in the partition in the low 33 bits) and
    ``__pid``, then checkpoint. Returns the rows and the number of partitions."""
    n = partitions or target_partitions(df)
    ranged = (df.repartitionByRange(n, *_cols(order)).sortWithinPartitions(*_cols(order))
              .withColumn("__rid", F.monotonically_increasing_id()))
    return cut_lineage(ranged).withColumn("__pid", F.shiftright("__rid", _LOW_BITS).cast("int")), n


def _by_size(df: DataFrame, gcols: list[str], partitions: int | None) -> tuple[DataFrame | None, DataFrame | None]:
    """The rows of groups for one task each, and those of larger groups (None: there are none).

    With ``partitions`` given, all rows count as those of large groups.
    """
    if partitions:
        return None, df
    if not gcols:
        return (df, None) if df.count() <= GROUP_ROWS else (None, df)
    large = df.groupBy(*gcols).count().where(F.col("count") > GROUP_ROWS)
    if not large.limit(1).count():
        return df, None
    large = cut_lineage(large.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(gcols)]))
    same = F.lit(True)
    for i, g in enumerate(gcols):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def _both(small: DataFrame | None, large: DataFrame | None) -> DataFrame:
    return large if small is None else small if large is None else small.unionByName(large)


def _small(df: DataFrame, partitions: int) -> DataFrame:
    """A summary with a row a partition: broadcast while that is few rows."""
    return F.broadcast(df) if partitions <= _BROADCAST_PARTITIONS else df


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order) over the whole table, distributed.

    ``order`` must be a total order (put a unique key last), as for any
    reproducible numbering. One shuffle of the rows (the range exchange).
    """
    fixed, n = _ranged(df, order, partitions)
    before = Window.partitionBy(F.lit(0)).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    counts = fixed.groupBy("__pid").count().select("__pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    local = F.col("__rid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    numbered = fixed.join(_small(counts, n), "__pid").withColumn(name, (F.col("__before") + local + 1).cast("long"))
    return numbered.select(*df.columns, name) if name not in df.columns else numbered.drop("__pid", "__before", "__rid")


# --------------------------------------------------------------------------
# what groups carry from one range partition into others


def _edge_rows(fixed: DataFrame, gcols: list[str], partitions: int) -> DataFrame:
    """The rows of the first and the last group of every partition."""
    key = F.struct(*[F.col(g) for g in gcols]) if gcols else F.struct(F.lit(0).alias("_none"))
    ends = fixed.groupBy(F.col("__pid").alias("__ep")).agg(F.min_by(key, "__rid").alias("__first"), F.max_by(key, "__rid").alias("__last"))
    return fixed.join(_small(ends, partitions), F.col("__pid") == F.col("__ep")).where(
        key.eqNullSafe(F.col("__first")) | key.eqNullSafe(F.col("__last"))).select(*fixed.columns)


def _over_partitions(gcols: list[str]):
    """Window over the summaries of a group, in the order of their partitions."""
    return Window.partitionBy(*(gcols or [F.lit(0)])).orderBy("__pid")


def _with_carries(fixed: DataFrame, carries: DataFrame, gcols: list[str], kind: int) -> tuple[DataFrame, Window]:
    """Rows and carries together (rows have ``__kind`` 1), and the window over a partition's share of a group."""
    carries = carries.withColumns({"__kind": F.lit(kind), "__rid": F.lit(-1).cast("long")})
    rows = fixed.withColumn("__kind", F.lit(1)).unionByName(carries, allowMissingColumns=True)
    return rows, Window.partitionBy("__pid", *gcols).orderBy("__kind", "__rid")


def group_running(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                  values: Sequence[str], names: Sequence[str],
                  partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` along ``order_by`` within
    ``partition_by`` (rows with equal keys get separate values: collapse
    peers first). Returns the input columns plus ``names``, each of the type
    that SUM gives: decimals stay decimal, integers long."""
    gcols = list(partition_by)
    small, large = _by_size(df, gcols, partitions)
    kinds = [f.dataType for f in df.select(*[F.sum(v).alias(f"__v{i}") for i, v in enumerate(values)]).schema.fields]
    if small is not None:
        upto = Window.partitionBy(*(gcols or [F.lit(0)])).orderBy(*_cols(order_by)).rowsBetween(Window.unboundedPreceding, 0)
        small = small.select(*df.columns, *[F.sum(F.col(v).cast(k)).over(upto).cast(k).alias(name) for v, k, name in zip(values, kinds, names)])
    if large is not None:
        large = _running_in_parts(large, gcols, order_by, values, names, kinds, partitions)
    return _both(small, large)


def _running_in_parts(df: DataFrame, gcols: list[str], order_by: Sequence[str], values: Sequence[str], names: Sequence[str],
                      kinds: Sequence, partitions: int | None) -> DataFrame:
    fixed, n = _ranged(df, [*gcols, *order_by], partitions)
    fixed = fixed.withColumns({f"__v{i}": F.col(v).cast(kinds[i]) for i, v in enumerate(values)})
    sums = _edge_rows(fixed, gcols, n).groupBy("__pid", *gcols).agg(*[F.sum(f"__v{i}").cast(k).alias(f"__v{i}") for i, k in enumerate(kinds)])
    order = _over_partitions(gcols)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    carries = sums.withColumns({"__turn": F.row_number().over(order), **{f"__c{i}": F.sum(f"__v{i}").over(before) for i in range(len(kinds))}})
    carries = carries.where("__turn > 1").select("__pid", *gcols, *[F.col(f"__c{i}").cast(k).alias(f"__v{i}") for i, k in enumerate(kinds)])
    rows, share = _with_carries(fixed, carries, gcols, 0)
    upto = share.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"__o{i}": F.sum(f"__v{i}").over(upto).cast(k) for i, k in enumerate(kinds)}).where("__kind = 1")
    return rows.select(*df.columns, *[F.col(f"__o{i}").alias(name) for i, name in enumerate(names)])


def running_total(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                  value: str, name: str, count_name: str | None = None,
                  partitions: int | None = None) -> DataFrame:
    """SUM(value) OVER (PARTITION BY .. ORDER BY ..) with the default RANGE
    frame: peers (equal keys) share one value.

    In large groups peers are summed per key first with a map-side combine, so a key holding
    a third of the table becomes one row; the running sums over distinct keys
    are then joined back on the keys (AQE splits a hot key on the big side).
    ``count_name`` adds the running row count (for running averages); ``_rank``
    is the RANK() of the row. The sum has the type that SUM gives.
    """
    small, large = _by_size(df, list(partition_by), partitions)
    kind = df.select(F.sum(value)).schema[0].dataType
    if small is not None:
        over = Window.partitionBy(*(list(partition_by) or [F.lit(0)])).orderBy(*_cols(order_by))
        count = {count_name: F.count(value).over(over)} if count_name else {}
        added = {name: F.sum(value).over(over).cast(kind), **count, "_rank": F.rank().over(over).cast("long")}
        small = small.select(*df.columns, *[c.alias(n) for n, c in added.items()])
    if large is not None:
        large = _total_in_parts(large, partition_by, order_by, value, name, count_name, partitions)
    return _both(small, large)


def _total_in_parts(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], value: str, name: str,
                    count_name: str | None, partitions: int | None) -> DataFrame:
    keys = list(partition_by) + list(order_by)
    per_key = df.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"), F.count(F.lit(1)).alias("_r"))
    kinds = [per_key.schema[c].dataType for c in ("_s", "_c", "_r")]  # a sum of sums is no wider
    sums = _running_in_parts(per_key, list(partition_by), order_by, ["_s", "_c", "_r"], [name, "_cc", "_cr"], kinds, partitions)
    keep = [*keys, name]
    if count_name:
        sums = sums.withColumn(count_name, F.col("_cc"))
        keep.append(count_name)
    sums = sums.withColumn("_rank", F.col("_cr") - F.col("_r") + 1)
    return join_null_safe(df, sums.select(*keep, "_rank"), keys)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` treating NULL as equal to NULL, as GROUP BY and
    window partitions do; the result keeps the left side's key columns.
    With no keys the right side is a single aggregate row: it is read once
    and attached as literals (no cross join)."""
    if not keys:
        rows = right.limit(2).collect()
        if len(rows) != 1:
            raise ValueError("a keyless join needs exactly one row on the right")
        return left.select("*", *[F.lit(rows[0][f.name]).cast(f.dataType).alias(f.name)
                                  for f in right.schema.fields])
    renamed = right.select(*[F.col(k).alias(f"_nk{i}") for i, k in enumerate(keys)],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        part = left[k].eqNullSafe(renamed[f"_nk{i}"])
        cond = part if cond is None else cond & part
    out = left.join(renamed, cond, how)
    return out.drop(*[f"_nk{i}" for i in range(len(keys))])


# --------------------------------------------------------------------------
# previous / next / last-known values within a group (lag, lead, ffill)


def group_shift(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                cols: Sequence[str], names: Sequence[str], mode: str = "lag",
                partitions: int | None = None) -> DataFrame:
    """LAG / LEAD / forward fill of ``cols`` within ``partition_by`` groups in
    ``order_by`` order, without putting a group in one task.

    ``mode``: ``"lag"`` (previous row), ``"lead"`` (next row) or ``"ffill"``
    (last non-NULL value at or before the row; a NaN is a value). Rows need
    a total order within their group.
    """
    gcols, cols = list(partition_by), list(cols)
    small, large = _by_size(df, gcols, partitions)
    if small is not None:
        over = Window.partitionBy(*(gcols or [F.lit(0)])).orderBy(*_cols(order_by))
        small = small.select(*df.columns, *[_neighbour(c, mode, over).alias(name) for c, name in zip(cols, names)])
    if large is not None:
        large = _shift_in_parts(large, gcols, order_by, cols, names, mode, partitions)
    return _both(small, large)


def _neighbour(col: str, mode: str, over: WindowSpec) -> Column:
    if mode == "ffill":
        return F.last(col, True).over(over.rowsBetween(Window.unboundedPreceding, 0))
    return (F.lag if mode == "lag" else F.lead)(col).over(over)


def _shift_in_parts(df: DataFrame, gcols: list[str], order_by: Sequence[str | Column], cols: Sequence[str], names: Sequence[str],
                    mode: str, partitions: int | None) -> DataFrame:
    fixed, n = _ranged(df, [*gcols, *order_by], partitions)
    fixed = fixed.withColumns({f"__v{i}": F.col(c) for i, c in enumerate(cols)})
    held = [f"__v{i}" for i in range(len(cols))]
    edge = _edge_rows(fixed, gcols, n).groupBy("__pid", *gcols)
    order = _over_partitions(gcols)
    if mode == "ffill":
        known = edge.agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("__rid"))).alias(v) for v in held])
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        carries = known.withColumns({"__turn": F.row_number().over(order), **{f"__c{v}": F.last(v, True).over(before) for v in held}})
        carries = carries.where("__turn > 1").select("__pid", *gcols, *[F.col(f"__c{v}").alias(v) for v in held])
    else:
        pick, step = (F.max_by, F.lag) if mode == "lag" else (F.min_by, F.lead)
        row = edge.agg(pick(F.struct(*held), "__rid").alias("__row"))
        carries = row.withColumn("__row", step("__row").over(order)).where("__row IS NOT NULL").select("__pid", *gcols, "__row.*")
    rows, share = _with_carries(fixed, carries, gcols, 2 if mode == "lead" else 0)
    rows = rows.withColumns({f"__o{i}": _neighbour(v, mode, share) for i, v in enumerate(held)}).where("__kind = 1")
    return rows.select(*df.columns, *[F.col(f"__o{i}").alias(name) for i, name in enumerate(names)])
