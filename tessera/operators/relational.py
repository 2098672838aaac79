"""Projection, filter, joins, sort and paging (B, C, F).

Plain DataFrame compositions: Catalyst pushes the filters into the Parquet
scan, prunes columns, turns IN-subqueries into semi-joins and picks the join
strategy at run time (AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import global_row_number

# Largest side we hand to broadcast() ourselves. AQE may still pick a
# broadcast on its own from runtime statistics.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------
# B: projection and predicates


def full_name(first: str | Column, last: str | Column, sep: str = " ",
              null_as_empty: bool = False) -> Column:
    """B1: ``first + ' ' + last``. SQL rule: NULL in, NULL out; the client-side
    rule (NULL as empty text) is available with ``null_as_empty``."""
    if null_as_empty:
        return F.concat(F.coalesce(_c(first), F.lit("")), F.lit(sep),
                        F.coalesce(_c(last), F.lit("")))
    return F.concat(_c(first), F.lit(sep), _c(last))


def distinct_from(col: str | Column, value) -> Column:
    """``col IS DISTINCT FROM value`` (NULL rows are kept)."""
    v = value if isinstance(value, Column) else F.lit(value)
    return ~_c(col).eqNullSafe(v)


def dynamic_query(df: DataFrame, predicate: Column | None = None,
                  extra_filter: Column | None = None,
                  order_by: Sequence[str | Column] | None = None,
                  take: int | None = None) -> DataFrame:
    """A query composed in steps; every step stays lazy."""
    out = df
    if predicate is not None:
        out = out.where(predicate)
    if extra_filter is not None:
        out = out.where(extra_filter)
    if order_by:
        out = out.orderBy(*[_c(c) for c in order_by])
    if take is not None:
        out = out.limit(take)
    return out


def take_then_filter(df: DataFrame, n: int, predicate: Column,
                     order_by: Sequence[str | Column] | None = None,
                     take_order: Sequence[str | Column] | None = None) -> DataFrame:
    """``Take(n)`` *before* ``Where``: at most n rows survive, and the
    filter and sort act on them. The rows are the first n in ``take_order``
    (a top-n in every task, then one merge), or arbitrary ones without it."""
    first = df.orderBy(*[_c(c) for c in take_order]) if take_order else df
    out = first.limit(n).where(predicate)
    if order_by:
        out = out.orderBy(*[_c(c) for c in order_by])
    return out


def store_keyed(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """The table stored for point lookups: clustered by ``key``, so each
    file and row group has its own key range, with a bloom filter on it."""
    from tessera.sources.tables import write_clustered

    write_clustered(df, path, [key], files=files, bloom=[key])


def lookup(df: DataFrame, key: str, *values) -> DataFrame:
    """Rows with one of the given keys, by a pushed-down filter. On a
    table stored with ``store_keyed`` only the row groups whose range and
    bloom filter admit a key are read. A NULL key finds nothing."""
    return df.where(F.col(key).isin([v for v in values if v is not None]))


def exists(df: DataFrame, key: str, *values) -> DataFrame:
    """``(key, found)`` for each of the given keys, in their order; the
    scan is that of ``lookup``. A NULL key is not found."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    asked = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"_i int, _v {kind}")
    there = lookup(df, key, *values).select(F.col(key).alias("_k")).distinct()  # a row a key asked for, at most
    return (asked.join(there, F.col("_v") == F.col("_k"), "left").orderBy("_i")
            .select(F.col("_v").alias(key), F.col("_k").isNotNull().alias("found")))


def account_number(col: str | Column, prefix: str = "AW", width: int = 8) -> Column:
    """Computed text key ``prefix`` + zero padded id."""
    return F.concat(F.lit(prefix), F.lpad(_c(col).cast("string"), width, "0"))


# --------------------------------------------------------------------------
# C: joins


def size_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a DataFrame's plan (bytes)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join with ``small`` broadcast only when its estimated size is under
    ``limit``; otherwise a normal shuffle join (AQE may still broadcast)."""
    if size_bytes(small) <= limit:
        small = F.broadcast(small)
    return big.join(small, on, how)


def left_join_many(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right`` when the right side is the "many" side and a
    right key may hold a large share of the rows.

    Spark's adaptive skew handling can split only the preserved side of an
    outer join, so the join is written as an inner join (either side may be
    split) plus the left rows with no match, found against the *distinct*
    right keys (a map-side combine, so a hot key becomes one row).
    """
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("_rk")).distinct()
    unmatched = left.join(keys, left[left_key] == F.col("_rk"), "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields
             if f.name not in left.columns]
    return matched.unionByName(unmatched.select(*left.columns, *nulls))


def semi_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """C4: ``key IN (SELECT sub_key FROM sub)`` as a left semi-join."""
    return df.join(sub.select(F.col(sub_key).alias("_in_key")),
                   F.col(key) == F.col("_in_key"), "left_semi")


def join_list(df: DataFrame, col: str, text: str, sep: str = ",",
              value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """Rows whose ``col`` is in a literal list, with the list ordinal.

    The list is a literal, so its size is known and bounded: broadcast.
    """
    from tessera.sources.tables import split_literal

    lst = split_literal(df.sparkSession, text, sep, value, ordinal)
    return df.join(F.broadcast(lst), F.col(col) == F.col(value), "inner")


def gap_fill(days: DataFrame, totals: DataFrame, on: str, day_col: str = "value") -> DataFrame:
    """Keep every value of a series, with NULLs where no totals exist."""
    return days.join(totals, days[day_col] == totals[on], "left")


def child_count(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str,
                name: str = "n_children") -> DataFrame:
    """Children per parent, zero for none. Counted before the join, so a
    parent with a third of all children is one pre-aggregated row."""
    counts = child.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    return (parent.join(counts, F.col(parent_key) == F.col("_ck"), "left")
            .withColumn(name, F.coalesce(F.col("_n"), F.lit(0).cast("long")))
            .drop("_ck", "_n"))


def children_of(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """The child rows that belong to the given parents (semi-join)."""
    return child.join(parent.select(F.col(parent_key).alias("_pk")),
                      F.col(child_key) == F.col("_pk"), "left_semi")


# --------------------------------------------------------------------------
# F: sort, limit, paging


def page(df: DataFrame, order_by: Sequence[str | Column], page_no: int, rows: int) -> DataFrame:
    """``ORDER BY .. OFFSET page*rows ROWS FETCH NEXT rows ROWS ONLY``.

    Becomes a bounded top-k (TakeOrderedAndProject) of ``(page+1)*rows``
    rows. Put a unique key last in ``order_by`` or ties may move pages.
    """
    return df.orderBy(*[_c(c) for c in order_by]).offset(page_no * rows).limit(rows)


def page_numbers(df: DataFrame, order_by: Sequence[str | Column], rows: int,
                 row_col: str = "row_number", page_col: str = "page") -> DataFrame:
    """tag every row with its 0-based page number, numbering the whole
    table once. Numbering is distributed (see ``ordering``)."""
    numbered = global_row_number(df, order_by, row_col)
    return numbered.withColumn(page_col, F.floor((F.col(row_col) - 1) / rows).cast("long"))
