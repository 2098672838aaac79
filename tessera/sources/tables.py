"""Sources and sinks.

Everything returns a lazy DataFrame; scans are plain Parquet reads so that
Catalyst pushes filters and column pruning into the reader.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A1: scan one table (all columns, all rows; pruning happens later)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, root: str,
                    names: Sequence[str] = DRIVER_TABLES) -> None:
    """Expose the tables as temporary views for SQL-form operators."""
    for name in names:
        table(spark, root, name).createOrReplaceTempView(name)


def series(spark: SparkSession, first: int, last: int, name: str = "value") -> DataFrame:
    """A3: number series with both ends included (GENERATE_SERIES)."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def split_ordinal(df: DataFrame, col: str | Column, sep: str, value: str = "value",
                  ordinal: str = "ordinal", keep: Sequence[str] = ()) -> DataFrame:
    """A4: a delimited string as rows with a 1-based ordinal (STRING_SPLIT .., 1).

    ``sep`` is a literal separator, not a pattern. Rows whose text is NULL
    produce no output, as a table function over NULL produces no rows.
    """
    c = F.col(col) if isinstance(col, str) else col
    pattern = _literal_pattern(sep)
    return df.select(*keep, F.posexplode(F.split(c, pattern)).alias("_pos", value)).select(
        *keep, F.col(value), (F.col("_pos") + 1).cast("int").alias(ordinal))


def split_literal(spark: SparkSession, text: str, sep: str, value: str = "value",
                  ordinal: str = "ordinal") -> DataFrame:
    """A4 on a literal list such as ``'707,708,711'``."""
    one = spark.range(1).select(F.lit(text).alias("_t"))
    return split_ordinal(one, "_t", sep, value, ordinal)


def _literal_pattern(sep: str) -> str:
    out = []
    for ch in sep:
        out.append("\\" + ch if not ch.isalnum() else ch)
    return "".join(out)


def append_select(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                  key: str | None = None, fmt: str = "parquet") -> None:
    """A5: INSERT .. SELECT: append the chosen columns of ``df`` to a table.

    The target's schema wins: columns are matched by name and cast to the
    stored types; a missing column is an error. With ``key`` the rows get a
    generated identity: max stored key + a dense 1-based number. The number is
    assigned with the distributed ordinal helper, never on the driver.
    """
    from tessera.operators.ordering import global_row_number

    spark = df.sparkSession
    src = df.select(*columns) if columns else df
    try:
        existing = spark.read.format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = None  # first write creates the table
    if key is not None:
        start = 0
        if existing is not None:
            start = existing.agg(F.max(key)).first()[0] or 0
        order = [c for c in src.columns if c != key]
        src = global_row_number(src.drop(key) if key in src.columns else src, order, "_rn")
        src = src.withColumn(key, (F.col("_rn") + F.lit(start)).cast("long")).drop("_rn")
    if existing is not None:
        missing = [f.name for f in existing.schema.fields if f.name not in src.columns]
        if missing:
            raise ValueError(f"columns missing for append: {missing}")
        src = src.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                           for f in existing.schema.fields])
    src.write.mode("append").format(fmt).save(path)


def json_page(df: DataFrame, mapping: dict[str, str], order_by: Sequence[str | Column],
              page: int, rows: int, name: str = "json") -> DataFrame:
    """One page of rows rendered as one nested JSON array (FOR JSON PATH).

    The page is bounded (``rows``), so gathering it into one value is safe:
    sort + offset + limit becomes a top-k, then one array aggregate.
    """
    from tessera.functions.jsonfn import nested_struct
    from tessera.operators.relational import page as take_page

    picked = take_page(df, order_by, page, rows)
    keyed = picked.select(F.monotonically_increasing_id().alias("_i"),
                          nested_struct(mapping).alias("_o"))
    return keyed.agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_o"))),
                              lambda x: x["_o"])).alias(name))


def write_json(df: DataFrame, mapping: dict[str, str | Column], path: str,
               mode: str = "errorifexists") -> None:
    """A6 for a whole table: every row as one nested JSON object per line
    (dotted names nest, NULL members are left out), written in parallel by
    the executors - nothing passes through the driver."""
    from tessera.functions.jsonfn import nested_struct

    df.select(F.to_json(nested_struct(mapping)).alias("value")).write.mode(mode).text(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], partition_by: Sequence[str] = (),
                    mode: str = "errorifexists", files: int | None = None, bloom: Sequence[str] = ()) -> None:
    """The Spark stand-in for an index (and for a persisted computed column
    that is indexed, JS18): write the table range-partitioned and sorted by
    ``by``. Each file then covers its own key range, and the Parquet min/max
    statistics of files and row groups let a filter on ``by`` skip the rest
    (partition folders, with ``partition_by``, prune whole directories).
    Columns in ``bloom`` get a Parquet bloom filter besides."""
    from tessera.operators.ordering import target_partitions

    n = files or target_partitions(df)
    out = df.repartitionByRange(n, *by).sortWithinPartitions(*by).write.mode(mode)
    for c in bloom:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)


def table_function(builder: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A parameterised table is just a function returning a DataFrame.

    The decorator only documents intent; composition happens because the
    result is an ordinary lazy DataFrame.
    """
    builder.__tessera_table_function__ = True
    return builder


def schema_of(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)
