"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage, ensure_checkpoint_dir, ship_package

#: words as the query contracts define them: runs of anything but ASCII white space
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder set, package importable on the executors.

    Texts are long rows: where the number of rows in an Arrow batch is Spark's
    default of 10,000 it is set to 1,000, so that a batch is some megabytes.
    """
    ensure_checkpoint_dir(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    ship_package(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Returns the reread frame and its path. Later stages then see the same rows
    however often a task is retried, and nothing is held in executor memory.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables that no later step reads (Hadoop FileSystem, any store)."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of what finished plans hold: driver memory, and the shuffle files that Spark removes once nothing refers to them.

    Spark does so when the driver happens to collect its garbage, which a small
    heap of plans may not cause for hours of large shuffles.
    """
    give_back()
    spark._jvm.System.gc()


#: caches of a worker that a task fills and none needs after it
TASK_CACHES: list[dict] = []


def give_back() -> None:
    """Empty the task's caches and give freed memory back to the system."""
    import ctypes
    import gc

    import pyarrow

    for cache in TASK_CACHES:
        cache.clear()
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidied(fn):
    """``fn`` for ``mapInArrow``, giving freed memory back to the system at the end of the task.

    Python workers are kept for later tasks; without this an idle one holds on
    to what its last task needed.
    """
    def run(batches):
        yield from fn(batches)
        give_back()

    return run


def id_text(col: Column) -> Column:
    """An id as text; null ids read as the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def fold(col: Column, buckets: int) -> Column:
    """Fold of an id: crc32 of its text modulo ``buckets`` (null ids: crc32 of '')."""
    return F.crc32(id_text(col).cast("binary")) % buckets


def unit_hash(*cols: Column, seed: str = "") -> Column:
    """A uniform double in (0, 1) that depends only on the values and the seed.

    The first 52 bits of an md5, so any engine can compute the same number.
    """
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of ``edges (a, b)``: ``(node, label)``.

    Alternating large-star and small-star steps: each round points a node's
    neighbours at the smallest node around it, in a number of rounds that grows
    with the logarithm of the component size. Links stay in DataFrames; each
    round is checkpointed into the shared folder, and only a count and a hash
    sum reach the driver to see that nothing changed. Null ends and loops are
    dropped; nodes without links are not in the result. Links that still change
    after ``max_rounds`` are an error, never a part of the result.
    """
    prepare(edges.sparkSession)

    def state(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).head()
        return r["n"], r["h"]

    # (a, b) with a > b: a points at the smaller b
    cur = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(cur)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: neighbours below a node, and the node itself, point at the least of them
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = cut_lineage(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = state(cur)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still changed after {max_rounds} rounds")
    roots = cur.groupBy("a").agg(F.min("b").alias("label"))
    return roots.select(F.col("a").alias("node"), "label").union(
        cur.select(F.col("b").alias("node")).distinct().join(roots.select(F.col("a").alias("node")), "node", "left_anti")
        .select("node", F.col("node").alias("label")))
