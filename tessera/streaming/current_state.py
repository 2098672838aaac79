"""Keep a current-state table in step with a change log.

The log arrives as files (Structured Streaming file source). Every micro-batch is
reduced to one net change per key (``max_by`` on the version, map-side combined)
and merged into the buckets of the state that its keys belong to. Buckets are
hashes of the key; only those with changes are read and written, into folders of a
new version of the table, so the bytes written follow the batch, not the table. The
version's manifest then names, for every bucket, the version that wrote it last, and
the stream and epoch it comes from. A batch that the last manifest of its stream
already has is not applied again; one that failed before its manifest is built once
more from the version before it. Folders that none of the last manifests names are
removed. State lives in the target table, not in operator state, so no watermark is
needed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_VERSION = "version="
_BUCKET = "bucket="
TOMBSTONE = "_deleted"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


@dataclass(frozen=True)
class Manifest:
    """A version of the table: number of buckets, the version that wrote each bucket last, and the batch it took in."""

    version: int
    buckets: int
    written: dict[int, int]
    source: str
    epoch: int


class Manifests:
    """The manifests of a state table, small texts in a folder of their own."""

    def __init__(self, spark: SparkSession, state_path: str):
        self.spark, self.path = spark, f"{state_path.rstrip('/')}/manifests"

    def versions(self) -> list[int]:
        return sorted(int(n) for n in _names(self.spark, self.path) if n.isdigit())

    def read(self, version: int) -> Manifest:
        fs, p = _fs(self.spark, f"{self.path}/{version:012d}")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        got = json.loads(text)
        return Manifest(version, got["buckets"], {int(b): v for b, v in got["written"].items()}, got["source"], got["epoch"])

    def last(self) -> Manifest | None:
        found = self.versions()
        return self.read(found[-1]) if found else None

    def write(self, m: Manifest) -> None:
        """Written under another name first, so a manifest is there as a whole or not at all."""
        fs, p = _fs(self.spark, f"{self.path}/{m.version:012d}")
        tmp = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_{m.version:012d}")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps({"buckets": m.buckets, "source": m.source, "epoch": m.epoch, "written": m.written}).encode()))
        finally:
            out.close()
        if not fs.rename(tmp, p):
            raise OSError(f"manifest {m.version} could not be put in place")


def _bucket_path(state_path: str, version: int, bucket: int) -> str:
    return f"{state_path.rstrip('/')}/data/{_VERSION}{version:012d}/{_BUCKET}{bucket}"


def _full(schema: T.StructType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != TOMBSTONE] + [T.StructField(TOMBSTONE, T.BooleanType())])


def read_state(spark: SparkSession, state_path: str, schema: T.StructType, keep_tombstones: bool = False,
               buckets: Sequence[int] | None = None) -> DataFrame:
    """The current-state table as of the last finished batch (or some
    ``buckets`` of it). Deleted keys stay in storage as tombstones (so late,
    older changes cannot revive them) and are hidden unless
    ``keep_tombstones``."""
    full, last = _full(schema), Manifests(spark, state_path).last()
    wanted = None if buckets is None else set(buckets)
    paths = [_bucket_path(state_path, v, b) for b, v in (last.written.items() if last else ()) if wanted is None or b in wanted]
    df = spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)
    return df if keep_tombstones else df.where(~F.col(TOMBSTONE)).drop(TOMBSTONE)


def net_changes_of(changes: DataFrame, key: str, version: str, op: str, columns: Sequence[str]) -> DataFrame:
    """One row per key: its last change by version."""
    net = changes.groupBy(key).agg(F.max_by(F.struct(version, op, *columns), version).alias("_n"))
    return net.select(key, *[F.col(f"_n.{c}").alias(c) for c in (version, op, *columns)])


def merge_changes(state: DataFrame, changes: DataFrame, key: str, version: str, op: str,
                  columns: Sequence[str]) -> DataFrame:
    """Apply a batch of log rows to a state table (with tombstones): one net
    row per key (the last by version) replaces the stored row when it is
    newer; a delete leaves a tombstone. Older rows - late files - are
    ignored, so batches may arrive in any order. NULL keys are one key."""
    net = net_changes_of(changes, key, version, op, columns)
    stored = state.select(F.col(key).alias("_sk"), F.col(version).alias("_sv"), F.lit(True).alias("_has"))
    newer = (net.join(stored, F.col(key).eqNullSafe(F.col("_sk")), "left")
             .where(F.col("_has").isNull() | (F.col(version) > F.col("_sv")))
             .drop("_sk", "_sv", "_has"))
    kept = state.join(newer.select(F.col(key).alias("_nk")), F.col(key).eqNullSafe(F.col("_nk")), "left_anti")
    upserts = newer.withColumn(TOMBSTONE, F.col(op) == "D").select(*state.columns)
    return kept.unionByName(upserts)


def apply_batch(batch: DataFrame, source: str, epoch: int, state_path: str, state_schema: T.StructType, key: str, version: str, op: str,
                columns: Sequence[str], buckets: int = 64, keep_versions: int = 2) -> bool:
    """Merge one micro-batch into the buckets it touches; False if the table has it already.

    ``source`` names the stream (its checkpoint) and ``epoch`` the batch.
    ``buckets`` holds for a new state table; an existing one keeps its number.
    The driver sees bucket numbers only. The last ``keep_versions`` manifests
    and what they name are kept, so that readers of the version before can end.
    """
    spark = batch.sparkSession
    manifests = Manifests(spark, state_path)
    last = manifests.last()
    if last and last.source == source and last.epoch >= epoch:
        return False
    number, count = (last.version + 1, last.buckets) if last else (1, buckets)
    bucket = F.pmod(F.xxhash64(key), F.lit(count)).cast("int")
    # reduced once: the bucket numbers and the merge both read it
    net = net_changes_of(batch, key, version, op, columns).withColumn("bucket", bucket).persist()
    try:
        touched = sorted(r["bucket"] for r in net.select("bucket").distinct().collect())
        if touched:
            before = read_state(spark, state_path, state_schema, True, touched)
            merged = merge_changes(before, net.drop("bucket"), key, version, op, columns).withColumn("bucket", bucket)
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
                f"{state_path.rstrip('/')}/data/{_VERSION}{number:012d}")
    finally:
        net.unpersist()
    manifests.write(Manifest(number, count, (last.written if last else {}) | dict.fromkeys(touched, number), source, epoch))
    remove_old(spark, state_path, keep_versions)
    return True


def remove_old(spark: SparkSession, state_path: str, keep_versions: int) -> None:
    """Remove all manifests but the last ``keep_versions`` and the bucket folders that no remaining one names."""
    manifests = Manifests(spark, state_path)
    finished = manifests.versions()
    kept, old = finished[-keep_versions:], finished[:-keep_versions]
    if not old:
        return
    named = {(v, b) for m in kept for b, v in manifests.read(m).written.items()}
    for m in old:
        _delete(spark, f"{manifests.path}/{m:012d}")
    root = f"{state_path.rstrip('/')}/data"
    for folder in _names(spark, root):
        number = int(folder.removeprefix(_VERSION))
        if number > kept[-1]:
            continue
        held = [int(n.removeprefix(_BUCKET)) for n in _names(spark, f"{root}/{folder}") if n.startswith(_BUCKET)]
        gone = [b for b in held if (number, b) not in named]
        if len(gone) == len(held):
            _delete(spark, f"{root}/{folder}")
        else:
            for b in gone:
                _delete(spark, _bucket_path(state_path, number, b))


def stream_current_state(spark: SparkSession, log_path: str, log_schema: T.StructType,
                         state_path: str, checkpoint: str, key: str, version: str, op: str,
                         columns: Sequence[str], max_files_per_trigger: int | None = None,
                         processing_time: str | None = None, buckets: int = 64, keep_versions: int = 2) -> StreamingQuery:
    """Start the stream. By default with ``availableNow`` (process what is
    there, then stop; call ``awaitTermination()``); with
    ``processing_time`` (e.g. ``"1 minute"``) it keeps running and picks up
    new log files every interval. ``buckets`` should make a bucket of the full
    table a few hundred MB."""
    state_schema = T.StructType([log_schema[key], log_schema[version]]
                                + [log_schema[c] for c in columns])

    def apply(batch: DataFrame, epoch_id: int) -> None:
        apply_batch(batch, checkpoint, epoch_id, state_path, state_schema, key, version, op, columns, buckets, keep_versions)

    reader = spark.readStream.schema(log_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.parquet(log_path).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    return writer.start()
