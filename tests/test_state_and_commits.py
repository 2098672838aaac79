"""Bucketed stream state, commits of several writers, and stored JSON columns:
what is written, what is removed, what is skipped."""

import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import edits as K
from tessera.operators import jsonops as JO
from tessera.sources import versioned as V
from tessera.streaming import current_state as S1

LOG = "k long, v long, op string, x string"


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix=f"tessera-{name}-"), name)


def expected(rows):
    last = {}
    for k, v, op, x in rows:
        if k not in last or v > last[k][0]:
            last[k] = (v, op, x)
    return {(k, v, x) for k, (v, op, x) in last.items() if op != "D"}


def state(spark, path):
    return {tuple(r) for r in S1.read_state(spark, path, spark.createDataFrame([], "k long, v long, x string").schema).select("k", "v", "x").collect()}


def put(spark, rows, epoch, path, source="s", **options):
    df = spark.createDataFrame(rows, LOG)
    return S1.apply_batch(df, source, epoch, path, spark.createDataFrame([], "k long, v long, x string").schema, "k", "v", "op", ["x"], **options)


def written(path):
    """``{version: buckets}`` of the data folders."""
    root = os.path.join(path, "data")
    return {int(d.split("=")[1]): {int(b.split("=")[1]) for b in os.listdir(os.path.join(root, d)) if b.startswith("bucket=")} for d in os.listdir(root)}


def test_only_touched_buckets_are_written(spark):
    path = folder("state")
    rows = [(k, 1, "I", f"a{k}") for k in range(400)]
    put(spark, rows, 0, path, buckets=16, keep_versions=10)
    assert written(path) == {1: set(range(16))}
    more = [(7, 2, "U", "b"), (7, 3, "U", "c"), (8, 2, "D", None), (7, 1, "U", "late")]
    put(spark, more, 1, path, buckets=99, keep_versions=10)
    assert 1 <= len(written(path)[2]) <= 2 and state(spark, path) == expected(rows + more)
    put(spark, [], 2, path, keep_versions=10)  # an empty batch writes a manifest only
    assert 3 not in written(path) and state(spark, path) == expected(rows + more)
    late = [(8, 1, "I", "revived?"), (None, 1, "I", "null key"), (None, 2, "U", "again")]
    put(spark, late, 3, path, keep_versions=10)
    assert state(spark, path) == expected(rows + more + late)


def test_old_folders_go_and_named_ones_stay(spark):
    path = folder("state")
    rows = [(k, 1, "I", "a") for k in range(200)]
    put(spark, rows, 0, path, buckets=8)
    for e in range(1, 6):
        change = [(k, 1 + e, "U", f"e{e}") for k in (1, 2)]
        put(spark, change, e, path)
        rows += change
    held = written(path)
    last = S1.Manifests(spark, path).last()
    assert len(S1.Manifests(spark, path).versions()) == 2 and state(spark, path) == expected(rows)
    assert {(v, b) for v, bs in held.items() for b in bs} >= {(v, b) for b, v in last.written.items()}
    assert set(held) == {1, 5, 6} and len(held[1]) < 8  # version 1 keeps only the buckets that nothing replaced


def test_replayed_and_restarted_batches(spark):
    path = folder("state")
    a, b = [(1, 1, "I", "a"), (2, 1, "I", "a")], [(1, 2, "U", "b"), (2, 2, "D", None)]
    assert put(spark, a, 0, path) and put(spark, b, 1, path)
    assert not put(spark, b, 1, path) and not put(spark, a, 0, path)  # finished before
    assert state(spark, path) == expected(a + b)
    # a batch that failed after writing its data and before its manifest
    manifest = os.path.join(path, "manifests", f"{2:012d}")
    os.remove(manifest)
    assert state(spark, path) == expected(a) and put(spark, b, 1, path) and state(spark, path) == expected(a + b)
    # the whole log once more under another stream: older rows change nothing
    for e, rows in enumerate((a, b)):
        assert put(spark, rows, e, path, source="other")
    assert state(spark, path) == expected(a + b)


def test_stream_restarts_from_its_checkpoint(spark):
    path, log = folder("state"), folder("log")
    rows = [(k % 20, k, "D" if k % 7 == 0 else "U", str(k)) for k in range(100)]
    kw = dict(log_schema=spark.createDataFrame([], LOG).schema, state_path=path, checkpoint=folder("ckpt"), key="k", version="v", op="op",
              columns=["x"], max_files_per_trigger=1, buckets=4)
    for part in (rows[:30], rows[30:60], rows[60:]):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(log)
        S1.stream_current_state(spark, log, **kw).awaitTermination()
    assert state(spark, path) == expected(rows) and S1.Manifests(spark, path).last().epoch == 2


# ---- commits --------------------------------------------------------------------------------------

def table(spark):
    base = folder("table")
    V.write_version(spark.createDataFrame([(i, "a", 1) for i in range(6)], "k long, x string, version long"), base)
    return base


def test_second_writer_of_a_version_is_refused(spark):
    base = table(spark)
    cur = V.read_current(spark, base)
    assert V.write_version(cur.withColumn("x", F.lit("first")), base, expect=1) == 2
    with pytest.raises(V.CommitConflict):
        V.write_version(cur.withColumn("x", F.lit("second")), base, expect=1)
    with pytest.raises(V.CommitConflict):  # the exclusive creation itself, past the check
        V._commit(spark, base, 2, "v-other")
    assert {r.x for r in V.read_current(spark, base).collect()} == {"first"} and V.versions(spark, base) == [1, 2]
    assert V.write_version(cur, base) == 3 and V.read_current(spark, base, 2).first().x == "first"


def test_update_runs_again_on_what_another_writer_stored(spark):
    base, seen = table(spark), []
    cur = V.read_current(spark, base)
    mine, theirs = cur.where("k < 3").withColumn("x", F.lit("mine")), cur.where("k >= 2").withColumn("x", F.lit("theirs"))

    def rewrite(now):
        seen.append(V.versions(spark, base)[-1])
        if len(seen) == 1:  # the other writer commits in the middle
            V.update(spark, base, lambda t: K.save_changes(t, theirs, "k", "version")[0])
        return K.save_changes(now, mine, "k", "version")[0]

    assert V.update(spark, base, rewrite) == 3 and seen == [1, 2]
    got = {r.k: (r.x, r.version) for r in V.read_current(spark, base).collect()}
    assert got == {0: ("mine", 2), 1: ("mine", 2), **{k: ("theirs", 2) for k in range(2, 6)}}  # row 2 was a conflict


def test_update_gives_up_after_its_attempts(spark):
    base = table(spark)

    def rewrite(now):
        V.write_version(now, base)
        return now

    with pytest.raises(V.CommitConflict):
        V.update(spark, base, rewrite, attempts=2)
    with pytest.raises(FileNotFoundError):
        V.update(spark, folder("none"), lambda t: t)


def test_dead_writers_leave_nothing_that_readers_see(spark):
    base = table(spark)
    V.read_current(spark, base).withColumn("x", F.lit("dead")).write.parquet(os.path.join(base, "v-dead"))
    assert {r.x for r in V.read_current(spark, base).collect()} == {"a"}
    for _ in range(3):
        V.update(spark, base, lambda t: t.withColumn("version", F.col("version") + 1))
    assert V.vacuum(spark, base, keep=2) == 3 and V.versions(spark, base) == [3, 4]
    assert V.read_current(spark, base).first().version == 4 and V.read_current(spark, base, 3).count() == 6


# ---- stored JSON columns --------------------------------------------------------------------------

def test_stored_json_column_is_clustered_and_pruned(spark):
    path = folder("json")
    docs = spark.range(40_000).select("id", F.when(F.col("id") % 50 != 0, F.concat(F.lit('[{"number":"'), F.lpad((F.col("id") * 7919 % 40_000).cast("string"), 5, "0"),
                                                                                     F.lit('"}]'))).alias("phones"))
    JO.store_json_columns(docs, "phones", {"phone": "$[0].number"}, path, files=8)
    files = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")]
    groups = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            col = next(c for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == "phone")
            groups.append((col.statistics.min if col.statistics.has_min_max else None, col.statistics.max if col.statistics.has_min_max else None))
    ranges = sorted(g for g in groups if g[0] is not None)
    assert len(ranges) >= 6 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # every file its own range
    stored = spark.read.parquet(path)
    hit = stored.where(F.col("phone") == "03001")
    assert [r.phone for r in hit.collect()] == ["03001"]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(phone,03001)" in plan
    # rows that the scan hands on are those of the row groups that statistics and bloom filter left
    scans = hit._jdf.queryExecution().executedPlan().collectLeaves()
    read = scans.apply(0).metrics().apply("numOutputRows").value()
    assert 0 < read < 40_000 / 4
    absent = stored.where(F.col("phone") == "03001x")  # inside a range, but in no bloom filter
    assert absent.count() == 0 and stored.where(F.col("phone").like("03%")).count() == docs.where("phones LIKE '[{\"number\":\"03%'").count()
    assert stored.where("phone IS NULL").count() == 800


def test_store_json_columns_of_an_empty_table(spark):
    path = folder("json")
    JO.store_json_columns(spark.createDataFrame([], "id long, d string"), "d", {"v": "$.v"}, path)
    assert spark.read.parquet(path).count() == 0 and spark.read.parquet(path).columns == ["id", "d", "v"]
