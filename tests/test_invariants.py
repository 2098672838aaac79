"""
and scale-shaped cases: a key holding a large share of the rows."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import changes as C
from tessera.operators import compression as Z
from tessera.operators import edits as K
from tessera.operators import history as H
from tessera.operators import ordering as O
from tessera.operators import quality as L
from tessera.operators import relational as R
from tessera.operators import reshape as D
from tessera.plans import fixtures as X
from tessera.sources import tables as S


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


def test_approx_distinct_within_bound(spark):
    o = S.table(spark, SF01, "orders")
    exact = o.agg(F.count_distinct("o_custkey")).first()[0]
    approx = D.approx_distinct(o, "o_custkey", 0.05).first()[0]
    assert abs(approx - exact) <= 0.15 * exact


def test_unpivot_of_pivot_keeps_totals(spark):
    li = S.table(spark, SF01, "lineitem").select(
        F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"),
        F.col("l_quantity").cast("long").alias("v"))
    piv = D.pivot_sum(li, ["y"], "q", [1, 2, 3, 4], "v", ["T1", "T2", "T3", "T4"])
    back = D.unpivot_dropping_nulls(piv, ["y"], ["T1", "T2", "T3", "T4"], "q", "v")
    assert back.agg(F.sum("v")).first()[0] == li.agg(F.sum("v")).first()[0]


def test_running_total_hot_key_matches_window(spark):
    # one key holds most rows: the distributed form must equal the window
    base = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id") % 13).alias("g"),
        (F.col("id") % 97).alias("o"), (F.col("id") % 5).cast("double").alias("v"))
    got = O.running_total(base, ["g"], ["o"], "v", "s", count_name="c", partitions=16)
    w = Window.partitionBy("g").orderBy("o")
    exp = base.withColumn("s", F.sum("v").over(w)).withColumn("c", F.count("v").over(w)).withColumn(
        "_rank", F.rank().over(w))
    assert same(got.select("g", "o", "v", "s", "c", "_rank"), exp.select("g", "o", "v", "s", "c", "_rank"))


def test_percentiles_hot_group_matches_builtin(spark):
    base = spark.range(0, 4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("g%d", F.col("id") % 7)).alias("g"),
        ((F.col("id") * 37) % 1001).cast("double").alias("x"))
    got = D.percentiles(base, ["g"], "x", {"p50": 0.5, "p90": 0.9}, partitions=12)
    exp = base.groupBy("g").agg(F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.9).alias("p90"))
    a = {r.g: (round(r.p50, 6), round(r.p90, 6)) for r in got.collect()}
    b = {r.g: (round(r.p50, 6), round(r.p90, 6)) for r in exp.collect()}
    assert a == b


def test_global_row_number_survives_union(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    n = O.global_row_number(df, ["k"], "rn", partitions=7)
    both = n.unionByName(n)
    assert both.where(F.col("rn") != F.col("k") + 1).count() == 0


def test_apply_versions_equals_rebuild(spark):
    e = S.table(spark, SF01, "events").select("user_id", "event_id", "ts", "event_type")
    cut = "2024-01-15 00:00:00"
    first = e.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
    later = e.where(F.col("ts") >= F.lit(cut).cast("timestamp_ntz"))
    grown = H.apply_versions(H.build_history(first, "user_id", "ts", "event_id"), later,
                             "user_id", "ts", "event_id")
    full = H.build_history(e, "user_id", "ts", "event_id")
    cols = ["user_id", "event_id", "valid_from", "valid_to"]
    assert same(grown.select(*cols), full.select(*cols))


def test_compression_round_trips(spark):
    d = S.table(spark, SF01, "documents")
    r = Z.compression_report(d, ["text"]).first()
    assert r.rows == d.count() and r.bad_roundtrips == 0 and 0 < r.gzip_bytes < r.raw_bytes


def test_gate_splits_batch(spark):
    c = S.table(spark, SF01, "customer")
    good, bad = L.gate(c, [L.Required("c_name"), L.Check("positive", F.col("c_acctbal") >= 0)])
    assert good.count() + bad.count() == c.count()
    assert bad.where(~F.array_contains("broken_rules", "check:positive")).count() == 0


def test_take_then_filter_is_bounded(spark):
    o = S.table(spark, SF01, "orders")
    out = R.take_then_filter(o.orderBy("o_orderkey"), 5, F.col("o_orderkey") % 2 == 0)
    assert out.count() <= 5


def test_exists_and_lookup(spark):
    c = S.table(spark, SF01, "customer")
    assert [tuple(r) for r in R.exists(c, "c_custkey", 3, -5, 3, None).collect()] == [(3, True), (-5, False), (3, True), (None, False)]
    assert R.lookup(c, "c_custkey", 3).count() == 1 and R.lookup(c, "c_custkey", None).count() == 0 and R.lookup(c, "c_custkey", 3, -5, 4).count() == 2


def test_add_drop_columns(spark):
    c = S.table(spark, SF01, "customer")
    added = K.add_columns(c, {"gz": F.lit(None).cast("binary")})
    assert "gz" in added.columns and K.drop_columns(added, ["gz", "missing"]).columns == c.columns


def test_append_select_generates_keys(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-append-"), "t")
    p = S.table(spark, SF01, "part").select("p_name", "p_retailprice")
    S.append_select(p.limit(10), path, key="id")
    S.append_select(p.limit(5), path, key="id")
    stored = spark.read.parquet(path)
    assert stored.count() == 15
    assert sorted(r.id for r in stored.collect()) == list(range(1, 16))


def test_since_version_returns_high_water_mark(spark):
    e = S.table(spark, SF01, "events")
    rows, last = C.since_version(e, "event_id", 100)
    assert rows.agg(F.min("event_id")).first()[0] == 101
    assert last == e.agg(F.max("event_id")).first()[0]


def test_stream_current_state_equals_batch(spark):
    from tessera.streaming.current_state import read_state, stream_current_state

    work = tempfile.mkdtemp(prefix="tessera-stream-")
    log = X.change_log(spark, SF01).select("user_id", "event_id", "op", *X.TRACKED)
    log.repartitionByRange(6, "event_id").write.parquet(os.path.join(work, "log"))
    kw = dict(log_schema=log.schema, state_path=os.path.join(work, "state"),
              checkpoint=os.path.join(work, "ckpt"), key="user_id", version="event_id", op="op",
              columns=X.TRACKED)
    q = stream_current_state(spark, os.path.join(work, "log"), max_files_per_trigger=2, **kw)
    q.awaitTermination()
    schema = log.drop("op").schema
    got = read_state(spark, kw["state_path"], schema)
    exp = C.current_state(log, "user_id", "event_id", "op", X.TRACKED)
    cols = ["user_id", "event_id", *X.TRACKED]
    assert same(got.select(*cols), exp.select(*cols))
    # a replay of the whole log changes nothing
    q2 = stream_current_state(spark, os.path.join(work, "log"), max_files_per_trigger=2,
                              **{**kw, "checkpoint": os.path.join(work, "ckpt2")})
    q2.awaitTermination()
    again = read_state(spark, kw["state_path"], schema)
    assert same(again.select(*cols), exp.select(*cols))


def test_shift_keeps_wall_clock_in_dst_gap(spark):
    # 02:30 on 2024-03-10 does not exist in New York; a zone round trip would move it
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1, 1, "2024-03-10 02:30:00"), (1, 2, "9999-12-31 23:59:59.999999")],
                                   "k int, o int, t string").select(
            "k", "o", F.col("t").cast("timestamp_ntz").alias("t"))
        out = O.group_shift(df, ["k"], ["o"], ["t"], ["nt"], mode="lead").orderBy("o").collect()
        assert str(out[0].t) == "2024-03-10 02:30:00"
        assert str(out[0].nt) == "9999-12-31 23:59:59.999999"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_changes_since_refuses_version_older_than_retained(spark):
    import pytest

    log = X.change_log(spark, SF01)
    bounds = C.version_bounds(C.retain(log, "ts", 2, X.NOW), "event_id").first()
    with pytest.raises(C.VersionTooOld):
        C.changes_since(log, "user_id", "event_id", "op", X.TRACKED, 5, bounds.min_valid_version)
    ok = C.changes_since(log, "user_id", "event_id", "op", X.TRACKED, bounds.min_valid_version,
                         bounds.min_valid_version)
    assert ok.count() > 0


def test_write_json_whole_table(spark):
    import json

    path = os.path.join(tempfile.mkdtemp(prefix="tessera-json-"), "out")
    c = S.table(spark, SF01, "customer")
    S.write_json(c, {"id": "c_custkey", "Info.Nombre": "c_name"}, path)
    lines = spark.read.text(path).collect()
    assert len(lines) == c.count()
    first = json.loads(lines[0].value)
    assert set(first) == {"id", "Info"} and set(first["Info"]) == {"Nombre"}


def test_scans_across_many_arrow_batches(spark):
    # tiny Arrow batches: groups and peers cross batch boundaries inside a partition
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        base = spark.range(0, 3000).select(
            F.when(F.col("id") % 10 < 6, F.lit(1)).otherwise(F.col("id") % 17).alias("g"),
            (F.col("id") % 211).alias("o"), F.col("id").alias("u"),
            F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") % 9).cast("double")).alias("v"))
        got = O.running_total(base, ["g"], ["o"], "v", "s", count_name="c", partitions=9)
        w = Window.partitionBy("g").orderBy("o")
        exp = (base.withColumn("s", F.sum("v").over(w)).withColumn("c", F.count("v").over(w))
               .withColumn("_rank", F.rank().over(w)))
        assert same(got.select("u", "s", "c", "_rank"), exp.select("u", "s", "c", "_rank"))
        wu = Window.partitionBy("g").orderBy("o", "u")
        for mode, fn in (("lag", F.lag("v").over(wu)), ("lead", F.lead("v").over(wu)),
                         ("ffill", F.last("v", True).over(wu.rowsBetween(Window.unboundedPreceding, 0)))):
            sh = O.group_shift(base, ["g"], ["o", "u"], ["v"], ["pv"], mode=mode, partitions=9)
            assert same(sh.select("u", "pv"), base.select("u", fn.alias("pv"))), mode
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_target_partitions_rules(spark):
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    mem = spark.createDataFrame([(1, 2)], "a int, b int")
    # unknown input size (in-memory rows): the shuffle setting, even after a join
    assert O.target_partitions(mem.join(mem.select(F.col("a").alias("x")), F.col("a") == F.col("x"), "left_anti")) == shuffle
    # known file sizes: at least the task slots, never above the cap
    li = S.table(spark, SF01, "lineitem")
    n = O.target_partitions(li.join(li.select(F.col("l_orderkey").alias("k")), F.col("l_orderkey") == F.col("k")))
    assert spark.sparkContext.defaultParallelism <= n <= O.MAX_RANGE_PARTITIONS


def test_save_changes_through_versioned_table(spark):
    from tessera.sources import versioned as V

    base = os.path.join(tempfile.mkdtemp(prefix="tessera-versioned-"), "customer")
    c = S.table(spark, SF01, "customer").select("c_custkey", "c_name", "c_acctbal").withColumn(
        "version", F.lit(1).cast("long"))
    assert V.write_version(c, base) == 1
    cur = V.read_current(spark, base)
    edits = cur.where(F.col("c_custkey") < 30).select(
        "c_custkey", F.upper("c_name").alias("c_name"),
        F.when(F.col("c_custkey") == 3, F.lit(-1.0)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 10 == 5, F.lit(0)).otherwise(F.col("version")).cast("long").alias("version"))
    new, rejected, conflicts = K.save_changes(cur, edits, "c_custkey", "version",
                                              [L.Check("acctbal", F.col("c_acctbal") >= 0)])
    assert V.write_version(new, base) == 2
    after = V.read_current(spark, base)
    assert after.count() == c.count()
    negative = {r.c_custkey for r in c.where((F.col("c_custkey") < 30) & (F.col("c_acctbal") < 0)).collect()}
    bad = negative | {3}
    assert {r.c_custkey for r in rejected.collect()} == bad
    stale = {5, 15, 25} - bad
    assert {r.c_custkey for r in conflicts.collect()} == stale
    bumped = after.where(F.col("version") == 2)
    assert bumped.count() == 30 - len(bad) - len(stale)
    assert bumped.where(F.col("c_name") != F.upper("c_name")).count() == 0
    assert V.read_current(spark, base, version=1).where(F.col("version") == 2).count() == 0


def test_regexp_matches_positions_on_whole_documents(spark):
    from tessera.functions import text as H

    d = S.table(spark, SF01, "documents").select("doc_id", "text")
    m = H.regexp_matches(d, "text", r"\w+", 0, keep=["doc_id"])
    bad = m.where(F.substring("text", F.col("start_position"), F.length("match_value")) != F.col("match_value"))
    assert bad.count() == 0
    per_doc = m.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    counts = d.select("doc_id", H.regexp_count("text", r"\w+").alias("n")).where(F.col("n") > 0)
    assert same(per_doc, counts.select("doc_id", F.col("n").cast("long").alias("n")))


def test_package_zip_holds_the_library():
    import io
    import zipfile

    from tessera.session import _package_zip

    names = zipfile.ZipFile(io.BytesIO(_package_zip())).namelist()
    assert "tessera/operators/ordering.py" in names and "tessera/__init__.py" in names


def test_ordered_operators_on_empty_input(spark):
    empty = spark.createDataFrame([], "g int, o int, v double")
    assert O.global_row_number(empty, ["o"], "rn").count() == 0
    assert O.running_total(empty, ["g"], ["o"], "v", "s").count() == 0
    assert D.percentiles(empty, ["g"], "v", {"p50": 0.5}).count() == 0
    for mode in ("lag", "lead", "ffill"):
        assert O.group_shift(empty, ["g"], ["o"], ["v"], ["pv"], mode=mode).count() == 0
    e = S.table(spark, SF01, "events").where(F.lit(False)).select("user_id", "event_id", "ts")
    assert H.build_history(e, "user_id", "ts", "event_id").count() == 0


def test_stream_picks_up_new_files_on_interval(spark):
    import time

    from tessera.streaming.current_state import read_state, stream_current_state

    work = tempfile.mkdtemp(prefix="tessera-stream2-")
    log = X.change_log(spark, SF01).select("user_id", "event_id", "op", *X.TRACKED)
    first = log.where(F.col("event_id") < 5000)
    first.write.parquet(os.path.join(work, "log", "part=1"))
    q = stream_current_state(spark, os.path.join(work, "log", "*"), log.schema, os.path.join(work, "state"),
                             os.path.join(work, "ckpt"), "user_id", "event_id", "op", X.TRACKED,
                             processing_time="1 second")
    try:
        q.processAllAvailable()
        log.where(F.col("event_id") >= 5000).write.parquet(os.path.join(work, "log", "part=2"))
        deadline = time.time() + 60
        while time.time() < deadline:
            q.processAllAvailable()
            got = read_state(spark, os.path.join(work, "state"), log.drop("op").schema)
            if got.agg(F.max("event_id")).first()[0] == log.agg(F.max("event_id")).first()[0]:
                break
            time.sleep(1)
    finally:
        q.stop()
    exp = C.current_state(log, "user_id", "event_id", "op", X.TRACKED)
    cols = ["user_id", "event_id", *X.TRACKED]
    assert same(got.select(*cols), exp.select(*cols))


def test_nan_is_a_value_not_null_in_python_passes(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, 1, 1.0, nan), (1, 2, nan, 2.0), (1, 3, None, None), (1, 4, 4.0, 3.0)],
                               "g int, o int, v double, other double")
    lag = {r.o: r.pv for r in O.group_shift(df, ["g"], ["o"], ["v"], ["pv"], "lag").collect()}
    assert lag[1] is None and lag[2] == 1.0 and str(lag[3]) == "nan" and lag[4] is None
    ff = {r.o: (r.pv, r.other) for r in O.group_shift(df, ["g"], ["o"], ["v"], ["pv"], "ffill").collect()}
    assert str(ff[2][0]) == "nan" and str(ff[3][0]) == "nan" and ff[4][0] == 4.0
    assert str(ff[1][1]) == "nan" and ff[3][1] is None  # other columns pass through unchanged
    run = {r.o: r.s for r in O.running_total(df, ["g"], ["o"], "v", "s").collect()}
    assert run[1] == 1.0 and all(str(run[o]) == "nan" for o in (2, 3, 4))


def test_write_clustered_gives_disjoint_file_ranges(spark):
    import glob

    import pyarrow.parquet as pq

    from tessera.operators.jsonops import materialise_json
    from tessera.plans.json_queries import phones

    path = os.path.join(tempfile.mkdtemp(prefix="tessera-clustered-"), "t")
    docs = materialise_json(phones(spark, SF01), "phones", {"phone": "$[0].number"})
    S.write_clustered(docs.where(F.col("phone").isNotNull()), path, ["phone"], files=4)
    ranges = []
    for f in sorted(glob.glob(os.path.join(path, "*.parquet"))):
        meta = pq.ParquetFile(f).metadata
        col = [i for i in range(meta.num_columns) if meta.schema.column(i).name == "phone"][0]
        stats = [meta.row_group(r).column(col).statistics for r in range(meta.num_row_groups)]
        ranges.append((min(s.min for s in stats), max(s.max for s in stats)))
    ranges.sort()
    assert len(ranges) >= 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    back = spark.read.parquet(path).where(F.col("phone") == ranges[0][0])
    assert "PushedFilters: [IsNotNull(phone), EqualTo(phone" in back._jdf.queryExecution().executedPlan().toString()


def test_settings_for_input_scale():
    from tessera.session import settings_for_input

    small = settings_for_input(40 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = settings_for_input(100 << 40, 8000)
    # 100 TB / 256 MB = 409,600 partitions, capped at 200,000 (AQE coalesces from there)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_nullable_int_keys_across_batches(spark):
    # a NULL in a batch turns its integer keys into floats in pandas; keys must still match
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        nan = float("nan")
        df = spark.createDataFrame([(0, None, None), (1, None, None), (2, None, None), (3, 2, None), (4, 2, nan)],
                                   "u int, g int, v double")
        got = {r.u: r.pv for r in O.group_shift(df, ["g"], ["u"], ["v"], ["pv"], "lead", partitions=1).collect()}
        assert str(got[3]) == "nan" and got[4] is None
        run = {r.u: r.s for r in O.running_total(df.withColumn("w", F.lit(1.0)), ["g"], ["u"], "w", "s",
                                                  partitions=1).collect()}
        assert run == {0: 1.0, 1: 2.0, 2: 3.0, 3: 1.0, 4: 2.0}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_nan_and_null_group_keys_are_different_groups(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1, 1.0), (nan, 2, 2.0), (None, 3, 3.0), (None, 4, 4.0), (1.0, 5, 5.0)],
                               "g double, o int, v double")
    lag = {r.o: r.pv for r in O.group_shift(df, ["g"], ["o"], ["v"], ["pv"], "lag", partitions=2).collect()}
    assert lag == {1: None, 2: 1.0, 3: None, 4: 3.0, 5: None}
    w = Window.partitionBy("g").orderBy("o")
    got = O.running_total(df, ["g"], ["o"], "v", "s", partitions=2).select("o", "s")
    assert same(got, df.select("o", F.sum("v").over(w).alias("s")))


def test_struct_and_binary_group_keys(spark):
    df = spark.createDataFrame([(1, "a", b"x", 1.0), (2, "a", b"x", 2.0), (3, "b", b"y", 3.0), (4, "b", b"y", 4.0)],
                               "o int, s string, b binary, v double").withColumn("st", F.struct("s", "b"))
    for keys in (["st"], ["b"]):
        got = {r.o: r.pv for r in O.group_shift(df, keys, ["o"], ["v"], ["pv"], "lag", partitions=3).collect()}
        assert got == {1: None, 2: 1.0, 3: None, 4: 3.0}, keys
