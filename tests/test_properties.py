"""Property tests: the distributed ordered helpers equal Spark's windows on
random data, random partition counts and tiny Arrow batches."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import ordering as O

import pytest


@pytest.fixture(autouse=True)
def _restore_batch_size(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


ROWS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 12)),
                          st.one_of(st.none(), st.integers(-5, 5).map(float), st.just(float("nan")))),
                min_size=1, max_size=80)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, parts=st.integers(1, 7), batch=st.integers(1, 9))
def test_running_total_matches_window(spark, rows, parts, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    df = spark.createDataFrame([(i, g, o, v) for i, (g, o, v) in enumerate(rows)], "u int, g int, o int, v double")
    got = O.running_total(df, ["g"], ["o"], "v", "s", count_name="c", partitions=parts)
    w = Window.partitionBy("g").orderBy("o")
    exp = df.select("u", F.sum(F.col("v").cast("double")).over(w).alias("s"), F.count("v").over(w).alias("c"),
                    F.rank().over(w).alias("_rank"))
    assert same(got.select("u", "s", "c", "_rank"), exp)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, parts=st.integers(1, 7), batch=st.integers(1, 9), mode=st.sampled_from(["lag", "lead", "ffill"]))
def test_group_shift_matches_window(spark, rows, parts, batch, mode):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    df = spark.createDataFrame([(i, g, o, v) for i, (g, o, v) in enumerate(rows)], "u int, g int, o int, v double")
    got = O.group_shift(df, ["g"], ["o", "u"], ["v"], ["pv"], mode=mode, partitions=parts)
    w = Window.partitionBy("g").orderBy("o", "u")
    fn = {"lag": F.lag("v").over(w), "lead": F.lead("v").over(w),
          "ffill": F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))}[mode]
    assert same(got.select("u", "pv"), df.select("u", fn.alias("pv")))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(keys=st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True), parts=st.integers(1, 6))
def test_global_row_number_is_rank_of_unique_keys(spark, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = {r.k: r.rn for r in O.global_row_number(df, ["k"], "rn", partitions=parts).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)),
                               st.one_of(st.none(), st.integers(-20, 20).map(float), st.just(float("nan")))),
                     min_size=1, max_size=60),
       parts=st.integers(1, 5), batch=st.integers(1, 9))
def test_percentiles_match_builtin(spark, rows, parts, batch):
    from tessera.operators import reshape as D

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    df = spark.createDataFrame(rows, "g int, x double")
    got = D.percentiles(df, ["g"], "x", {"p25": 0.25, "p50": 0.5, "p90": 0.9}, partitions=parts)
    exp = df.where(F.col("x").isNotNull()).groupBy("g").agg(
        *[F.percentile("x", p).alias(n) for n, p in (("p25", 0.25), ("p50", 0.5), ("p90", 0.9))])

    def canon(r):
        return (r.g,) + tuple(None if v is None else ("nan" if v != v else round(v, 9)) for v in (r.p25, r.p50, r.p90))

    assert sorted(map(canon, got.collect()), key=str) == sorted(map(canon, exp.collect()), key=str)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20)), min_size=1, max_size=40),
       probes=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 22)), min_size=1, max_size=30),
       parts=st.integers(1, 5), batch=st.integers(1, 9))
def test_history_and_as_of_join_match_brute_force(spark, versions, probes, parts, batch):
    from tessera.operators import history as H

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    ts = lambda c: F.concat(F.lit("2024-01-01 00:00:"), F.lpad(F.col(c).cast("string"), 2, "0")).cast("timestamp_ntz")
    v = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(versions)], "k int, s int, seq int").select(
        "k", "seq", ts("s").alias("ts"), F.format_string("v%d", "seq").alias("val"))
    hist = H.build_history(v, "k", "ts", "seq", partitions=parts)
    w = Window.partitionBy("k").orderBy("ts", "seq")
    exp = (v.withColumn("valid_from", F.col("ts"))
           .withColumn("valid_to", F.coalesce(F.lead("ts").over(w), H.end_of_time("timestamp_ntz")))
           .where(F.col("valid_from") < F.col("valid_to")))
    cols = ["k", "seq", "valid_from", "valid_to"]
    assert same(hist.select(*cols), exp.select(*cols))
    p = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(probes)], "pid int, k int, s int").select(
        "pid", "k", ts("s").alias("t"))
    got = H.as_of_join(p, hist.select("k", "val", "valid_from", "valid_to"), "k", "t", ["val"], partitions=parts)
    brute = p.join(exp.select("k", "val", "valid_from", "valid_to"),
                   (p.k == exp.k) & (exp.valid_from <= p.t) & (p.t < exp.valid_to), "left").select(
        p.pid, p.k, p.t, exp.val)
    assert same(got.select("pid", "k", "t", "val"), brute)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(parents=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=20),
       children=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 99)), max_size=40))
def test_left_join_many_equals_left_join(spark, parents, children):
    from tessera.operators.relational import left_join_many

    p = spark.createDataFrame([(i, k) for i, k in enumerate(parents)], "pid int, pk int")
    c = spark.createDataFrame(children, "ck int, payload int") if children else spark.createDataFrame(
        [], "ck int, payload int")
    got = left_join_many(p, c, "pk", "ck").select("pid", "pk", "ck", "payload")
    exp = p.join(c, p.pk == c.ck, "left").select("pid", "pk", "ck", "payload")
    assert same(got, exp)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 1000)), min_size=1,
                     max_size=50, unique_by=lambda r: r[1]),
       parts=st.integers(1, 5))
def test_global_row_number_desc_nulls(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, u int")
    order = [F.col("a").desc_nulls_last(), F.col("u")]
    got = O.global_row_number(df, order, "rn", partitions=parts).select("u", "rn")
    exp = df.select("u", F.row_number().over(Window.orderBy(*order)).alias("rn"))
    assert same(got, exp)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["I", "U", "D"]), st.integers(0, 3)),
                    min_size=1, max_size=40),
       since=st.integers(-1, 40))
def test_change_collapse_matches_python(spark, log, since):
    from tessera.operators import changes as C

    rows = [(k, v, op, val) for v, (k, op, val) in enumerate(log)]
    df = spark.createDataFrame(rows, "k int, v long, op string, val int")
    got = {r.k: (r.CT_Operation, r.CT_Version, r.CT_Columns)
           for r in C.changes_since(df, "k", "v", "op", ["val"], since).collect()}
    exp = {}
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        after = [r for r in mine if r[1] > since]
        if not after:
            continue
        before = [r for r in mine if r[1] <= since]
        first, last = after[0][2], after[-1][2]
        op = "D" if last == "D" else ("I" if first == "I" else "U")
        mask = None
        if op == "U":
            prev = before[-1][3] if before else None
            mask = 0 if prev == after[-1][3] else 1
        exp[k] = (op, after[-1][1], mask)
    assert got == exp
    net = {r.k: (r.operation, r.commit_id, r.val)
           for r in C.net_changes(df, "k", "v", "op", ["val"], since + 1, 10 ** 6).collect()}
    exp_net = {}
    for k, (op, ver, _m) in exp.items():
        mine = sorted((r for r in rows if r[0] == k and r[1] > since), key=lambda r: r[1])
        if mine[0][2] == "I" and mine[-1][2] == "D":
            continue
        code = C.CDC_DELETE if mine[-1][2] == "D" else (C.CDC_INSERT if mine[0][2] == "I" else C.CDC_AFTER)
        exp_net[k] = (code, ver, mine[-1][3])
    assert net == exp_net


VAL = st.one_of(st.none(), st.integers(0, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=st.dictionaries(st.integers(0, 15), st.tuples(VAL, VAL), max_size=12),
       after=st.dictionaries(st.integers(0, 15), st.tuples(VAL, VAL), max_size=12))
def test_snapshot_diff_matches_python(spark, before, after):
    from tessera.operators import changes as C

    schema = "k int, a int, b int"
    mk = lambda d: spark.createDataFrame([(k, a, b) for k, (a, b) in d.items()], schema)
    got = {r.k: (r.operation, r.mask) for r in C.snapshot_diff(mk(before), mk(after), "k", ["a", "b"]).collect()}
    exp = {}
    for k in set(before) | set(after):
        if k not in before:
            exp[k] = ("I", None)
        elif k not in after:
            exp[k] = ("D", None)
        else:
            m = sum(1 << i for i in range(2) if before[k][i] != after[k][i])
            if m:
                exp[k] = ("U", m)
    assert got == exp


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(VAL, VAL, VAL), min_size=1, max_size=20))
def test_three_way_merge_matches_python(spark, rows):
    from tessera.operators import edits as K

    orig = spark.createDataFrame([(i, o) for i, (o, _m, _s) in enumerate(rows)], "k int, x int")
    mine = spark.createDataFrame([(i, m) for i, (_o, m, _s) in enumerate(rows)], "k int, x int")
    stored = spark.createDataFrame([(i, s) for i, (_o, _m, s) in enumerate(rows)], "k int, x int")
    merged, conflicts = K.three_way_merge(orig, mine, stored, "k", ["x"])
    got = {r.k: r.x for r in merged.collect()}
    exp = {i: (s if (s != o and m == o) else m) for i, (o, m, s) in enumerate(rows)}
    assert got == exp
    assert {r.k for r in conflicts.collect()} == {i for i, (o, m, s) in enumerate(rows) if m != o and s != o and m != s}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                               st.one_of(st.none(), st.sampled_from(["a", "b", "c", "Silver", "red"]))),
                     min_size=1, max_size=40))
def test_string_agg_matches_listagg(spark, rows):
    from tessera.operators import reshape as D

    df = spark.createDataFrame(rows, "g int, v string")
    got = {r.g: r.s for r in D.string_agg(df, ["g"], "v", ", ", "s").collect()}
    exp = {r.g: r.s for r in df.where(F.col("v").isNotNull()).groupBy("g").agg(
        F.expr("listagg(v, ', ') WITHIN GROUP (ORDER BY v)").alias("s")).collect()}
    assert got == exp
