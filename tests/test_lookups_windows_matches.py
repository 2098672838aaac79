"""Point lookups, sketches, named windows, one-pass matches, ordered takes, the
login filter, untracked changes and checked upserts: NULLs, ties, empty tables."""

import os
import tempfile

import pytest
from conftest import SF01
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import text as H
from tessera.operators import changes as C
from tessera.operators import edits as K
from tessera.operators import ordering as O
from tessera.operators import quality as L
from tessera.operators import relational as R
from tessera.operators import reshape as D


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def scanned(df):
    """Rows that the file scan of an executed plan handed on."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_lookup_reads_few_row_groups(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-keyed-"), "t")
    rows = spark.range(0, 80_000, 2).withColumn("x", F.md5(F.col("id").cast("string")))
    R.store_keyed(rows, path, "id", files=16)
    stored = spark.read.parquet(path)
    assert R.lookup(stored, "id", 40_000).first()["x"] == rows.where("id = 40000").first()["x"]
    assert 0 < scanned(R.lookup(stored, "id", 40_000)) <= 40_000 / 8
    assert scanned(R.lookup(stored, "id", 40_001)) == 0  # inside a range, but not in its bloom filter
    assert [tuple(r) for r in R.exists(stored, "id", 7, 8, None).collect()] == [(7, False), (8, True), (None, False)]
    empty = spark.createDataFrame([], "id long, x string")
    assert R.lookup(empty, "id", 1).count() == 0 and [r.found for r in R.exists(empty, "id", 1).collect()] == [False]


def test_sketches_unite_to_the_count_of_all(spark):
    df = spark.range(60_000).select((F.col("id") % 7).cast("int").alias("day"), F.when(F.col("id") % 11 != 0, F.col("id") % 9_000).alias("u"))
    sk = D.distinct_sketches(df, ["day"], ["u"])
    first, second = sk.where("day < 3"), sk.where("day >= 3")  # stored at different times
    n = D.distinct_from_sketches(first.union(second), [], ["u"]).first()["u"]
    exact = df.agg(F.count_distinct("u")).first()[0]
    assert abs(n - exact) <= 0.05 * exact
    per = {r.day: r.u for r in D.distinct_from_sketches(sk, ["day"], ["u"]).collect()}
    for r in df.groupBy("day").agg(F.count_distinct("u").alias("n")).collect():
        assert abs(per[r.day] - r.n) <= 0.05 * r.n
    nulls = spark.createDataFrame([(1, None)], "day int, u string")
    assert D.distinct_from_sketches(D.distinct_sketches(nulls, ["day"], ["u"]), ["day"], ["u"]).first()["u"] == 0
    assert D.distinct_from_sketches(D.distinct_sketches(nulls.limit(0), ["day"], ["u"]), [], ["u"]).first()["u"] == 0


def test_named_windows_share_one_sort(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, 7.0), (1, 2, None), (None, 1, 1.0), (None, 3, 2.0)], "g int, o int, v double")
    w = D.NamedWindows().define("ordered", order_by=["o"]).define("grouped", "ordered", partition_by=["g"])
    w.define("last", "grouped", frame=("rows", -1, 0))
    out = w.select(df, {"s": (F.sum("v"), "grouped"), "r": (F.rank(), "grouped"), "m": (F.max("v"), w.resolve("grouped"))})
    spec = Window.partitionBy("g").orderBy("o")
    assert same(out, df.select("*", F.sum("v").over(spec).alias("s"), F.rank().over(spec).alias("r"), F.max("v").over(spec).alias("m")))
    plan = w.select(df, {"s": (F.sum("v"), "grouped"), "c": (F.count("v"), "last"), "r": (F.rank(), "grouped")})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    assert w.select(df.limit(0), {"s": (F.sum("v"), "grouped")}).count() == 0


def test_named_window_rules():
    w = D.NamedWindows().define("p", partition_by=["g"]).define("po", "p", order_by=["o"]).define("f", "po", frame=("range", 0, 1))
    for wrong in (lambda: w.resolve("p", partition_by=["h"]), lambda: w.resolve("po", order_by=["x"]), lambda: w.resolve("f", order_by=["x"]),
                  lambda: w.resolve("f"), lambda: w.resolve("nope"), lambda: w.define("p"), lambda: w.resolve("p", frame=("rows", 0, 1))):
        with pytest.raises(ValueError):
            wrong()
    assert w.resolve("po").order_by == ("o",) and w.resolve("po").partition_by == ("g",)


def test_matches_with_look_behind_and_absent_groups(spark):
    df = spark.createDataFrame([(1, "a1 b2 c"), (2, None), (3, ""), (4, "ñ1b1")], "i int, s string")
    got = sorted(tuple(r) for r in H.regexp_matches(df, "s", r"(?<=([a-zñ]))(\d)|(c)", 3, keep=["i"]).drop("s").fillna("-").collect())
    assert got == [(1, 1, 2, "1", 2, "a", "1", "-"), (1, 2, 5, "2", 5, "b", "2", "-"), (1, 3, 7, "c", 7, "-", "-", "c"),
                   (4, 1, 2, "1", 2, "ñ", "1", "-"), (4, 2, 4, "1", 4, "b", "1", "-")]
    spans = df.select(H.match_spans("s", "(b?)(x)?").alias("m")).first()["m"]
    assert [(s["start"], s["end"], s["groups"][0]["value"], s["groups"][1]) for s in spans][:2] == [(1, 0, "", None), (2, 1, "", None)]
    plan = H.regexp_matches(df, "s", r"\d", 0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert H.regexp_matches(df.limit(0), "s", r"\d", 0).count() == 0


def test_take_order_breaks_ties_before_the_filter(spark):
    df = spark.createDataFrame([(i, i % 2, None if i == 3 else i // 4) for i in range(12)], "k int, odd int, p int")
    out = R.take_then_filter(df, 5, F.col("odd") == 1, ["k"], take_order=[F.col("p").asc_nulls_first(), F.col("k").desc()])
    assert [r.k for r in out.collect()] == [1, 3, 7]
    assert R.take_then_filter(df.limit(0), 5, F.col("odd") == 1, take_order=["k"]).count() == 0


def test_login_filter(spark):
    me = spark.range(1).select(L.current_login()).first()[0]
    df = spark.createDataFrame([(1, me), (2, "someone else"), (3, None)], "k int, owner string")
    assert [r.k for r in L.owned_rows(df, "owner").collect()] == [1]


def test_untracked_changes_have_no_mask(spark):
    log = spark.createDataFrame([(1, 1, "I", "a"), (1, 3, "U", "b"), (2, 2, "I", "a"), (2, 4, "D", None), (3, 5, "I", "x")], "k int, v long, op string, x string")
    tracked = {r["k"]: r["CT_Columns"] for r in C.changes_since(log, "k", "v", "op", ["x"], 2).collect()}
    rows = C.changes_since(log, "k", "v", "op", ["x"], 2, track_columns=False).collect()
    assert {r["k"]: (r["CT_Version"], r["CT_Operation"], r["CT_Columns"]) for r in rows} == {1: (3, "U", None), 2: (4, "D", None), 3: (5, "I", None)}
    assert tracked[1] == 1 and C.changes_since(log.limit(0), "k", "v", "op", ["x"], 2, track_columns=False).count() == 0


def test_upsert_checks_inside_the_plan(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, x string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, x string")
    assert {(r.k, r.x) for r in K.upsert(df, new, "k").collect()} == {(1, "a"), (2, "B"), (3, "c"), (None, "n")}
    calls = []
    watched = new.withColumn("x", F.udf(lambda v: calls.append(v) or v)("x"))
    K.upsert(df, watched, "k")  # nothing runs before an action
    for bad in ([(5, "a"), (5, "b")], [(None, "a")]):
        with pytest.raises(Exception, match="upsert has"):
            K.upsert(df, spark.createDataFrame(bad, "k int, x string"), "k").count()
    assert K.upsert(df.limit(0), new, "k").count() == 2 and K.upsert(df, new.limit(0), "k").count() == 3


def test_running_sums_keep_their_type(spark):
    df = spark.createDataFrame([(1, i, i) for i in range(50)], "g int, o int, n int").withColumn("d", F.col("n").cast("decimal(12,2)") / 4)
    out = O.running_total(df, ["g"], ["o"], "d", "s", partitions=5)
    kind = df.agg(F.sum("d")).schema[0].dataType
    w = Window.partitionBy("g").orderBy("o")
    assert out.schema["s"].dataType == kind and out.schema["_rank"].dataType.simpleString() == "bigint"
    assert same(out.select("o", "s"), df.select("o", F.sum("d").over(w).cast(kind).alias("s")))
    assert O.running_total(df, ["g"], ["o"], "n", "s").schema["s"].dataType.simpleString() == "bigint"


def test_carries_of_many_partitions(spark):
    # one group over every partition, one summary row each
    df = spark.range(4_000).select(F.lit("g").alias("g"), F.col("id").alias("o"), F.lit(1).alias("v"))
    out = O.group_running(df, ["g"], ["o"], ["v"], ["s"], partitions=150)
    assert out.where("s <> o + 1").count() == 0 and out.count() == 4_000
    assert O.global_row_number(df, ["o"], "rn", partitions=150).where("rn <> o + 1").count() == 0


def test_apply_versions_with_a_null_key_equals_a_rebuild(spark):
    from tessera.operators import history as T

    log = spark.createDataFrame([(None, 1, 1, "a"), (None, 5, 2, "b"), (1, 2, 3, "c"), (1, 4, 4, "d")], "k int, at int, seq int, x string")
    log = log.withColumn("ts", F.timestamp_seconds("at"))
    hist = T.build_history(log.where("seq IN (1, 3)"), "k", "ts", "seq")
    assert same(T.apply_versions(hist, log.where("seq IN (2, 4)"), "k", "ts", "seq"), T.build_history(log, "k", "ts", "seq"))


def test_no_python_in_the_ordered_operators(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    out = O.running_total(li, ["l_partkey"], ["l_orderkey"], "l_quantity", "s")
    assert not any(x in out._jdf.queryExecution().optimizedPlan().toString() for x in ("InPandas", "InArrow", "PythonUDF"))


def test_groups_are_divided_by_their_size(spark, monkeypatch):
    """Groups above the limit take the way over range partitions, the others Spark's window; both give the same."""
    monkeypatch.setattr(O, "GROUP_ROWS", 60)
    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit(1)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 9).cast("int").alias("g"),
                                 (F.col("id") % 37).alias("o"), F.col("id").alias("u"), (F.col("id") % 5).alias("v"))
    w, wu = Window.partitionBy("g").orderBy("o"), Window.partitionBy("g").orderBy("o", "u")
    got = O.running_total(df, ["g"], ["o"], "v", "s", count_name="c")
    assert same(got, df.select("*", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("c"), F.rank().over(w).cast("long").alias("_rank")))
    assert same(O.group_shift(df, ["g"], ["o", "u"], ["v"], ["p"]), df.withColumn("p", F.lag("v").over(wu)))
    assert same(O.group_running(df, [], ["o", "u"], ["v"], ["s"]).select("u", "s"),
                df.select("u", F.sum("v").over(Window.orderBy("o", "u").rowsBetween(Window.unboundedPreceding, 0)).alias("s")))


def test_percentile_brackets_hold_the_ranks(spark):
    """More values than the sketch keeps, with ties, negative numbers, infinities and NaN: equal to the exact built-in."""
    inf, nan = float("inf"), float("nan")
    x = (F.col("id") * 7919 % 30_011).cast("double") - 9_000.5
    odd = F.when(F.col("id") % 1_000 == 1, F.lit(nan)).when(F.col("id") % 1_000 == 2, F.lit(inf)).when(F.col("id") % 1_000 == 3, F.lit(-inf))
    df = spark.range(30_000).select((F.col("id") % 3).cast("int").alias("g"), F.when(F.col("id") % 7 == 0, F.lit(4.25)).otherwise(F.coalesce(odd, x)).alias("x"))
    points = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.75, "e": 0.9871, "f": 1.0}
    got = {r.g: r for r in D.percentiles(df, ["g"], "x", points, accuracy=200).collect()}
    for r in df.groupBy("g").agg(*[F.percentile("x", p).alias(n) for n, p in points.items()]).collect():
        assert str([round(got[r.g][n], 6) for n in points]) == str([round(r[n], 6) for n in points])
    whole = spark.range(50_001).select((F.col("id") * F.col("id") % 50_021).alias("x"))
    exact = whole.agg(F.percentile("x", 0.37)).first()[0]
    assert D.percentiles(whole, [], "x", {"p": 0.37}, accuracy=500).first()["p"] == exact
    assert D.percentiles(df.limit(0), ["g"], "x", points).count() == 0


def test_versions_as_of_equals_the_built_history(spark):
    from tessera.operators import history as T

    log = spark.createDataFrame([(1, "2024-01-01", 1, "a"), (1, "2024-01-01", 2, "b"), (1, "2024-02-01", 3, "c"), (None, "2024-01-05", 4, "n"), (2, "2024-03-01", 5, "z")],
                                "k int, d string, seq int, x string").withColumn("ts", F.col("d").cast("timestamp_ntz"))
    for at in ("2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-20 00:00:00", "2024-02-01 00:00:00", "2030-01-01 00:00:00"):
        want = T.as_of(T.build_history(log, "k", "ts", "seq"), at)
        assert same(T.versions_as_of(log, "k", "ts", "seq", at).select(*want.columns), want)
