"""Cases the driver's tables do not hold: NULLs in versions, late rows, repeated
keys, rows gone from the store, rules that need a table, JSON members that no
schema names."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions.json_modify import json_modify
from tessera.operators import edits as K
from tessera.operators import history as H
from tessera.operators import jsonops as JO
from tessera.operators import quality as L
from tessera.operators import search as S


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n)


def versions(spark, rows):
    return spark.createDataFrame([(k, at(s), i, x) for k, s, i, x in rows], "k long, ts timestamp_ntz, id long, x long")


def test_as_of_join_shows_the_version_as_a_whole(spark):
    h = H.build_history(versions(spark, [(1, 10, 1, 5), (1, 100, 2, None), (2, 10, 3, 7)]), "k", "ts", "id")
    p = spark.createDataFrame([(1, 1, at(50)), (2, 1, at(150)), (3, 2, at(5)), (4, 2, at(10))], "pid long, k long, t timestamp_ntz")
    got = {r["pid"]: r["x"] for r in H.as_of_join(p, h, "k", "t", ["x"]).collect()}
    assert got == {1: 5, 2: None, 3: None, 4: 7}


def test_late_versions_fall_into_place(spark):
    log = [(1, 10, 1, 5), (1, 100, 2, 6), (2, 50, 3, 1), (1, 60, 4, 9), (1, 5, 5, 0)]
    grown = H.apply_versions(H.build_history(versions(spark, log[:3]), "k", "ts", "id"), versions(spark, log[3:]), "k", "ts", "id")
    whole = H.build_history(versions(spark, log), "k", "ts", "id")
    text = [F.col(c).cast("string") for c in whole.columns]
    assert sorted(map(tuple, grown.select(*whole.columns).select(*text).collect())) == sorted(map(tuple, whole.select(*text).collect()))


def test_one_edit_of_a_key_is_taken(spark):
    cur = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, ver long")
    two = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (2, "z", 5)], "k long, v string, ver long")
    new, _, conflicts = K.save_changes(cur, two, "k", "ver")
    assert sorted(map(tuple, new.collect())) == [(1, "x", 1), (2, "b", 0)]
    assert conflicts.count() == 2
    with pytest.raises(Exception, match="several rows"):
        K.upsert(cur, two, "k").count()
    same, _, _ = K.save_changes(cur, two, "k", "ver", whole_batch=True)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, cur.collect()))


def test_merge_reports_rows_that_are_gone(spark):
    o = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    mine = spark.createDataFrame([(1, "x"), (2, "b"), (3, "new")], "k long, v string")
    merged, conflicts = K.three_way_merge(o, mine, o.where("k = 2"), "k", ["v"])
    assert sorted(map(tuple, merged.collect())) == [(2, "b"), (3, "new")]
    assert list(map(tuple, conflicts.collect())) == [(1, "gone")]


def test_gate_checks_unique_and_foreign_keys(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 10), (3, "b", 99), (4, "c", None), (5, "t", 10)], "k long, v string, f long")
    ref = spark.createDataFrame([(10,)], "id long")
    table = spark.createDataFrame([(9, "t", 10)], "k long, v string, f long")
    good, bad = L.gate(df, [L.Unique(("v",)), L.ForeignKey("f", ref, "id")], table)
    assert [r["k"] for r in good.orderBy("k").collect()] == [4]
    assert {r["k"]: r["broken_rules"] for r in bad.collect()} == {
        1: ["unique:v"], 2: ["unique:v"], 3: ["foreign_key:f"], 5: ["unique:v"]}
    with pytest.raises(TypeError):
        L.gate(df, [object()])


def test_json_aggregates_keep_nulls_and_quote_dates(spark):
    df = spark.createDataFrame([(1, "a", None, dt.date(2024, 1, 2)), (1, "b", 2, None)], "g int, n string, v int, d date")
    assert JO.json_array_by(df, ["g"], ["n", "v"], "j").first()["j"] == '[{"n":"a","v":null},{"n":"b","v":2}]'
    assert JO.json_object_by(df, ["g"], "n", "v", "j").first()["j"] == '{"a":null,"b":2}'
    assert JO.json_object_by(df, ["g"], "n", "d", "j").first()["j"] == '{"a":"2024-01-02","b":null}'


@pytest.mark.parametrize("doc,path,value,want", [
    ('{"a":1,"note":null,"a":2}', "$.b", "x", '{"a":1,"note":null,"a":2,"b":"x"}'),
    ('{"a":1e5,"b":[1,{"c":3}]}', "$.b[1].c", None, '{"a":1e5,"b":[1,{}]}'),
    ('[1,2,3]', "$[1]", None, "[1,null,3]"),
    ('{"a":[1]}', "append $.a", "x", '{"a":[1,"x"]}'),
    ('{"a":1}', "$.b.c", "x", '{"a":1}'),
    ('{"é k":1}', '$."é k"', "ñ", '{"é k":"ñ"}'),
])
def test_json_modify(spark, doc, path, value, want):
    df = spark.createDataFrame([(doc, value)], "d string, v string")
    assert df.select(json_modify(F.col("d"), path, F.col("v")).alias("x")).first()["x"] == want


def test_search_words_and_forms(spark):
    df = spark.createDataFrame([(1, "the house"), (2, "snake_case"), (3, "none")], "i long, x string")
    assert [r["i"] for r in S.free_text(df, "i", "x", "houses").collect()] == [1]
    assert [r["i"] for r in S.free_text(df, "i", "x", "snake_case").collect()] == [2]
