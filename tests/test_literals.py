"""Pinned values from the reference's scripts and comments (FIXTURES.md 1)."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsonfn as J
from tessera.functions import text as H
from tessera.functions.json_modify import Edit, json_modify, json_modify_all
from tessera.operators import jsonops as JO
from tessera.operators import quality as L
from tessera.operators import relational as R
from tessera.operators.history import END_OF_TIME
from tessera.sources import tables as S


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_split_with_ordinal(spark):
    assert rows(S.split_literal(spark, "Rojo,Verde,Azul", ",")) == [("Rojo", 1), ("Verde", 2), ("Azul", 3)]
    assert rows(S.split_literal(spark, "707,708,711", ",")) == [("707", 1), ("708", 2), ("711", 3)]


def test_join_list_keeps_ordinal(spark):
    colors = spark.createDataFrame([(1, "Red"), (2, "Blue"), (3, None), (4, "Silver")], "id int, color string")
    out = R.join_list(colors, "color", "Red,Green,Blue").orderBy("id")
    assert [(r.id, r.value, r.ordinal) for r in out.collect()] == [(1, "Red", 1), (2, "Blue", 3)]


def test_trims(spark):
    df = spark.createDataFrame([(" Hola ", "00012300")], "a string, b string")
    r = df.select(F.trim("a"), F.trim("b", F.lit("0")), F.ltrim("b", F.lit("0")),
                  F.rtrim("b", F.lit("0"))).first()
    assert tuple(r) == ("Hola", "123", "12300", "000123")


def test_translate_pinned_and_strict(spark):
    df = spark.createDataFrame([("(91) 555-12", "Íñigo Muñoz José")], "p string, n string")
    r = df.select(H.translate_strict("p", "()-", "   "), H.fold_accents("n")).first()
    assert r[0] == " 91  555 12"
    assert r[1] == "Íñigo Munoz Jose".replace("ñ", "n")
    with pytest.raises(ValueError):
        H.translate_strict("p", "()-", "  ")


def test_openjson_literal_totals(spark):
    doc = '[{"Id":1, "Cant":10, "PVP": 10}, {"Id":2, "Cant":5, "PVP": 2}, {"Id":3, "Cant":1, "PVP": 15}]'
    df = spark.createDataFrame([(doc,)], "doc string")
    out = JO.openjson(df, "doc", "struct<Id:int,Cant:int,PVP:decimal(10,4)>",
                      path_map={"Cantidad": "Cant", "Precio": "PVP"})
    assert out.columns == ["Id", "Cantidad", "Precio"]
    totals = [float(r.Cantidad * r.Precio) for r in out.orderBy("Id").collect()]
    assert totals == [100.0, 10.0, 15.0]


def test_json_null_element_pinned_row(spark):
    doc = '[{"number":"697-555-0142","tipo":"HOME"},{"number":"1","type":"Cell"}]'
    df = spark.createDataFrame([(doc,)], "doc string")
    out = df.select(json_modify(F.col("doc"), "$[1]", F.lit(None))).first()[0]
    assert out == '[{"number":"697-555-0142","tipo":"HOME"},null]'


def test_json_modify_sequence(spark):
    doc = '[{"number":"1","type":"home"}]'
    df = spark.createDataFrame([(doc,)], "doc string")
    d, none = F.col("doc"), F.lit(None)
    new = J.json_object({"number": F.lit("666-555-0175"), "type": F.lit("Cell")})
    df = df.select(json_modify(d, "$[0].type", F.upper(J.json_value("doc", "$[0].type"))).alias("doc"))
    steps = [Edit("$[0].ext", F.lit("0")), Edit("$[0].ext", none), Edit("$[0].tipo", J.json_value("doc", "$[0].type")),
             Edit("$[0].type", none), Edit("append $", new, True)]
    out = df.select(json_modify_all(d, steps)).first()[0]
    assert json.loads(out) == [{"number": "1", "tipo": "HOME"}, {"number": "666-555-0175", "type": "Cell"}]


def test_raw_array(spark):
    doc = '[{"EmailAddress":"ken0@adventure-works.com"}]'
    df = spark.createDataFrame([(doc,)], "doc string")
    arr = F.from_json("doc", "array<struct<EmailAddress:string>>")
    assert df.select(F.to_json(J.json_raw_array(arr, "EmailAddress"))).first()[0] == '["ken0@adventure-works.com"]'


def test_json_value_query_isjson(spark):
    df = spark.createDataFrame([('[{"number":"1","type":"x"}]',), ("1",), ("nope",), (None,)], "d string")
    got = df.select(J.json_value("d", "$[0].type"), J.json_value("d", "$[0]"), J.json_query("d", "$[0]"),
                    J.json_query("d", "$[0].type"), J.is_json("d"), J.is_json("d", "ARRAY")).collect()
    assert tuple(got[0]) == ("x", None, '{"number":"1","type":"x"}', None, 1, 1)
    assert tuple(got[1])[4:] == (0, 0)  # bare scalar is not JSON text here
    assert tuple(got[2])[4:] == (0, 0)
    assert tuple(got[3])[4:] == (None, None)


def test_for_json_path_nests_and_omits_nulls(spark):
    df = spark.createDataFrame([(1, "Ken", None)], "id int, n string, a string")
    out = df.select(J.for_json_path({"ID": "id", "Info.Nombre": "n", "Info.Apellidos": "a"})).first()[0]
    assert out == '{"ID":1,"Info":{"Nombre":"Ken"}}'
    out2 = df.select(J.json_object({"numero": "id", "tipo": "a"})).first()[0]
    assert out2 == '{"numero":1,"tipo":null}'


def test_tax_id_and_email(spark):
    df = spark.createDataFrame([("12345678Z",), ("12345678A",), ("x",), (None,), ("12z",)], "v string")
    assert [r[0] for r in df.select(L.tax_id_ok("v")).collect()] == [True, False, False, True, False]
    em = spark.createDataFrame([("ken0adventure-works.com",), ("ken0@adventure-works.com",)], "e string")
    assert [r[0] for r in em.select(L.email_ok("e")).collect()] == [False, True]


def test_series_and_pages(spark):
    assert [r.value for r in S.series(spark, 1, 31).collect()] == list(range(1, 32))
    people = spark.range(20).select(F.col("id"), F.format_string("n%02d", "id").alias("name"))
    for page in range(3):
        got = [r.id for r in R.page(people, ["name", "id"], page, 3).collect()]
        assert got == list(range(page * 3, page * 3 + 3))
    tagged = R.page_numbers(people, ["name", "id"], 5).orderBy("id").collect()
    assert [r.page for r in tagged] == [i // 5 for i in range(20)]


def test_period_end_and_regex_class(spark):
    assert END_OF_TIME == "9999-12-31 23:59:59.999999"
    df = spark.createDataFrame([("a;b,c-d.e",)], "s string")
    assert [r.value for r in H.regexp_split(df, "s", "[;,-.]+").collect()] == ["a", "b", "c", "d", "e"]


def test_len_and_capitalise(spark):
    df = spark.createDataFrame([("hola mundo  ",)], "s string")
    r = df.select(H.len_rtrim("s"), H.capitalise("s")).first()
    assert r[0] == 10 and r[1] == "Hola mundo  "


def test_distinct_from_keeps_nulls(spark):
    df = spark.createDataFrame([("Silver",), ("Red",), (None,)], "c string")
    assert df.where(R.distinct_from("c", "Silver")).count() == 2
    assert df.where(F.col("c") != "Silver").count() == 1


def test_regexp_matches_positions(spark):
    df = spark.createDataFrame([("BK-1234",), ("xx",), ("ab12cd345",)], "s string")
    got = H.regexp_matches(df, "s", "^([A-Z]{2})-([0-9]{4})$", 2).collect()
    assert [(r.match_id, r.start_position, r.end_position, r.group_1, r.group_2) for r in got] == [
        (1, 1, 7, "BK", "1234")]
    nums = H.regexp_matches(df, "s", r"\d+", 0).where(F.col("s") == "ab12cd345").orderBy("match_id").collect()
    assert [(r.match_value, r.start_position, r.end_position) for r in nums] == [("12", 3, 4), ("345", 7, 9)]


def test_money_es(spark):
    df = spark.createDataFrame([(1234567.5,), (12.0,), (-1234.5,)], "x double")
    assert [r[0] for r in df.select(H.money_es("x")).collect()] == ["1.234.567,50 €", "12,00 €", "-1.234,50 €"]
    half = spark.createDataFrame([("0.125",), ("2.675",)], "x string").select(F.col("x").cast("decimal(10,3)").alias("x"))
    assert [r[0] for r in half.select(H.money_es("x")).collect()] == ["0,13 €", "2,68 €"]


def test_json_query_keeps_member_order(spark):
    df = spark.createDataFrame([('{"z": {"b": 1, "a": [2, {"y": 3, "x": 4}]}}',)], "d string")
    r = df.select(J.json_query("d", "$.z"), J.json_query("d", "$.z.a"), J.json_query("d", "$.z.b")).first()
    assert r[0] == '{"b":1,"a":[2,{"y":3,"x":4}]}' and r[1] == '[2,{"y":3,"x":4}]' and r[2] is None


def test_openjson_kv_raw_values_in_document_order(spark):
    doc = '{"z": {"b": 1, "a": 2}, "s": "x", "n": null, "t": true, "arr": [{"y": 1, "x": 2}], "num": 1.50}'
    df = spark.createDataFrame([(1, doc)], "id int, d string")
    got = {r.key: (r.value, r.type) for r in JO.openjson_kv(df, "d", keep=["id"]).collect()}
    assert got == {"z": ('{"b":1,"a":2}', 5), "s": ("x", 1), "n": (None, 0), "t": ("true", 3),
                   "arr": ('[{"y":1,"x":2}]', 4), "num": ("1.5", 2)}  # numbers in the parser's normal form
    arr = spark.createDataFrame([(1, '[{"b": 1, "a": 2}, 7]')], "id int, d string")
    assert sorted((r.key, r.value, r.type) for r in JO.openjson_kv(arr, "d", keep=["id"]).collect()) == [
        ("0", '{"b":1,"a":2}', 5), ("1", "7", 2)]


def test_openjson_count_arrays_objects_and_missing(spark):
    df = spark.createDataFrame([(1, '{"Addresses": [{"a": 1}, {"a": 2}]}'), (2, '{"Addresses": {"x": 1, "y": 2, "z": 3}}'),
                                (3, '{"Other": 1}'), (4, None), (5, '{"Addresses": []}')], "id int, d string")
    got = {r.id: r.n for r in JO.openjson_count(df, "id", "d", "$.Addresses").collect()}
    assert got == {1: 2, 2: 3, 3: 1, 4: 1, 5: 1}


def test_openjson_with_on_object_and_invalid_text(spark):
    df = spark.createDataFrame([(1, '{"Id": 7, "Cant": 2}'), (2, '[{"Id": 1, "Cant": 3}]'), (3, "nope")],
                               "k int, d string")
    got = [(r.k, r.Id, r.Cant) for r in JO.openjson(df, "d", "struct<Id:int,Cant:int>", keep=["k"]).orderBy("k").collect()]
    assert got == [(1, 7, 2), (2, 1, 3)]  # a single object is one row; text that is not JSON gives none
