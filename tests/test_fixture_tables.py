"""Small hand-made tables with the reference's schemas (FIXTURES.md 2): the
NULL, empty and tie cases the driver tables do not have."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsonfn as J
from tessera.functions import text as H
from tessera.operators import changes as C
from tessera.operators import edits as K
from tessera.operators import hierarchy as M
from tessera.operators import jsonops as JO
from tessera.operators import quality as L
from tessera.operators import relational as R
from tessera.operators import reshape as D
from tessera.sources import tables as S


@pytest.fixture(scope="module")
def person(spark):
    rows = [
        (1, "Ken", None, "Sánchez", '[{"number":"697-555-0142","type":"Cell"},{"number":"1","type":"Home"}]'),
        (2, "Terri", "Lee", "Duffy", '[{"number":"819-555-0175","type":"Work"}]'),
        (3, "Roberto", None, "Tamburello", "[]"),
        (4, "Rob", "A", "Walters", None),
        (5, "José", None, "Muñoz", '[{"number":"612-555-0100","type":"Cell"}]'),
        (6, "Ken", "J", "Myer", None),
    ]
    return spark.createDataFrame(rows, "BusinessEntityID int, FirstName string, MiddleName string, "
                                       "LastName string, PhoneNumbers string")


@pytest.fixture(scope="module")
def phones(spark):
    rows = [(1, "697-555-0142", 1), (1, "1", 2), (2, "819-555-0175", 3), (5, "612-555-0100", 1)]
    return spark.createDataFrame(rows, "BusinessEntityID int, PhoneNumber string, PhoneNumberTypeID int")


@pytest.fixture(scope="module")
def product(spark):
    rows = [(707, "Sport-100 Helmet, Red", "Red", 31, 34.99), (708, "Sport-100 Helmet, Black", "Black", 31, 34.99),
            (711, "Sport-100 Helmet, Blue", "Blue", 31, 34.99), (712, "AWC Logo Cap", None, 19, 8.99),
            (713, "Long-Sleeve Logo Jersey, S", "Multi", 21, 49.99), (714, "Mountain-100 Silver, 38", "Silver", 1, 3399.99),
            (715, "Mountain-100 Silver, 42", "Silver", 1, 3399.99), (716, "Road-150 Red, 62", "Red", 2, 3578.27),
            (717, "Road-150 Red, 44", "Red", 2, 3578.27)]
    return spark.createDataFrame(rows, "ProductID int, Name string, Color string, ProductSubcategoryID int, "
                                       "ListPrice double")


def test_full_name_null_rules(person):
    got = {r.BusinessEntityID: (r.sql, r.client) for r in person.select(
        "BusinessEntityID", R.full_name("FirstName", "MiddleName").alias("sql"),
        R.full_name("FirstName", "MiddleName", null_as_empty=True).alias("client")).collect()}
    assert got[1] == (None, "Ken ") and got[2] == ("Terri Lee", "Terri Lee")


def test_nested_phones_null_when_none(person, phones, spark):
    types = spark.createDataFrame([(1, "Cell"), (2, "Home"), (3, "Work")], "PhoneNumberTypeID int, Name string")
    ph = phones.join(types, "PhoneNumberTypeID")
    out = JO.nest_children(person.select("BusinessEntityID"), ph.withColumnRenamed("BusinessEntityID", "pid"),
                           "BusinessEntityID", "pid", {"number": "PhoneNumber", "type": "Name"}, "PhoneNumbers",
                           order_by=["PhoneNumber"])
    got = {r.BusinessEntityID: r.PhoneNumbers for r in out.collect()}
    assert json.loads(got[1]) == [{"number": "1", "type": "Home"}, {"number": "697-555-0142", "type": "Cell"}]
    assert got[3] is None and got[4] is None


def test_cross_and_outer_apply_openjson(person):
    schema = "struct<number:string,type:string>"
    cross = JO.openjson(person, "PhoneNumbers", schema, keep=["BusinessEntityID"])
    outer = JO.openjson(person, "PhoneNumbers", schema, keep=["BusinessEntityID"], outer=True)
    assert cross.count() == 4
    assert outer.count() == 4 + 3  # empty array and two NULL documents keep one row each
    counts = {r.BusinessEntityID: r.n for r in JO.openjson_count(person, "BusinessEntityID", "PhoneNumbers").collect()}
    assert counts == {1: 2, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1}


def test_json_value_first_phone_and_filter(person):
    m = JO.materialise_json(person, "PhoneNumbers", {"Phone": "$[0].number"})
    assert sorted(r.BusinessEntityID for r in m.where(F.col("Phone").like("612%")).collect()) == [5]
    assert m.where(F.col("BusinessEntityID") == 4).first().Phone is None


def test_accent_folding_on_accented_names(person):
    got = person.where(F.regexp_like("LastName", F.lit("[áéíóúüñ]"))).select(
        H.fold_accents("LastName")).collect()
    assert sorted(r[0] for r in got) == ["Munoz", "Sanchez"]


def test_json_agg_by_shared_name(person):
    arr = JO.json_array_by(person.select(F.col("FirstName").alias("nombre"), F.col("BusinessEntityID").alias("id"),
                                         F.col("LastName").alias("apellidos")), ["nombre"], ["id", "apellidos"], "ids")
    got = {r.nombre: json.loads(r.ids) for r in arr.collect()}
    assert got["Ken"] == [{"id": 1, "apellidos": "Sánchez"}, {"id": 6, "apellidos": "Myer"}]
    obj = JO.json_object_by(person.select(F.lit(1).alias("g"), "FirstName", "LastName"), ["g"], "FirstName",
                            "LastName", "o").first().o
    assert obj.count('"Ken":') == 2  # repeated names are kept


def test_colour_queries(product):
    assert product.where(R.distinct_from("Color", "Silver")).count() == 7
    assert product.where(F.col("Color") != "Silver").count() == 6
    agg = {r.ProductSubcategoryID: r.colores for r in D.string_agg(
        product, ["ProductSubcategoryID"], "Color", ", ", "colores").collect()}
    assert agg[31] == "Black, Blue, Red" and agg[2] == "Red, Red" and 19 not in agg


def test_percentiles_known_values(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4)] + [("b", 10.0)], "g string, x double")
    got = {r.g: (r.p50, round(r.p90, 9)) for r in D.percentiles(df, ["g"], "x", {"p50": 0.5, "p90": 0.9}).collect()}
    assert got == {"a": (2.5, 3.7), "b": (10.0, 10.0)}


def test_split_to_table_outer_and_matches(spark):
    addr = spark.createDataFrame([(1, "1970 Napa Ct.; Bothell, WA-98011"), (2, None)], "id int, line string")
    parts = H.regexp_split(addr, "line", "[;,-.]+", keep=["id"])
    assert [r.value for r in parts.where("id = 1").orderBy("ordinal").collect()] == [
        "1970 Napa Ct", " Bothell", " WA", "98011"]
    assert parts.where("id = 2").count() == 1
    assert addr.select(H.regexp_instr("line", r"\d+")).first()[0] == 1


def test_manager_tree_levels_and_cycle_guard(spark):
    emp = spark.createDataFrame(
        [(1, None, "Ken", "Sánchez"), (2, 1, "Terri", "Duffy"), (3, 2, "Roberto", "Tamburello"),
         (4, 3, "Rob", "Walters"), (5, 1, "David", "Bradley"), (7, 8, "Cy", "Cle"), (8, 7, "Lo", "Op")],
        "id int, parent int, first string, last string")
    tree = M.manager_tree(emp, emp, 1, "first", "last").orderBy("BusinessEntityID").collect()
    assert [(r.BusinessEntityID, r.RecursionLevel, r.OrganizationNode, r.ManagerFirstName) for r in tree] == [
        (2, 0, "/2/", "Ken"), (3, 1, "/2/3/", "Terri"), (4, 2, "/2/3/4/", "Roberto"), (5, 0, "/5/", "Ken")]
    cyc = M.manager_tree(emp, emp, 7, "first", "last").collect()
    assert len(cyc) == 2  # 8 under 7, then 7 again is refused by the path guard
    with pytest.raises(M.RecursionLimitExceeded):
        M.manager_tree(emp, emp, 1, "first", "last", max_depth=2)
    levels = {r.id: r.level for r in M.hierarchy_level(emp.select("id", "parent")).collect()}
    assert levels == {1: 0, 2: 1, 5: 1, 3: 2, 4: 3}


def test_notifications_owner_conflicts_and_merge(spark):
    notes = spark.createDataFrame(
        [(1, "hola", "ana", False, "ana", 10), (2, "adios", "luis", False, "luis", 11),
         (3, "ok", "ana", True, "luis", 12)],
        "id int, mensaje string, remitente string, leido boolean, propietario string, version bigint")
    assert sorted(r.id for r in L.owned_rows(notes, "propietario", "luis").collect()) == [2, 3]
    edits = spark.createDataFrame([(1, 10), (2, 9), (9, 1)], "id int, version bigint")
    status = {r.id: r.status for r in K.edit_conflicts(notes, edits, "id", "version").collect()}
    assert status == {1: "ok", 2: "conflict", 9: "gone"}
    original = notes.select("id", "mensaje", "leido")
    mine = original.withColumn("mensaje", F.when(F.col("id") == 1, "hola!").otherwise(F.col("mensaje")))
    stored = original.withColumn("leido", F.when(F.col("id") == 1, True).otherwise(F.col("leido"))).withColumn(
        "mensaje", F.when(F.col("id") == 2, "chau").otherwise(F.col("mensaje")))
    merged, conflicts = K.three_way_merge(original, mine, stored, "id", ["mensaje", "leido"])
    got = {r.id: (r.mensaje, r.leido) for r in merged.collect()}
    assert got == {1: ("hola!", True), 2: ("chau", False), 3: ("ok", True)}
    assert conflicts.count() == 0
    mine2 = mine.withColumn("mensaje", F.when(F.col("id") == 2, "bye").otherwise(F.col("mensaje")))
    _m, conflicts2 = K.three_way_merge(original, mine2, stored, "id", ["mensaje", "leido"])
    assert [(r.id, r.field) for r in conflicts2.collect()] == [(2, "mensaje")]


def test_masked_customers(spark):
    masked = spark.createDataFrame(
        [(1, "Ken Sánchez", "ken0@adventure-works.com", "4111-1111-1111-1234", 720, "1980-01-02")],
        "ClienteID int, NombreCompleto string, CorreoElectronico string, TarjetaCredito string, "
        "ScoreRiesgo int, FechaCumple string").withColumn("FechaCumple", F.to_date("FechaCumple"))
    rules = {"NombreCompleto": "text", "CorreoElectronico": "email", "TarjetaCredito": "card",
             "ScoreRiesgo": "number", "FechaCumple": "date"}
    r = L.masked_view(masked, rules).first()
    assert (r.NombreCompleto, r.CorreoElectronico, r.TarjetaCredito, r.ScoreRiesgo, str(r.FechaCumple)) == (
        "Xxx Xxxxxxx", "k***@adventure-works.com", "XXXX-XXXX-XXXX-1234", 0, "1900-01-01")
    assert L.masked_view(masked, rules, privileged=True).first().ScoreRiesgo == 720


def test_change_mask_names(spark):
    df = spark.createDataFrame([(5,)], "m bigint")
    assert df.select(C.mask_names("m", ["a", "b", "c"])).first()[0] == ["a", "c"]
    assert df.select(C.in_mask("m", 1)).first()[0] is False


def test_json_page_and_root(spark, person):
    page = S.json_page(person, {"id": "BusinessEntityID", "Info.Nombre": "FirstName"}, ["BusinessEntityID"], 1, 2)
    assert json.loads(page.first().json) == [{"id": 3, "Info": {"Nombre": "Roberto"}}, {"id": 4, "Info": {"Nombre": "Rob"}}]
    root = person.agg(J.json_root(F.array_sort(F.collect_list("BusinessEntityID")), "Usuarios").alias("j")).first().j
    assert json.loads(root) == {"Usuarios": [1, 2, 3, 4, 5, 6]}


def test_join_small_checks_size(spark, product):
    from conftest import SF01

    nation = S.table(spark, SF01, "nation")
    customer = S.table(spark, SF01, "customer")
    joined = R.join_small(customer, nation, customer.c_nationkey == nation.n_nationkey)
    assert joined.count() == customer.count()
    assert "broadcast" in joined._jdf.queryExecution().optimizedPlan().toString().lower()
    # an in-memory frame has no size estimate: it is not broadcast by hand
    small = product.sparkSession.createDataFrame([("Red", 1)], "Color string, rank int")
    unknown = R.join_small(product, small, "Color")
    assert R.size_bytes(small) > R.BROADCAST_LIMIT_BYTES
    assert unknown.count() == 3


def test_case_insensitive_option(product):
    assert product.where(H.case_insensitive("Color") == "silver").count() == 2
    assert product.where(F.col("Color") == "silver").count() == 0


def test_nest_children_field_may_use_child_key(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, "a"), (1, "b")], "pid int, v string")
    out = JO.nest_children(parent, child, "id", "pid", {"owner": "pid", "v": "v"}, "kids", order_by=["v"])
    got = {r.id: r.kids for r in out.collect()}
    assert json.loads(got[1]) == [{"owner": 1, "v": "a"}, {"owner": 1, "v": "b"}] and got[2] is None


def test_percentiles_null_group_and_global(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)], "g string, x double")
    by_group = {r.g: r.p50 for r in D.percentiles(df, ["g"], "x", {"p50": 0.5}).collect()}
    assert by_group == {None: 2.0, "a": 5.0}
    assert D.percentiles(df, [], "x", {"p50": 0.5}).first().p50 == 3.0


def test_search_switches_forms_synonyms_language(spark):
    import math

    from tessera.operators import search as M2

    docs = spark.createDataFrame([
        (1, "Aluminium frames and aluminiums", "en"), (2, "steel frame", "en"),
        (3, "a light alloy frame", "en"), (4, "aluminium en español", "es")], "id int, text string, lang string")
    assert sorted(r.id for r in M2.free_text(docs, "id", "text", "aluminium").collect()) == [1, 4]
    assert sorted(r.id for r in M2.free_text(docs, "id", "text", "frame", forms=False).collect()) == [2, 3]
    assert sorted(r.id for r in M2.free_text(docs, "id", "text", "frame").collect()) == [1, 2, 3]
    got = {r.id: r.score for r in M2.ranked_search(docs, "id", "text", "aluminium", True, {"aluminium": ["alloy"]},
                                                   "en").collect()}
    n = 3  # English documents
    idf_al, idf_alloy = math.log(n / 1), math.log(n / 1)
    assert set(got) == {1, 3}
    assert abs(got[1] - 2 * idf_al) < 1e-9 and abs(got[3] - 1 * idf_alloy) < 1e-9
