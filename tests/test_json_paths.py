"""JSON paths, edits by span and typed documents on awkward text: repeated keys,
stored nulls, odd names, strings that hold JSON, text that is not JSON."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import json_path
from tessera.functions import jsonfn as J
from tessera.functions.json_modify import check, edit
from tessera.operators import documents as DOC
from tessera.operators import jsonops as JO

DOC1 = ('{"a":[{"x":1},"{\\"x\\":2}",null,{"x":null,"y":"t"},[{"x":3}],true,1.5e2],"b c":{"it\'s":{"q":"v"},"é":"ñ\\"\\n"},'
        '"n":null,"d":"first","d":"second","e":{},"f":[]}')


def one(spark, doc, *cols):
    return tuple(spark.createDataFrame([(doc,)], "d string").select(*cols).first())


def test_parse_path():
    assert json_path.parse_path('strict $.a[0]."b c"[*]') == json_path.Path((json_path.Name("a"), 0, json_path.Name("b c"), json_path.ANY), True)
    assert json_path.parse_path("append $").append and json_path.parse_path("lax $.x").steps == (json_path.Name("x"),)
    for bad in ("a.b", "$.", "$[x]", "", "$a", "$.a b"):
        with pytest.raises(ValueError):
            json_path.parse_path(bad)


def test_values(spark):
    paths = {"$.a[0].x": "1", "$.a[1]": '{"x":2}', "$.a[1].x": None, "$.a[2]": None, "$.a[3].x": None, "$.a[3].y": "t", "$.a[5]": "true",
             "$.a[4][0].x": "3", '$."b c"."é"': 'ñ"\n', '$."b c"."it\'s".q': "v", "$.n": None, "$.d": "first", "$.e": None, "$.f": None, "$.zz": None, "$": None}
    got = one(spark, DOC1, *[J.json_value("d", p) for p in paths])
    assert dict(zip(paths, got)) == paths


def test_fragments(spark):
    paths = {"$.a[0]": '{"x":1}', "$.a[1]": None, "$.e": "{}", "$.f": "[]", "$.n": None, "$.d": None, "$.a[4]": '[{"x":3}]', '$."b c"."it\'s"': '{"q":"v"}'}
    got = one(spark, DOC1, *[J.json_query("d", p) for p in paths])
    assert dict(zip(paths, got)) == paths


def test_existence_tells_null_from_missing(spark):
    paths = {"$.n": True, "$.zz": False, "$.a[2]": True, "$.a[7]": False, "$.a[3].x": True, "$.a[0].y": False, "$.a[*].x": True, "$.a[*].z": False,
             "$.a[1].x": False, "$.f[*]": False, "$.a[*]": True, "$.e[*]": False, "$.d": True, "$.d.x": False, '$."b c"."it\'s"': True, "$": True, "$.a[4][*].x": True}
    got = one(spark, DOC1, *[J.json_path_exists("d", p) for p in paths])
    assert dict(zip(paths, got)) == paths


@pytest.mark.parametrize("doc", [None, "", "nope", '{"a":1', "1", '"s"'])
def test_text_that_is_no_document(spark, doc):
    assert one(spark, doc, J.json_value("d", "$.a"), J.json_query("d"), J.json_path_exists("d", "$.a")) == (None, None, False)


def test_wildcard_over_only_nulls(spark):
    assert one(spark, '[{"type":null},{}]', J.json_path_exists("d", "$[*].type"), J.json_path_exists("d", "$[1].type")) == (True, False)


def test_strict_paths(spark):
    assert one(spark, DOC1, J.json_value("d", "strict $.a[0].x"), J.json_value("d", "strict $.n"), J.json_query("d", "strict $.e")) == ("1", None, "{}")
    assert one(spark, None, J.json_value("d", "strict $.a"), J.json_query("d", "strict $.a")) == (None, None)
    for bad in (J.json_value("d", "strict $.zz"), J.json_value("d", "strict $.e"), J.json_query("d", "strict $.d")):
        with pytest.raises(Exception, match="no (scalar|object)"):
            one(spark, DOC1, bad)
    with pytest.raises(ValueError):
        J.json_value("d", "$.a[*]")


@pytest.mark.parametrize("doc,any_kind,is_object,is_array", [
    ('{"a":1,"a":2}', 1, 1, 0), (' [1, {"k":null}]\n', 1, 0, 1), ('{"a":1} x', 0, 0, 0), ('{"a":1},{"b":2}', 0, 0, 0), ('{"a":1}],[{"b":2}', 0, 0, 0),
    ('{"a":1}}{"b":{}}', 0, 0, 0), ("[1,]", 0, 0, 0), ("{'a':1}", 0, 0, 0), ("1", 0, 0, 0), ("", 0, 0, 0), (None, None, None, None), ('{"a":NaN}', 0, 0, 0)])
def test_isjson(spark, doc, any_kind, is_object, is_array):
    assert one(spark, doc, J.is_json("d"), J.is_json("d", "OBJECT"), J.is_json("d", "array")) == (any_kind, is_object, is_array)


def test_kinds_of_elements_are_made_once_for_an_array(spark):
    """Not in the lambda over the elements, where the whole array would be parsed again for each."""
    import re

    df = spark.createDataFrame([('[1,"1",null,"null",{"k":"v"},"{\\"k\\":\\"v\\"}",[1,2],true,"true",1.50,""]',), ('[{"a":1},{"b":"x,y"},null,[],2]',),
                                ('[]',), ('["a\\"b",",","]"]',), ('[{"k":1,"k":2},"{}"]',), ("{}",), (None,)], "d string")
    got = [r[0] for r in df.select(json_path.elements_of(F.get_json_object(F.concat(F.lit("["), "d", F.lit("]")), "$[*]"))).collect()]
    assert got == [["1", '"1"', "null", '"null"', '{"k":"v"}', '"{\\"k\\":\\"v\\"}"', "[1,2]", "true", '"true"', "1.5", '""'],
                   ['{"a":1}', '{"b":"x,y"}', "null", "[]", "2"], [], ['"a\\"b"', '","', '"]"'], ['{"k":1,"k":2}', "{}"], None, None]
    plan = df.select(json_path.elements_of(F.col("d")))._jdf.queryExecution().analyzed().toString()
    inner = re.search(r"lambdafunction\(CASE WHEN isnull.*", plan)[0].split("END", 1)[0]
    assert "parsejson" not in inner.lower() and "parse_json" not in inner.lower()


def test_openjson_paths(spark):
    rows = [(1, '{"l":[{"i":1,"p":{"n":"2.5"},"x":[1]},{"i":2},"text",null]}'), (2, '{"l":{"i":9,"p":{"n":1}}}'), (3, '{"l":7}'), (4, None), (5, '{"l":[]}')]
    df = spark.createDataFrame(rows, "k int, d string")
    cols = {"i": ("int", "$.i"), "net": ("decimal(10,4)", "$.p.n"), "x": ("json", "$.x")}
    got = sorted(tuple(r) for r in JO.openjson_paths(df, "d", cols, "$.l", keep=["k"]).selectExpr("k", "i", "string(net) net", "x").fillna(-1).fillna("-").collect())
    assert got == [(1, -1, "-", "-"), (1, -1, "-", "-"), (1, 1, "2.5000", "[1]"), (1, 2, "-", "-"), (2, 9, "1.0000", "-")]
    assert JO.openjson_paths(df, "d", cols, "$.l", keep=["k"], outer=True).count() == 8
    with pytest.raises(Exception, match="no value"):
        JO.openjson_paths(df, "d", cols, "strict $.m", keep=["k"]).collect()


def test_openjson_kv_at_a_path(spark):
    df = spark.createDataFrame([(1, '{"a":[{"k":1.5,"s":"x","n":null,"o":{"z":[]}}]}'), (2, "{}")], "k int, d string")
    got = sorted((r.k, r.key, r.value, r.type) for r in JO.openjson_kv(df, "d", ["k"], path="$.a[0]").collect() if r.key)
    assert got == [(1, "k", "1.5", 2), (1, "n", None, 0), (1, "o", '{"z":[]}', 5), (1, "s", "x", 1)]
    assert JO.openjson_kv(df, "d", ["k"], outer=False, path="$.a[0]").where("k = 2").count() == 0


# ---- edits ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("doc,path,new,want", [
    (' { "a" : 1.50 , "b":[ 1, 2 ] } ', "$.a", "2", ' { "a" : 2 , "b":[ 1, 2 ] } '),
    ('{"a":1,"b":2,"c":3}', "$.b", None, '{"a":1,"c":3}'),
    ('{"a":1, "b":2}', "$.a", None, '{"b":2}'),
    ('{"a":1}', "$.a", None, "{}"),
    ('{"a":1,"a":2}', "$.a", "9", '{"a":9,"a":2}'),
    ("{}", "$.x", "1", '{"x":1}'), ("[ ]", "append $", "1", "[ 1]"), ("[1]", "append $", None, "[1,null]"),
    ('{"a":{"b":[1,2]}}', "$.a.b[1]", None, '{"a":{"b":[1,null]}}'), ('{"a":{"b":[1,2]}}', "$.a.b[2]", "3", '{"a":{"b":[1,2]}}'),
    ('{"a":1}', "append $.l", '"x"', '{"a":1,"l":["x"]}'), ('{"a":1}', "append $.a", "2", '{"a":1}'), ('{"a":1}', "$.a.b", "2", '{"a":1}'),
    ("[1,2]", "$.a", "1", "[1,2]"), ('{"a":1}', "$[0]", "1", '{"a":1}')])
def test_edit(doc, path, new, want):
    assert edit(doc, json_path.parse_path(path), new) == want


@pytest.mark.parametrize("bad", ["", "{", '{"a":1} x', "[1,]", "{'a':1}", '{"a":NaN}', '{"a" 1}'])
def test_edit_refuses_what_is_not_json(bad):
    with pytest.raises((ValueError, IndexError)):
        check(bad)


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=4),
                    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from("abc"), c, max_size=3), max_leaves=12),
       st.lists(st.sampled_from(["a", "b", "c", 0, 1]), min_size=1, max_size=4), st.integers(0, 2))
@settings(max_examples=400, deadline=None)
def test_edit_equals_an_edit_of_the_parsed_document(doc, steps, kind):
    """Set, delete and append against the same edit on Python values."""
    path = ("append " if kind == 2 else "") + "$" + "".join(f"[{s}]" if isinstance(s, int) else f".{s}" for s in steps)
    got = json.loads(edit(json.dumps(doc, indent=1 if kind else None), json_path.parse_path(path), "[7]" if kind != 1 else None))
    want, at = json.loads(json.dumps(doc)), None
    here, ok = want, True
    for s in steps[:-1]:
        ok = isinstance(here, list if isinstance(s, int) else dict) and (s < len(here) if isinstance(s, int) else s in here)
        if not ok:
            break
        here = here[s]
    s = steps[-1]
    if ok and isinstance(here, list if isinstance(s, int) else dict):
        held = s < len(here) if isinstance(s, int) else s in here
        if kind == 0 and (held or isinstance(s, str)):
            here[s] = [7]
        elif kind == 1 and held:
            if isinstance(s, int):
                here[s] = None
            else:
                del here[s]
        elif kind == 2 and held and isinstance(here[s], list):
            here[s].append([7])
        elif kind == 2 and not held and isinstance(s, str):
            here[s] = [[7]]
    assert got == want, at


# ---- typed documents ------------------------------------------------------------------------------

TYPE = "struct<name:string,tags:array<string>,at:struct<city:string>>"


def test_document_round_trip_keeps_unknown_members(spark):
    docs = ['{"name":"x","tags":["a",null],"at":{"city":"c"},"extra":{"n":null,"s":"1"},"k":1}', '{"name":null}', '{"tags":"not a list","z":[]}', "{}", None, "[1]"]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, d string")
    got = {r.i: r for r in DOC.read_document(df, "d", TYPE).withColumn("w", DOC.write_document(F.col("doc"), F.col("rest"), ["name", "tags", "at"])).collect()}
    assert json.loads(got[0].rest) == {"extra": {"n": None, "s": "1"}, "k": 1} and json.loads(got[0].w) == json.loads(docs[0])
    assert got[1].rest is None and json.loads(got[1].w) == {"name": None, "tags": None, "at": None}
    assert json.loads(got[2].rest) == {"tags": "not a list", "z": []} and json.loads(got[2].w) == {"name": None, "at": None, "tags": "not a list", "z": []}
    assert got[4].doc is None and got[4].w is None and got[5].doc is None and got[5].w is None and json.loads(got[3].w) == {"name": None, "tags": None, "at": None}


def test_document_edit_touches_named_members_only(spark):
    df = spark.createDataFrame([(1, '{ "extra" : 1.50,"name":"x","at":{"city":"c","zip":"1"}}'), (2, None), (3, "{}")], "i int, d string")
    out = DOC.edit_document(df, "d", TYPE, {"name": lambda d: F.upper(d["name"]), "tags": lambda d: F.array(F.lit("t"))})
    assert {r.i: r.d for r in out.collect()} == {1: '{ "extra" : 1.50,"name":"X","at":{"city":"c","zip":"1"},"tags":["t"]}', 2: None, 3: '{"name":null,"tags":["t"]}'}
    odd = spark.createDataFrame([('{"tags":{"not":"a list"}}',)], "d string")
    with pytest.raises(Exception, match="another shape"):
        DOC.edit_document(odd, "d", TYPE, {"tags": lambda d: F.array(F.lit("t"))}).collect()
    with pytest.raises(ValueError):
        DOC.edit_document(df, "d", TYPE, {"nope": lambda d: F.lit(1)})
