"""Queries for JSON columns (JS), nested child documents.

The driver tables carry no JSON documents worth the name, so the documents
are derived from them the way the reference derives ``PhoneNumbers``: one
JSON array per customer built from that customer's orders
(``number`` = order key as text, ``type`` = order priority). Both engines
build the same text from the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions import jsonfn as J
from tessera.functions.json_modify import Edit, json_modify, json_modify_all
from tessera.operators import documents as DOC
from tessera.operators import jsonops as JO
from tessera.plans.registry import query
from tessera.plans.relational_queries import t
from tessera.session import ensure_checkpoint_dir

PHONES = "array<struct<number:string,type:string>>"

# DuckDB side of the derived documents
PH_SQL = """ph AS (
  SELECT c.c_custkey, (SELECT to_json(list(struct_pack(number := CAST(o.o_orderkey AS VARCHAR), type := o.o_orderpriority)
                                      ORDER BY CAST(o.o_orderkey AS VARCHAR), o.o_orderpriority))
                       FROM orders o WHERE o.o_custkey = c.c_custkey) AS phones
  FROM customer c)"""

# one row per phone element with its 0-based index, for rebuilding edited text
PE_SQL = """pe AS (
  SELECT o_custkey AS c_custkey, CAST(o_orderkey AS VARCHAR) AS number, o_orderpriority AS type,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS VARCHAR), o_orderpriority) - 1 AS i
  FROM orders)"""


def phones(spark, sf, type_col=None):
    """customer key + JSON array of the customer's orders (NULL when none)."""
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    fields = {"number": F.col("o_orderkey").cast("string"),
              "type": type_col if type_col is not None else F.col("o_orderpriority")}
    return JO.nest_children(c.select("c_custkey"), o, "c_custkey", "o_custkey", fields, "phones",
                            order_by=list(fields.values()))


def _edited(spark, sf, *edits):
    """The phones after ``(path, new value[, as JSON])`` edits, computed from the document as it was."""
    return phones(spark, sf).select("c_custkey", json_modify_all(F.col("phones"), [Edit(*e) for e in edits]).alias("phones"))


# Fixed value: the phone that the reference's script appends.
NEW_PHONE = "666-555-0175"


def _edit_sql(element_sql: str, append_sql: str = "") -> str:
    return f"""WITH {PE_SQL},
ed AS (SELECT c_custkey, '[' || string_agg({element_sql}, ',' ORDER BY i) || {append_sql or "''"} || ']' AS phones
       FROM pe GROUP BY c_custkey)
SELECT c.c_custkey, ed.phones FROM customer c LEFT JOIN ed ON c.c_custkey = ed.c_custkey"""


_PLAIN = "to_json(struct_pack(number := number, type := type))"


# --------------------------------------------------------------------------
# Child documents


@query("nested_json", f"WITH {PH_SQL} SELECT c_custkey, phones FROM ph")
def nested_json(spark, sf):
    return phones(spark, sf)


@query("nested_children", """
SELECT c.c_custkey, COUNT(DISTINCT o.o_orderkey) AS n_orders, COUNT(l.l_orderkey) AS n_lines
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY c.c_custkey
""")
def nested_children(spark, sf):
    c, o, li = t(spark, sf, "customer"), t(spark, sf, "orders"), t(spark, sf, "lineitem")
    # split-query form: lines nested under orders, then orders under customers
    orders = JO.include(o.select("o_orderkey", "o_custkey"), "o_orderkey", [
        (li, "l_orderkey", {"l_linenumber": "l_linenumber", "l_partkey": "l_partkey"}, "lines",
         ["l_linenumber", "l_partkey"])])
    tree = JO.include(c.select("c_custkey"), "c_custkey", [
        (orders, "o_custkey", {"o_orderkey": "o_orderkey", "lines": "lines"}, "orders",
         ["o_orderkey"])])
    n_orders = F.coalesce(F.size("orders"), F.lit(0)).cast("long")
    n_lines = F.coalesce(F.aggregate("orders", F.lit(0).cast("long"),
                                     lambda acc, x: acc + F.coalesce(F.size(x["lines"]), F.lit(0))),
                         F.lit(0)).cast("long")
    return tree.select("c_custkey", n_orders.alias("n_orders"), n_lines.alias("n_lines"))


# --------------------------------------------------------------------------
# JS1-JS7: build and read


@query("for_json_path", """
SELECT c_custkey, CASE WHEN nullif(c_mktsegment, 'BUILDING') IS NULL
  THEN to_json(struct_pack(ID := c_custkey, Info := struct_pack(Nombre := c_name)))
  ELSE to_json(struct_pack(ID := c_custkey, Info := struct_pack(Nombre := c_name, Segmento := c_mktsegment))) END AS json
FROM customer
""")
def for_json_path(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", J.for_json_path({
        "ID": "c_custkey", "Info.Nombre": "c_name",
        "Info.Segmento": F.nullif("c_mktsegment", F.lit("BUILDING"))}).alias("json"))


@query("json_root", """
SELECT o_custkey, to_json(struct_pack(Pedidos := list(o_orderkey ORDER BY o_orderkey))) AS json
FROM orders GROUP BY o_custkey
""")
def json_root(spark, sf):
    o = t(spark, sf, "orders")
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("_k"))
    return per.select("o_custkey", J.json_root("_k", "Pedidos").alias("json"))


@query("json_value", f"""
WITH {PH_SQL}
SELECT c_custkey,
  json_extract_string(phones, '$[0].type') || ': ' || json_extract_string(phones, '$[0].number') AS telefono,
  CASE WHEN json_type(phones, '$[0]') IN ('OBJECT', 'ARRAY') THEN NULL
       ELSE json_extract_string(phones, '$[0]') END AS objeto,
  json_extract_string(phones, '$[20].type') AS ausente
FROM ph
""")
def json_value(spark, sf):
    p = phones(spark, sf)
    return p.select("c_custkey",
                    F.concat(J.json_value("phones", "$[0].type"), F.lit(": "),
                             J.json_value("phones", "$[0].number")).alias("telefono"),
                    J.json_value("phones", "$[0]").alias("objeto"),
                    J.json_value("phones", "$[20].type").alias("ausente"))


@query("json_query", f"""
WITH {PH_SQL}
SELECT c_custkey, CAST(json_extract(phones, '$[0]') AS VARCHAR) AS telefono,
       CAST(NULL AS VARCHAR) AS escalar
FROM ph
""")
def json_query(spark, sf):
    p = phones(spark, sf)
    return p.select("c_custkey", J.json_query("phones", "$[0]").alias("telefono"),
                    J.json_query("phones", "$[0].type").alias("escalar"))


@query("json_path_exists", """
WITH d AS (
  SELECT c.c_custkey, (SELECT list(nullif(o.o_orderpriority, '1-URGENT')) FROM orders o
                       WHERE o.o_custkey = c.c_custkey) AS types
  FROM customer c)
SELECT c_custkey FROM d WHERE len(list_filter(types, lambda x: x IS NOT NULL)) > 0
""")
def json_path_exists(spark, sf):
    p = phones(spark, sf, type_col=F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return p.where(J.json_path_exists("phones", "$[*].type")).select("c_custkey")


# a document for each event: a repeated key, a stored null, a key with a space, a string that looks like JSON
@query("json_paths", """
SELECT event_id, event_type AS name, CAST(event_id AS VARCHAR) AS first, '{"k":1}' AS second, event_type AS deep, CAST(NULL AS VARCHAR) AS note,
  '{"k":null,"v":"' || event_type || '"}' AS fragment, true AS has_note, true AS has_null_element, false AS has_missing, true AS has_any_k,
  true AS has_null_k, false AS k_in_text, 1 AS is_json
FROM events
""")
def json_paths(spark, sf):
    doc = F.concat(F.lit('{"name":"'), "event_type", F.lit('","name":"again","note":null,"b c":{"list":['), F.col("event_id").cast("string"),
                   F.lit(',"{\\"k\\":1}",null,{"k":null,"v":"'), "event_type", F.lit('"},'), "props", F.lit("]}}"))
    d = t(spark, sf, "events").select("event_id", doc.alias("doc"))
    at = '$."b c".list'
    return d.select("event_id", J.json_value("doc", "$.name").alias("name"), J.json_value("doc", f"{at}[0]").alias("first"),
                    J.json_value("doc", f"{at}[1]").alias("second"), J.json_value("doc", f"lax {at}[3].v").alias("deep"),
                    J.json_value("doc", "$.note").alias("note"), J.json_query("doc", f"{at}[3]").alias("fragment"),
                    J.json_path_exists("doc", "$.note").alias("has_note"), J.json_path_exists("doc", f"{at}[2]").alias("has_null_element"),
                    J.json_path_exists("doc", f"{at}[9]").alias("has_missing"), J.json_path_exists("doc", f"{at}[*].k").alias("has_any_k"),
                    J.json_path_exists("doc", f"{at}[3].k").alias("has_null_k"), J.json_path_exists("doc", f"{at}[1].k").alias("k_in_text"),
                    J.is_json("doc").alias("is_json"))


@query("openjson_paths", """
SELECT o.o_orderkey, l.l_linenumber AS id, CAST(l.l_quantity AS INTEGER) AS cantidad, CAST(l.l_extendedprice AS DOUBLE) AS neto,
  '{"net":' || CAST(CAST(l.l_linenumber AS INTEGER) * 10 AS VARCHAR) || '}' AS importe
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def openjson_paths(spark, sf):
    # the lines lie in the document's member "Lineas", their prices one level deeper
    fields = {"Id": "l_linenumber", "Cant": F.col("l_quantity").cast("int"), "PVP.neto": "l_extendedprice", "Extra.net": F.col("l_linenumber").cast("int") * 10}
    docs = JO.sorted_children(t(spark, sf, "lineitem"), "l_orderkey", fields, ["l_linenumber"], "_arr").select(
        F.col("_key").alias("o_orderkey"), F.to_json(F.struct(F.lit("x").alias("Tipo"), F.col("_arr").alias("Lineas"))).alias("doc"))
    return JO.openjson_paths(docs, "doc", {"id": ("int", "$.Id"), "cantidad": ("int", "$.Cant"), "neto": ("double", "$.PVP.neto"),
                                           "importe": ("json", "$.Extra")}, path="$.Lineas", keep=["o_orderkey"])


@query("openjson_kv_path", """
SELECT c.c_custkey, v.key, v.value, v.type
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey,
LATERAL (VALUES ('City', n.n_name, 1), ('Key', CAST(n.n_nationkey AS VARCHAR), 2), ('Old', NULL, 0)) v(key, value, type)
""")
def openjson_kv_path(spark, sf):
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    docs = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.to_json(F.struct(F.array(F.struct(
        F.col("n_name").alias("City"), F.col("n_nationkey").alias("Key"), F.lit(None).cast("string").alias("Old"))).alias("Addresses")),
        {"ignoreNullFields": "false"}).alias("doc"))
    return JO.openjson_kv(docs, "doc", keep=["c_custkey"], path="$.Addresses[0]")


@query("isjson", r"""
SELECT event_id,
  CASE WHEN json_valid(props) AND json_type(props) IN ('OBJECT', 'ARRAY') THEN 1 ELSE 0 END AS is_json,
  CASE WHEN json_valid(props) AND json_type(props) = 'ARRAY' THEN 1 ELSE 0 END AS is_array,
  CASE WHEN json_valid(substr(props, 2)) AND json_type(substr(props, 2)) IN ('OBJECT', 'ARRAY') THEN 1 ELSE 0 END AS broken,
  CASE WHEN json_valid(regexp_extract(props, '[0-9]+')) AND json_type(regexp_extract(props, '[0-9]+')) IN ('OBJECT', 'ARRAY') THEN 1 ELSE 0 END AS bare_scalar,
  CASE WHEN json_valid('[' || props || ']') AND json_type('[' || props || ']') = 'ARRAY' THEN 1 ELSE 0 END AS wrapped_array
FROM events
""")
def isjson(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", J.is_json("props").alias("is_json"),
                    J.is_json("props", "ARRAY").alias("is_array"),
                    J.is_json(F.substring("props", 2, 2147483647)).alias("broken"),
                    J.is_json(F.regexp_extract("props", "[0-9]+", 0)).alias("bare_scalar"),
                    J.is_json(F.concat(F.lit("["), "props", F.lit("]")), "ARRAY").alias("wrapped_array"))


@query("json_object", """
SELECT p_partkey, to_json(struct_pack(numero := p_partkey, tipo := nullif(p_type, 'SMALL'))) AS telefono FROM part
""")
def json_object(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", J.json_object({"numero": "p_partkey",
                                                "tipo": F.nullif("p_type", F.lit("SMALL"))}
                                               ).alias("telefono"))


# --------------------------------------------------------------------------
# JS8, JS9: shred


@query("openjson_with", """
WITH docs AS (
  SELECT o.o_orderkey, to_json(list(struct_pack(Id := l.l_linenumber, Cant := CAST(l.l_quantity AS INTEGER),
                                               PVP := l.l_extendedprice))) AS doc
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey),
rows AS (SELECT o_orderkey, unnest(from_json(doc, '[{"Id":"INTEGER","Cant":"INTEGER","PVP":"DECIMAL(10,4)"}]')) AS e FROM docs)
SELECT o_orderkey, e.Id AS id, e.Cant AS cantidad, CAST(e.PVP AS DOUBLE) AS precio,
       CAST(e.Cant * e.PVP AS DOUBLE) AS total
FROM rows
""")
def openjson_with(spark, sf):
    li = t(spark, sf, "lineitem")
    # one document per order with lines; CROSS APPLY drops orders without
    # lines, so the documents come straight from the per-order aggregate
    fields = {"Id": "l_linenumber", "Cant": F.col("l_quantity").cast("int"), "PVP": "l_extendedprice"}
    docs = JO.sorted_children(li, "l_orderkey", fields, list(fields.values()), "_arr").select(
        F.col("_key").alias("o_orderkey"), F.to_json("_arr").alias("doc"))
    rows = JO.openjson(docs, "doc", "struct<Id:int,Cant:int,PVP:decimal(10,4)>", keep=["o_orderkey"])
    return rows.select("o_orderkey", F.col("Id").alias("id"), F.col("Cant").alias("cantidad"),
                       F.col("PVP").cast("double").alias("precio"),
                       (F.col("Cant") * F.col("PVP")).cast("double").alias("total"))


@query("openjson_count", f"""
WITH {PH_SQL}
SELECT c_custkey, CAST(greatest(coalesce(json_array_length(phones), 0), 1) AS BIGINT) AS n
FROM ph WHERE greatest(coalesce(json_array_length(phones), 0), 1) > 1
""")
def openjson_count(spark, sf):
    counted = JO.openjson_count(phones(spark, sf), "c_custkey", "phones", "$", "n")
    return counted.where(F.col("n") > 1)


# --------------------------------------------------------------------------
# JS10-JS15: edits


@query("json_set", _edit_sql(
    "CASE WHEN i = 0 THEN to_json(struct_pack(number := number, type := upper(type), ext := '0')) "
    f"ELSE {_PLAIN} END"))
def json_set(spark, sf):
    return _edited(spark, sf, ("$[0].type", F.upper(J.json_value("phones", "$[0].type"))), ("$[0].ext", F.lit("0")))


@query("json_delete", _edit_sql(
    f"CASE WHEN i = 0 THEN to_json(struct_pack(number := number)) ELSE {_PLAIN} END"))
def json_delete(spark, sf):
    return _edited(spark, sf, ("$[0].ext", F.lit("0")), ("$[0].ext", F.lit(None)), ("$[0].type", F.lit(None)))


@query("json_rename", _edit_sql(
    f"CASE WHEN i = 0 THEN to_json(struct_pack(number := number, tipo := type)) ELSE {_PLAIN} END"))
def json_rename(spark, sf):
    return _edited(spark, sf, ("$[0].tipo", J.json_value("phones", "$[0].type")), ("$[0].type", F.lit(None)))


@query("json_append", _edit_sql(
    _PLAIN, "',' || to_json(struct_pack(number := '666-555-0175', type := 'Cell'))"))
def json_append(spark, sf):
    return _edited(spark, sf, ("append $", J.json_object({"number": F.lit(NEW_PHONE), "type": F.lit("Cell")}), True))


@query("json_null_element", _edit_sql(f"CASE WHEN i = 1 THEN 'null' ELSE {_PLAIN} END"))
def json_null_element(spark, sf):
    return _edited(spark, sf, ("$[1]", F.lit(None)))


@query("json_raw_array", """
SELECT o_custkey AS c_custkey, to_json(list(CAST(o_orderkey AS VARCHAR)
                                            ORDER BY CAST(o_orderkey AS VARCHAR), o_orderpriority)) AS emails
FROM orders GROUP BY o_custkey
""")
def json_raw_array(spark, sf):
    p = phones(spark, sf).where(F.col("phones").isNotNull())
    return p.select("c_custkey",
                    F.to_json(J.json_raw_array(F.from_json("phones", PHONES), "number")).alias("emails"))


# --------------------------------------------------------------------------
# JS16-JS18: whole documents

DETAIL = ("struct<ContactType:string,Addresses:array<struct<Type:string,City:string>>,"
          "PhoneNumbers:array<struct<Type:string,Number:string>>,EmailAddresses:array<string>>")

DETAIL_SQL = """det AS (
  SELECT c.c_custkey,
    nullif(c.c_mktsegment, 'BUILDING') AS contact_type,
    [struct_pack(Type := r.r_name, City := n.n_name)] AS addresses,
    (SELECT list(struct_pack(Type := o.o_orderpriority, Number := CAST(o.o_orderkey AS VARCHAR))
                 ORDER BY CAST(o.o_orderkey AS VARCHAR), o.o_orderpriority)
     FROM orders o WHERE o.o_custkey = c.c_custkey) AS phones,
    [lower(replace(c.c_name, '#', '.')) || '@example.com'] AS emails
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def detail_documents(spark, sf):
    c, n, r, o = (t(spark, sf, x) for x in ("customer", "nation", "region", "orders"))
    base = (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("contact_type"),
                    F.array(F.struct(F.col("r_name").alias("Type"), F.col("n_name").alias("City"))
                            ).alias("addresses"),
                    F.array(F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))),
                                     F.lit("@example.com"))).alias("emails")))
    with_phones = JO.nest_children(
        base, o, "c_custkey", "o_custkey",
        {"Type": "o_orderpriority", "Number": F.col("o_orderkey").cast("string")}, "phones",
        order_by=[F.col("o_orderkey").cast("string"), F.col("o_orderpriority")], as_json=False)
    doc = DOC.build_document({"ContactType": F.col("contact_type"), "Addresses": F.col("addresses"),
                              "PhoneNumbers": F.col("phones"), "EmailAddresses": F.col("emails")})
    return with_phones.select("c_custkey", doc.alias("details"))


@query("detail_document", f"""
WITH {DETAIL_SQL}
SELECT c_custkey, to_json(struct_pack(ContactType := contact_type, Addresses := addresses,
                                      PhoneNumbers := phones, EmailAddresses := emails)) AS details
FROM det
""")
def detail_document(spark, sf):
    return detail_documents(spark, sf)


@query("document_edit", f"""
WITH {DETAIL_SQL}
SELECT c_custkey, to_json(struct_pack(
  ContactType := upper(contact_type), Addresses := addresses,
  PhoneNumbers := list_append(coalesce(phones, []), struct_pack(Type := 'Cell', Number := '666-555-0175')),
  EmailAddresses := emails)) AS details
FROM det
""")
def document_edit(spark, sf):
    new_phone = F.array(F.struct(F.lit("Cell").alias("Type"), F.lit(NEW_PHONE).alias("Number")))
    edited = DOC.edit_document(detail_documents(spark, sf), "details", DETAIL, {
        "ContactType": lambda d: F.upper(d["ContactType"]),
        "PhoneNumbers": lambda d: F.concat(F.coalesce(d["PhoneNumbers"], F.array().cast("array<struct<Type:string,Number:string>>")), new_phone)})
    return edited.select("c_custkey", "details")


# documents with members that the type above does not know, one of them inside an address
_EXTRA_SQL = """'{"ContactType":"' || c_mktsegment || '","Score":' || c_custkey || ',"Addresses":[{"Type":"home","City":"x","Geo":{"lat":' || c_nationkey ||
  '}}],"Tags":["a",null],"PhoneNumbers":'"""


@query("document_edit_unknown", f"""
SELECT c_custkey,
  {_EXTRA_SQL} || '[{{"Type":"Cell","Number":"' || c_phone || '"}}],"Note":null,"EmailAddresses":["' || c_custkey || '@example.com"]}}' AS details
FROM (SELECT c_custkey, c_nationkey, upper(c_mktsegment) AS c_mktsegment, coalesce(c_name, '') AS c_phone FROM customer)
""")
def document_edit_unknown(spark, sf):
    # the edited members change, everything else stays as it was stored
    doc = F.concat(F.lit('{"ContactType":"'), F.lower("c_mktsegment"), F.lit('","Score":'), F.col("c_custkey").cast("string"),
                   F.lit(',"Addresses":[{"Type":"home","City":"x","Geo":{"lat":'), F.col("c_nationkey").cast("string"),
                   F.lit('}}],"Tags":["a",null],"PhoneNumbers":[],"Note":null}'))
    docs = t(spark, sf, "customer").select("c_custkey", "c_name", doc.alias("details"))
    phone = F.array(F.struct(F.lit("Cell").alias("Type"), F.coalesce("c_name", F.lit("")).alias("Number")))
    return DOC.edit_document(docs, "details", DETAIL, {
        "ContactType": lambda d: F.upper(d["ContactType"]), "PhoneNumbers": lambda d: F.concat(d["PhoneNumbers"], phone),
        "EmailAddresses": lambda d: F.array(F.concat(F.col("c_custkey").cast("string"), F.lit("@example.com")))}).select("c_custkey", "details")


@query("document_rest", """
SELECT c_custkey, c_mktsegment AS contact_type, 1 AS n_addresses,
  '{"Score":' || c_custkey || ',"Tags":["a",null]}' AS rest,
  '{"ContactType":"' || c_mktsegment || '","Addresses":[{"Type":"home","City":"x"}],"PhoneNumbers":null,"EmailAddresses":null,"Score":' || c_custkey || ',"Tags":["a",null]}' AS written
FROM customer
""")
def document_rest(spark, sf):
    # unknown members of a stored document go to the rest and are written back
    doc = F.concat(F.lit('{"Score":'), F.col("c_custkey").cast("string"), F.lit(',"ContactType":"'), F.col("c_mktsegment"),
                   F.lit('","Tags":["a",null],"Addresses":[{"Type":"home","City":"x"}]}'))
    d = DOC.read_document(t(spark, sf, "customer").select("c_custkey", doc.alias("details")), "details", DETAIL)
    return d.select("c_custkey", F.col("doc.ContactType").alias("contact_type"), F.size("doc.Addresses").alias("n_addresses"), "rest",
                    DOC.write_document(F.col("doc"), F.col("rest"), ["ContactType", "Addresses", "PhoneNumbers", "EmailAddresses"]).alias("written"))


@query("json_column_filter", f"""
WITH {PH_SQL}
SELECT c_custkey, json_extract_string(phones, '$[0].number') AS phone
FROM ph WHERE json_extract_string(phones, '$[0].number') LIKE '1%'
""")
def json_column_filter(spark, sf):
    # the value is stored as a column of its own, the files clustered by it, and the filter runs on what was stored
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/js18-{uuid.uuid4().hex}"
    JO.store_json_columns(phones(spark, sf), "phones", {"phone": "$[0].number"}, path)
    return spark.read.parquet(path).where(F.col("phone").like("1%")).select("c_custkey", "phone")


@query("json_column_lookup", f"""
WITH {PH_SQL}
SELECT c_custkey, json_extract_string(phones, '$[0].number') AS phone, phones
FROM ph WHERE json_extract_string(phones, '$[0].number') = (SELECT max(json_extract_string(phones, '$[0].number')) FROM ph)
""")
def json_column_lookup(spark, sf):
    # equality on the stored value: Parquet statistics and a bloom filter leave few row groups
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/js18-{uuid.uuid4().hex}"
    JO.store_json_columns(phones(spark, sf), "phones", {"phone": "$[0].number"}, path)
    stored = spark.read.parquet(path)
    last = stored.agg(F.max("phone")).first()[0]  # one value
    return stored.where(F.col("phone") == F.lit(last)).select("c_custkey", "phone", "phones")


_KV_DOC_SQL = """kv AS (
  SELECT c.c_custkey, to_json(struct_pack(
      ContactType := nullif(c.c_mktsegment, 'BUILDING'), Nation := n.n_name,
      Balance := CAST(round(c.c_acctbal * 100) AS BIGINT), Vip := c.c_acctbal > 5000,
      Orders := (SELECT list(o.o_orderkey ORDER BY o.o_orderkey) FROM orders o WHERE o.o_custkey = c.c_custkey),
      Address := struct_pack(City := n.n_name, Region := r.r_name))) AS doc
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@query("openjson_kv", f"""
WITH {_KV_DOC_SQL}
SELECT c_custkey, key,
  CASE WHEN type = 'NULL' THEN NULL WHEN type = 'VARCHAR' THEN json_extract_string(value, '$')
       ELSE CAST(value AS VARCHAR) END AS value,
  CAST(CASE type WHEN 'NULL' THEN 0 WHEN 'VARCHAR' THEN 1 WHEN 'BOOLEAN' THEN 3 WHEN 'ARRAY' THEN 4
                 WHEN 'OBJECT' THEN 5 ELSE 2 END AS INTEGER) AS type
FROM kv, json_each(kv.doc)
""")
def openjson_kv(spark, sf):
    c, n, r, o = (t(spark, sf, x) for x in ("customer", "nation", "region", "orders"))
    base = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderkey")).alias("orders"))
    docs = base.join(per, base.c_custkey == per.o_custkey, "left").select(
        "c_custkey", F.to_json(F.struct(
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("ContactType"),
            F.col("n_name").alias("Nation"),
            F.round(F.col("c_acctbal") * 100).cast("long").alias("Balance"),
            (F.col("c_acctbal") > 5000).alias("Vip"), F.col("orders").alias("Orders"),
            F.struct(F.col("n_name").alias("City"), F.col("r_name").alias("Region")).alias("Address")),
            {"ignoreNullFields": "false"}).alias("doc"))
    return JO.openjson_kv(docs, "doc", keep=["c_custkey"])


@query("product_specs", """
WITH specs AS (
  SELECT p_partkey, p_name, p_retailprice,
         to_json(struct_pack(name := p_brand,
                             description := [struct_pack(cultureId := 'en', text := p_name)])) AS SpecsJson
  FROM part)
SELECT p_partkey, SpecsJson, json_extract_string(SpecsJson, '$.name') AS ProductModel,
       CASE WHEN json_valid(SpecsJson) AND json_type(SpecsJson) IN ('OBJECT', 'ARRAY') THEN 1 ELSE 0 END AS valid
FROM specs WHERE json_extract_string(SpecsJson, '$.name') IS NOT NULL
""")
def product_specs(spark, sf):
    # fixed value: the member name cultureId, as the reference's spec documents have it;
    # the spec document is built as a one-row FOR JSON array and unwrapped,
    # ProductModel is the persisted computed column read from it
    p = t(spark, sf, "part")
    one = F.array(F.struct(F.col("p_brand").alias("name"),
                           F.array(F.struct(F.lit("en").alias("cultureId"),
                                            F.col("p_name").alias("text"))).alias("description")))
    specs = p.select("p_partkey", J.json_unwrap(one).alias("SpecsJson"))
    m = JO.materialise_json(specs, "SpecsJson", {"ProductModel": "$.name"})
    return m.where(F.col("ProductModel").isNotNull()).select(
        "p_partkey", "SpecsJson", "ProductModel", J.is_json("SpecsJson").alias("valid"))


@query("include_two", """
SELECT n.n_nationkey,
       (SELECT COUNT(*) FROM customer c WHERE c.c_nationkey = n.n_nationkey) AS n_customers,
       (SELECT COUNT(*) FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE c.c_nationkey = n.n_nationkey) AS n_orders,
       (SELECT COUNT(*) FROM supplier s WHERE s.s_nationkey = n.n_nationkey) AS n_suppliers,
       (SELECT to_json(list(s.s_suppkey ORDER BY s.s_suppkey)) FROM supplier s
        WHERE s.s_nationkey = n.n_nationkey) AS supplier_keys
FROM nation n
""")
def include_two(spark, sf):
    # C11 with two collections (customers, one level deeper with their
    # orders, and suppliers): each collection is aggregated on its own and
    # joined once - the split-query form, no customers x suppliers rows
    n, c, s, o = (t(spark, sf, x) for x in ("nation", "customer", "supplier", "orders"))
    customers = JO.include(c.select("c_custkey", "c_nationkey"), "c_custkey", [
        (o, "o_custkey", {"o_orderkey": "o_orderkey"}, "orders", ["o_orderkey"])])
    tree = JO.include(n.select("n_nationkey"), "n_nationkey", [
        (customers, "c_nationkey", {"c_custkey": "c_custkey", "orders": "orders"}, "customers", ["c_custkey"]),
        (s, "s_nationkey", {"s_suppkey": "s_suppkey"}, "suppliers", ["s_suppkey"])])
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    n_orders = F.coalesce(F.aggregate("customers", F.lit(0).cast("long"),
                                      lambda acc, x: acc + F.coalesce(F.size(x["orders"]), F.lit(0))),
                          F.lit(0)).cast("long")
    return tree.select("n_nationkey", size("customers").alias("n_customers"), n_orders.alias("n_orders"),
                       size("suppliers").alias("n_suppliers"),
                       F.to_json(F.transform("suppliers", lambda x: x["s_suppkey"])).alias("supplier_keys"))


@query("json_modify_path", """
SELECT event_id,
       '{"name":"' || event_type || '","note":null,"qty":1.50,"item":' || replace(props, ' ', '') || ',"ContactType":"' || event_type || '-x"}' AS added,
       '{"name":"' || event_type || '","note":null,"item":' || replace(props, ' ', '') || '}' AS removed,
       '{"name":"' || event_type || '","note":null,"qty":1.50,"item":' || left(replace(props, ' ', ''), length(replace(props, ' ', '')) - 1) || ',"list":["' || event_type || '"]}}' AS appended
FROM events
""")
def json_modify_path(spark, sf):
    # edits by path keep members nobody named, stored nulls and the text of numbers
    doc = F.concat(F.lit('{"name":"'), "event_type", F.lit('","note":null,"qty":1.50,"item":'), F.replace("props", F.lit(" "), F.lit("")), F.lit("}"))
    e = t(spark, sf, "events").select("event_id", "event_type", doc.alias("doc"))
    return e.select("event_id", json_modify(F.col("doc"), "$.ContactType", F.concat("event_type", F.lit("-x"))).alias("added"),
                    json_modify(F.col("doc"), "$.qty", F.lit(None)).alias("removed"),
                    json_modify(F.col("doc"), "append $.item.list", F.col("event_type")).alias("appended"))
