"""Queries for text and regular-expression columns (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as H
from tessera.plans.registry import query
from tessera.plans.relational_queries import money, t


@query("concat_ws", """
SELECT c_custkey, concat_ws(', ', c_name, nullif(c_mktsegment, 'BUILDING'), CAST(c_nationkey AS VARCHAR)) AS direccion
FROM customer
""")
def concat_ws(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.concat_ws(", ", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")),
                                             F.col("c_nationkey").cast("string")).alias("direccion"))


@query("translate", """
SELECT doc_id, md5(translate(text, 'áéíóúüñ', 'aeiouun')) AS sin_tildes_md5,
       translate(lang || '()-' || source, '()-', '   ') AS limpio
FROM documents WHERE regexp_matches(text, '[áéíóúüñ]')
""")
def translate(spark, sf):
    d = t(spark, sf, "documents").where(F.regexp_like("text", F.lit("[áéíóúüñ]")))
    return d.select("doc_id", F.md5(H.fold_accents("text")).alias("sin_tildes_md5"),
                    H.translate_strict(F.concat("lang", F.lit("()-"), "source"), "()-", "   "
                                       ).alias("limpio"))


@query("trims", """
SELECT o_orderkey,
  trim(' ' || o_orderpriority || ' ') AS plain,
  trim('00' || CAST(o_orderkey AS VARCHAR) || '00', '0') AS both_zero,
  ltrim('00' || CAST(o_orderkey AS VARCHAR) || '00', '0') AS leading_zero,
  rtrim('00' || CAST(o_orderkey AS VARCHAR) || '00', '0') AS trailing_zero
FROM orders
""")
def trims(spark, sf):
    o = t(spark, sf, "orders")
    padded = F.concat(F.lit("00"), F.col("o_orderkey").cast("string"), F.lit("00"))
    return o.select("o_orderkey", F.trim(F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))).alias("plain"),
                    F.trim(padded, F.lit("0")).alias("both_zero"),
                    F.ltrim(padded, F.lit("0")).alias("leading_zero"),
                    F.rtrim(padded, F.lit("0")).alias("trailing_zero"))


@query("capitalise", """
SELECT p_partkey, upper(p_name) AS mayus, lower(p_brand) AS minus,
       upper(substring(p_name, 1, 1)) || lower(substring(p_name, 2)) AS capital
FROM part
""")
def capitalise(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.upper("p_name").alias("mayus"), F.lower("p_brand").alias("minus"),
                    H.capitalise("p_name").alias("capital"))


@query("substring_len", """
SELECT p_partkey, substring(p_name, 3) AS desde_3, substring(p_name, 1, 4) AS primeros_4,
       CAST(length(rtrim(p_name || '   ')) AS INTEGER) AS len,
       substring(p_name, CAST(CASE WHEN regexp_matches(p_name, ' ') THEN strpos(p_name, ' ') ELSE 0 END AS INTEGER) + 1,
                 length(rtrim(p_name))) AS tras_espacio
FROM part WHERE p_name LIKE '% %'
""")
def substring_len(spark, sf):
    p = t(spark, sf, "part").where(F.col("p_name").like("% %"))
    return p.select("p_partkey", F.substring("p_name", 3, 2147483647).alias("desde_3"),
                    F.substring("p_name", 1, 4).alias("primeros_4"),
                    H.len_rtrim(F.concat("p_name", F.lit("   "))).alias("len"),
                    H.after_first("p_name", " ").alias("tras_espacio"))


@query("replace_format", """
SELECT c_custkey, replace(c_name, 'Customer#', 'C-') AS corto, printf('{"%s":', c_mktsegment) AS prefijo
FROM customer
""")
def replace_format(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("C-")).alias("corto"),
                    F.format_string('{"%s":', "c_mktsegment").alias("prefijo"))


@query("money_es", """
SELECT n_name,
  translate(format('{:,.2f}', CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE)), ',.', '.,') || ' €' AS saldo
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def money_es_q(spark, sf):
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    return (c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name")
            .agg(H.money_es(money("c_acctbal")).alias("saldo")))


# Fixed value: the reference's mail-domain pattern.
DOMAIN = r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("regexp_substr", r"""
SELECT doc_id, nullif(regexp_extract(text, '@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), '') AS dominio FROM documents
""")
def regexp_substr(spark, sf):
    return t(spark, sf, "documents").select("doc_id", H.regexp_substr("text", DOMAIN).alias("dominio"))


@query("regexp_replace", r"""
SELECT c_custkey, regexp_replace(c_name, '\D', '', 'g') AS solo_numeros FROM customer
""")
def regexp_replace(spark, sf):
    return t(spark, sf, "customer").select(
        "c_custkey", F.regexp_replace("c_name", r"\D", "").alias("solo_numeros"))


@query("regexp_instr", r"""
SELECT s_suppkey, CAST(CASE WHEN regexp_matches(s_name, '\d+')
                       THEN strpos(s_name, regexp_extract(s_name, '\d+')) ELSE 0 END AS INTEGER) AS posicion
FROM supplier
""")
def regexp_instr(spark, sf):
    return t(spark, sf, "supplier").select("s_suppkey", H.regexp_instr("s_name", r"\d+").alias("posicion"))


@query("regexp_count", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '\w+')) AS INTEGER) AS palabras FROM documents
""")
def regexp_count(spark, sf):
    return t(spark, sf, "documents").select("doc_id", H.regexp_count("text", r"\w+").alias("palabras"))


_MATCH = "([0-9])([0-9]{2})"


@query("regexp_matches", """
WITH m AS (
  SELECT c_custkey, c_name,
         regexp_extract_all(c_name, '([0-9])([0-9]{2})') AS ms,
         string_split_regex(c_name, '([0-9])([0-9]{2})') AS ps
  FROM customer),
e AS (SELECT c_custkey, c_name, ms, ps, unnest(generate_series(1, len(ms))) AS k FROM m)
SELECT c_custkey, c_name, CAST(k AS INTEGER) AS match_id,
  CAST(1 + list_sum(list_transform(ps[1:k], lambda x: length(x)))
         + coalesce(list_sum(list_transform(ms[1:k-1], lambda x: length(x))), 0) AS INTEGER) AS start_position,
  ms[k] AS match_value,
  CAST(1 + list_sum(list_transform(ps[1:k], lambda x: length(x)))
         + coalesce(list_sum(list_transform(ms[1:k-1], lambda x: length(x))), 0) + length(ms[k]) - 1 AS INTEGER) AS end_position,
  regexp_extract(ms[k], '([0-9])([0-9]{2})', 1) AS group_1,
  regexp_extract(ms[k], '([0-9])([0-9]{2})', 2) AS group_2
FROM e
""")
def regexp_matches(spark, sf):
    return H.regexp_matches(t(spark, sf, "customer"), "c_name", _MATCH, 2, keep=["c_custkey"])


@query("regexp_split", """
SELECT page_id, url, unnest(string_split_regex(url, '[;,-.]+')) AS value,
       CAST(generate_subscripts(string_split_regex(url, '[;,-.]+'), 1) AS INTEGER) AS ordinal
FROM pages
""")
def regexp_split(spark, sf):
    return H.regexp_split(t(spark, sf, "pages"), "url", "[;,-.]+", keep=["page_id"])


@query("dateparts", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS anio,
  CAST(quarter(l_shipdate) AS INTEGER) AS trimestre, CAST(month(l_shipdate) AS INTEGER) AS mes,
  CAST(day(l_shipdate) AS INTEGER) AS dia
FROM lineitem
""")
def dateparts(spark, sf):
    li = t(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("anio"),
                     F.quarter("l_shipdate").alias("trimestre"), F.month("l_shipdate").alias("mes"),
                     F.dayofmonth("l_shipdate").alias("dia"))


@query("datetrunc", """
SELECT o_orderkey, date_trunc('month', o_orderdate) AS mes, date_trunc('day', o_orderdate) AS dia FROM orders
""")
def datetrunc(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey",
                    F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("mes"),
                    F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("dia"))


@query("least_greatest", """
SELECT o.o_orderkey, least(o.o_orderdate, l.first_ship, l.last_ship) AS first_event,
       greatest(o.o_orderdate, l.first_ship, l.last_ship) AS last_event
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                         FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
""")
def least_greatest(spark, sf):
    o, li = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    ships = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"),
                                         F.max("l_shipdate").alias("last_ship"))
    j = o.join(ships, o.o_orderkey == ships.l_orderkey, "left")
    return j.select("o_orderkey",
                    F.least("o_orderdate", "first_ship", "last_ship").alias("first_event"),
                    F.greatest("o_orderdate", "first_ship", "last_ship").alias("last_event"))
