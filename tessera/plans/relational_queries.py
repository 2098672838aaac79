"""Queries for sources (A), projection and filter (B), joins (C), paging (F)
and parameterised SQL (U3) over the driver tables.

Stand-ins: SalesOrderHeader -> orders, SalesOrderDetail -> lineitem,
Product -> part, Person -> customer. NULLs are made with ``nullif`` on both
sides because the driver tables hold none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators import relational as R
from tessera.operators.ordering import global_row_number
from tessera.plans.registry import query
from tessera.session import ensure_checkpoint_dir
from tessera.sources import tables as S


def t(spark, sf, name):
    return S.table(spark, sf, name)


def money(col) -> F.Column:
    """Exact money sum rendered as double (same digits in every engine)."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


# --------------------------------------------------------------------------
# A. sources and sinks


@query("customer_view", """
SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def customer_view(spark, sf):
    c, n, r = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name", "r_name"))


@query("series", """
SELECT CAST(unnest(generate_series(min(day(l_shipdate)), max(day(l_shipdate)))) AS INTEGER) AS value
FROM lineitem
""")
def series_q(spark, sf):
    # series bounds come from the data: the days of the month that occur
    lo, hi = t(spark, sf, "lineitem").agg(F.min(F.dayofmonth("l_shipdate")),
                                          F.max(F.dayofmonth("l_shipdate"))).first()
    return S.series(spark, lo, hi)


@query("split_ordinal", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS value,
       CAST(generate_subscripts(string_split(p_name, ' '), 1) AS INTEGER) AS ordinal
FROM part
""")
def split_ordinal_q(spark, sf):
    return S.split_ordinal(t(spark, sf, "part"), "p_name", " ", keep=["p_partkey"])


@query("json_page", """
SELECT to_json(list(struct_pack(id := c_custkey, nombre := c_name) ORDER BY c_name, c_custkey)) AS json
FROM (SELECT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey LIMIT 5 OFFSET 10)
""")
def json_page_q(spark, sf):
    return S.json_page(t(spark, sf, "customer"), {"id": "c_custkey", "nombre": "c_name"},
                       ["c_name", "c_custkey"], page=2, rows=5)


# --------------------------------------------------------------------------
# B. projection, filter, predicates


@query("project_concat", """
SELECT c_custkey AS id, c_name || ' ' || c_mktsegment AS nombre FROM customer
""")
def project_concat(spark, sf):
    return t(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), R.full_name("c_name", "c_mktsegment").alias("nombre"))


@query("filter_and", """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_acctbal > 5000 AND length(c_mktsegment || c_name) > 26
""")
def filter_and(spark, sf):
    c = t(spark, sf, "customer")
    return c.where((F.col("c_acctbal") > 5000)
                   & (F.length(F.concat("c_mktsegment", "c_name")) > 26)
                   ).select("c_custkey", "c_name", "c_acctbal")


@query("distinct_from", """
SELECT p_partkey, nullif(p_type, 'SMALL') AS color FROM part
WHERE nullif(p_type, 'SMALL') IS DISTINCT FROM 'ECONOMY'
""")
def distinct_from_q(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("color"))
    return p.where(R.distinct_from("color", "ECONOMY"))


@query("not_equal_nulls", """
SELECT p_partkey, nullif(p_type, 'SMALL') AS color FROM part
WHERE nullif(p_type, 'SMALL') <> 'ECONOMY'
""")
def not_equal_nulls(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("color"))
    return p.where(F.col("color") != "ECONOMY")


@query("distinct_colors", """
SELECT DISTINCT nullif(p_type, 'SMALL') AS color FROM part
WHERE nullif(p_type, 'SMALL') IS DISTINCT FROM 'ECONOMY'
""")
def distinct_colors(spark, sf):
    return distinct_from_q(spark, sf).select("color").distinct()


@query("in_list", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def in_list(spark, sf):
    return t(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                                        ).select("o_orderkey", "o_orderpriority")


@query("like_int", """
SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
WHERE CAST(l_partkey AS VARCHAR) LIKE '71%'
""")
def like_int(spark, sf):
    return t(spark, sf, "lineitem").where(F.col("l_partkey").cast("string").like("71%")
                                          ).select("l_orderkey", "l_partkey", "l_linenumber")


@query("null_tests", """
SELECT p_partkey, nullif(p_type, 'SMALL') IS NULL AS type_missing,
       nullif(p_type, 'SMALL') IS NOT NULL AS type_present
FROM part
""")
def null_tests(spark, sf):
    c = F.nullif("p_type", F.lit("SMALL"))
    return t(spark, sf, "part").select("p_partkey", c.isNull().alias("type_missing"),
                                       c.isNotNull().alias("type_present"))


# Fixed value: the reference's e-mail pattern without its anchors (finds an address in text).
EMAIL_FIND = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query("regexp_like", r"""
SELECT doc_id, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') AS has_email
FROM documents
""")
def regexp_like_q(spark, sf):
    d = t(spark, sf, "documents")
    return d.select("doc_id", F.regexp_like("text", F.lit(EMAIL_FIND)).alias("has_email"))


@query("dynamic_query", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
WHERE o_totalprice > 200000 AND o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def dynamic_query_q(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return R.dynamic_query(o, F.col("o_totalprice") > 200000, F.col("o_orderstatus") == "F",
                           [F.col("o_totalprice").desc(), F.col("o_orderkey")], take=5)


@query("key_lookup", """
SELECT o.o_orderkey, c.c_name, c.c_custkey IS NOT NULL AS found
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def key_lookup(spark, sf):
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .select("o_orderkey", "c_name", F.col("c_custkey").isNotNull().alias("found")))


def _keyed_orders(spark, sf):
    """The orders stored for lookups by key, read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/b11-{uuid.uuid4().hex}"
    R.store_keyed(t(spark, sf, "orders"), path, "o_orderkey")
    return spark.read.parquet(path)


@query("point_lookup", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN ((SELECT min(o_orderkey) FROM orders), (SELECT max(o_orderkey) FROM orders))
""")
def point_lookup(spark, sf):
    o = _keyed_orders(spark, sf)
    ends = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()  # two values
    return R.lookup(o, "o_orderkey", *ends, None).select("o_orderkey", "o_custkey", "o_totalprice")


@query("key_exists", """
SELECT CAST(max(o_orderkey) AS DOUBLE) AS o_orderkey, true AS found FROM orders UNION ALL SELECT max(o_orderkey) + 1, false FROM orders
UNION ALL SELECT min(o_orderkey), true FROM orders UNION ALL SELECT NULL, false
""")
def key_exists(spark, sf):
    o = _keyed_orders(spark, sf)
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return R.exists(o, "o_orderkey", hi, hi + 1, lo, None).withColumn("o_orderkey", F.col("o_orderkey").cast("double"))


@query("conditional", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS size_class,
       coalesce(nullif(p_type, 'SMALL'), 'none') AS type_or_none
FROM part
""")
def conditional(spark, sf):
    return t(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, "big").otherwise("small").alias("size_class"),
        F.coalesce(F.nullif("p_type", F.lit("SMALL")), F.lit("none")).alias("type_or_none"))


@query("casts", """
SELECT o_orderkey,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day,
       CAST(TRY_CAST(o_orderpriority AS INTEGER) AS DOUBLE) AS bad_number,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_number
FROM orders
""")
def casts(spark, sf):
    return t(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price_text"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
        F.col("o_orderpriority").try_cast("int").cast("double").alias("bad_number"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority_number"))


@query("account_number", """
SELECT c_custkey, 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS account_number FROM customer
""")
def account_number_q(spark, sf):
    return t(spark, sf, "customer").select(
        "c_custkey", R.account_number("c_custkey").alias("account_number"))


@query("distinct", """
SELECT DISTINCT c_mktsegment, c_nationkey FROM customer
""")
def distinct_q(spark, sf):
    return t(spark, sf, "customer").select("c_mktsegment", "c_nationkey").distinct()


@query("cte_quarters", """
WITH sales AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, CAST(quarter(l_shipdate) AS INTEGER) AS ship_quarter,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
  FROM lineitem GROUP BY ALL),
years AS (SELECT ship_year, MAX(revenue) AS best FROM sales GROUP BY ship_year)
SELECT ship_year, ship_quarter, CAST(revenue AS DOUBLE) AS revenue, CAST(best AS DOUBLE) AS best_of_year
FROM sales JOIN years USING (ship_year)
""")
def cte_quarters(spark, sf):
    """A named subquery used twice: each quarter's revenue beside the best quarter of its year."""
    sales = t(spark, sf, "lineitem").groupBy(
        F.year("l_shipdate").alias("ship_year"), F.quarter("l_shipdate").alias("ship_quarter")
    ).agg(money("l_extendedprice").alias("revenue"))
    years = sales.groupBy("ship_year").agg(F.max("revenue").alias("best_of_year"))
    return sales.join(years, "ship_year")


# --------------------------------------------------------------------------
# C. joins


@query("inner_join", """
SELECT l.l_orderkey, l.l_linenumber, p.p_name, p.p_brand
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""")
def inner_join(spark, sf):
    li, p = t(spark, sf, "lineitem"), t(spark, sf, "part")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber", "p_name", "p_brand")


@query("left_join", """
SELECT c.c_custkey, o.o_orderkey, n.n_name
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def left_join(spark, sf):
    c, o, n = t(spark, sf, "customer"), t(spark, sf, "orders"), t(spark, sf, "nation")
    co = R.left_join_many(c.select("c_custkey", "c_nationkey"), o.select("o_orderkey", "o_custkey"),
                          "c_custkey", "o_custkey")
    return co.join(n, co.c_nationkey == n.n_nationkey, "left").select("c_custkey", "o_orderkey", "n_name")


@query("star_join", """
SELECT n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS anio,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       COUNT(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate)
ORDER BY n.n_name, anio
""")
def star_join(spark, sf):
    li, o = t(spark, sf, "lineitem"), t(spark, sf, "orders")
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey))
    return (j.groupBy("n_name", F.year("o_orderdate").alias("anio"))
            .agg(money("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))
            .orderBy("n_name", "anio"))


@query("nested_in", """
SELECT DISTINCT c.c_name, n.n_name
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
WHERE c.c_custkey IN (
  SELECT o_custkey FROM orders WHERE o_orderkey IN (
    SELECT l_orderkey FROM lineitem WHERE l_partkey IN (
      SELECT p_partkey FROM part WHERE p_brand = 'Brand#1')))
""")
def nested_in(spark, sf):
    c, n = t(spark, sf, "customer"), t(spark, sf, "nation")
    o, li, p = t(spark, sf, "orders"), t(spark, sf, "lineitem"), t(spark, sf, "part")
    parts = p.where(F.col("p_brand") == "Brand#1")
    lines = R.semi_in(li, "l_partkey", parts, "p_partkey")
    ords = R.semi_in(o, "o_orderkey", lines, "l_orderkey")
    cust = R.semi_in(c, "c_custkey", ords, "o_custkey")
    return cust.join(n, n.n_nationkey == cust.c_nationkey).select("c_name", "n_name").distinct()


@query("scalar_subquery", """
SELECT c.c_custkey,
       (SELECT MAX(o.o_totalprice) FROM orders o WHERE o.o_custkey = c.c_custkey) AS max_order
FROM customer c
""")
def scalar_subquery(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    mx = o.groupBy("o_custkey").agg(F.max("o_totalprice").alias("max_order"))
    return c.join(mx, c.c_custkey == mx.o_custkey, "left").select("c_custkey", "max_order")


@query("cross_apply", """
SELECT p_partkey, t.w FROM part CROSS JOIN unnest(string_split(nullif(p_type, 'SMALL'), ' ')) AS t(w)
""")
def cross_apply(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.explode(F.split(F.nullif("p_type", F.lit("SMALL")), " ")).alias("w"))


@query("outer_apply", """
SELECT p_partkey, t.w FROM part
LEFT JOIN LATERAL (SELECT unnest(string_split(nullif(p_type, 'SMALL'), ' ')) AS w) t ON true
""")
def outer_apply(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey",
                    F.explode_outer(F.split(F.nullif("p_type", F.lit("SMALL")), " ")).alias("w"))


@query("join_list", """
SELECT p.p_partkey, p.p_name, p.p_brand, s.value, CAST(s.ordinal AS INTEGER) AS ordinal
FROM part p JOIN (
  SELECT unnest(string_split('Brand#1,Brand#2,Brand#3', ',')) AS value,
         generate_subscripts(string_split('Brand#1,Brand#2,Brand#3', ','), 1) AS ordinal) s
ON p.p_brand = s.value
""")
def join_list_q(spark, sf):
    return R.join_list(t(spark, sf, "part").select("p_partkey", "p_name", "p_brand"),
                       "p_brand", "Brand#1,Brand#2,Brand#3")


@query("gap_fill", """
WITH shipped AS (
  SELECT CAST(l_shipdate AS DATE) AS on_day, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
  FROM lineitem WHERE l_shipdate >= DATE '1996-02-01' AND l_shipdate < DATE '1996-03-01' GROUP BY ALL)
SELECT CAST(n AS INTEGER) AS value, CAST(n_lines AS DOUBLE) AS n_lines, revenue
FROM range(1, 32) AS days(n) LEFT JOIN shipped ON day(on_day) = n
""")
def gap_fill_q(spark, sf):
    """Every day number 1 to 31 with what was shipped on it in one month; days without lines keep NULL."""
    when = F.col("l_shipdate").cast("date")
    month = t(spark, sf, "lineitem").where((F.col("l_shipdate") >= F.lit("1996-02-01").cast("date"))
                                           & (F.col("l_shipdate") < F.lit("1996-03-01").cast("date")))
    shipped = month.groupBy(F.dayofmonth(when).alias("day_no")).agg(
        F.count("*").cast("double").alias("n_lines"), money("l_extendedprice").alias("revenue"))
    return R.gap_fill(S.series(spark, 1, 31), shipped, "day_no").select("value", "n_lines", "revenue")


@query("child_count", """
SELECT c.c_custkey, COUNT(o.o_orderkey) AS n_children
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey
""")
def child_count_q(spark, sf):
    return R.child_count(t(spark, sf, "customer"), t(spark, sf, "orders"),
                         "c_custkey", "o_custkey").select("c_custkey", "n_children")


@query("children_of", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
""")
def children_of_q(spark, sf):
    c = t(spark, sf, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    return R.children_of(c, t(spark, sf, "orders"), "c_custkey", "o_custkey").select(
        "o_orderkey", "o_custkey")


# --------------------------------------------------------------------------
# F. sort, limit, paging


@query("order_nulls", """
SELECT p_partkey, nullif(p_type, 'SMALL') AS color,
       row_number() OVER (ORDER BY nullif(p_type, 'SMALL') ASC NULLS FIRST, p_partkey) AS row_number
FROM part
""")
def order_nulls(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.nullif("p_type", F.lit("SMALL")).alias("color"))
    return global_row_number(p, [F.col("color").asc_nulls_first(), F.col("p_partkey")]).select(
        "p_partkey", "color", "row_number")


@query("top_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def top_n(spark, sf):
    return (t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10))


@query("page", """
SELECT c_custkey AS id, c_name || ' ' || c_mktsegment AS nombre FROM customer
ORDER BY nombre, id LIMIT 5 OFFSET 10
""")
def page_q(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"),
                                        R.full_name("c_name", "c_mktsegment").alias("nombre"))
    return R.page(c, ["nombre", "id"], page_no=2, rows=5)


@query("page_numbers", """
SELECT c_custkey AS id, row_number() OVER (ORDER BY c_name, c_custkey) AS row_number,
       (row_number() OVER (ORDER BY c_name, c_custkey) - 1) // 5 AS page
FROM customer
""")
def page_numbers_q(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return R.page_numbers(c, ["c_name", "id"], 5).select("id", "row_number", "page")


# --------------------------------------------------------------------------
# U3. parameterised SQL


@query("sql_params", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'
""")
def sql_params(spark, sf):
    from tessera.sources.tables import register_tables

    register_tables(spark, sf, ["orders"])
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > :p AND o_orderstatus = :s",
        args={"p": 300000, "s": "O"})


@query("take_then_filter", """
SELECT o_orderkey, o_orderstatus
FROM (SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50) WHERE o_orderstatus = 'F'
""")
def take_then_filter_q(spark, sf):
    # Take before Where: the 50 dearest orders, of which those that are finished
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    picked = R.take_then_filter(o, 50, F.col("o_orderstatus") == "F", ["o_orderkey"], take_order=[F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return picked.select("o_orderkey", "o_orderstatus")


# --------------------------------------------------------------------------
# Functions defined in SQL


@query("sql_function", """
SELECT c_custkey, 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS account FROM customer
""")
def sql_function(spark, sf):
    from tessera.sources.tables import register_tables

    register_tables(spark, sf, ["customer"])
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tessera_account(id BIGINT) RETURNS STRING "
              "RETURN concat('AW', lpad(CAST(id AS STRING), 8, '0'))")
    return spark.sql("SELECT c_custkey, tessera_account(c_custkey) AS account FROM customer")


@query("sql_table_function", """
SELECT event_id, user_id, event_type FROM events
WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00')
""")
def sql_table_function(spark, sf):
    from tessera.plans.fixtures import since_version_value
    from tessera.sources.tables import register_tables

    register_tables(spark, sf, ["events"])
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION tessera_changes_after(v BIGINT) "
              "RETURNS TABLE (event_id BIGINT, user_id BIGINT, event_type STRING) "
              "RETURN SELECT event_id, user_id, event_type FROM events WHERE event_id > v")
    return spark.sql("SELECT * FROM tessera_changes_after(:v)", args={"v": since_version_value(spark, sf)})
