"""Queries for aggregation and reshaping (D) and windows (E)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.text import money_es
from tessera.operators import reshape as D
from tessera.operators.ordering import running_total
from tessera.plans.registry import query
from tessera.session import ensure_checkpoint_dir
from tessera.plans.relational_queries import money, t

# year / quarter / month of the ship date, the reference's grouping keys
_YQM_SQL = ("CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(quarter(l_shipdate) AS INTEGER) AS trimestre, "
            "CAST(month(l_shipdate) AS INTEGER) AS mes")
# Rolled-up levels make the keys NULL; nullable integers are rendered as
# DOUBLE on both sides so every result conversion sees the same type.
_YQM_NULLABLE_SQL = ("CAST(year(l_shipdate) AS DOUBLE) AS anio, CAST(quarter(l_shipdate) AS DOUBLE) AS trimestre, "
                     "CAST(month(l_shipdate) AS DOUBLE) AS mes")


def _double_keys(df):
    return df.select(*[F.col(c).cast("double").alias(c) if c in ("anio", "trimestre", "mes") else F.col(c)
                       for c in df.columns])
_MONEY_SQL = "CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)"
_ES_SQL = "translate(format('{:,.2f}', " + _MONEY_SQL + "), ',.', '.,') || ' €'"


def _yqm():
    return [F.year("l_shipdate").alias("anio"), F.quarter("l_shipdate").alias("trimestre"),
            F.month("l_shipdate").alias("mes")]


def _report_aggs():
    return [F.count(F.lit(1)).alias("pedidos"), money("l_extendedprice").alias("total"),
            money_es(money("l_extendedprice")).alias("total_es")]


def _month_base(spark, sf):
    """One row a month: what rollup, cube and grouping sets add up again, so
    that the table's rows are not expanded once for each set."""
    return t(spark, sf, "lineitem").groupBy(*_yqm()).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_s"))


def _base_aggs():
    total = F.sum("_s").cast("double")
    return [F.sum("_n").alias("pedidos"), total.alias("total"), money_es(total).alias("total_es")]


@query("group_quarter", f"""
SELECT {_YQM_SQL}, {_MONEY_SQL} AS total FROM lineitem GROUP BY 1, 2, 3
""")
def group_quarter(spark, sf):
    return t(spark, sf, "lineitem").groupBy(*_yqm()).agg(money("l_extendedprice").alias("total"))


@query("month_sales", """
SELECT date_trunc('month', o_orderdate) AS month,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS ventas
FROM orders GROUP BY 1 ORDER BY 1
""")
def month_sales(spark, sf):
    o = t(spark, sf, "orders")
    return (o.groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"))
            .agg(money("o_totalprice").alias("ventas")).orderBy("month"))


@query("count_rows", "SELECT COUNT(1) AS n FROM orders")
def count_rows(spark, sf):
    return t(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n"))


@query("count_distinct", "SELECT COUNT(DISTINCT o_custkey) AS n FROM orders")
def count_distinct(spark, sf):
    return t(spark, sf, "orders").agg(F.count_distinct("o_custkey").alias("n"))


@query("approx_distinct", """
SELECT true AS within_bound, count(o_custkey) AS n_rows FROM orders
""")
def approx_distinct(spark, sf):
    # the estimate, against the exact count: 4 standard errors of 5 % each
    o = t(spark, sf, "orders")
    both = D.approx_distinct(o, "o_custkey", 0.05, "n").join(o.agg(F.count_distinct("o_custkey").alias("exact"), F.count("o_custkey").alias("n_rows")))
    return both.select((F.abs(F.col("n") - F.col("exact")) <= 0.2 * F.col("exact")).alias("within_bound"), "n_rows")


@query("distinct_sketches", """
SELECT o_orderstatus, true AS within_bound, true AS whole_within_bound, count(DISTINCT o_custkey) AS customers
FROM orders GROUP BY o_orderstatus
""")
def distinct_sketches(spark, sf):
    # a sketch for each status and day is stored; the counts of a status and of the whole table are united from them
    o = t(spark, sf, "orders")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/d5-{uuid.uuid4().hex}"
    D.distinct_sketches(o, ["o_orderstatus", "o_orderdate"], ["o_custkey"]).write.parquet(path)
    sketches = spark.read.parquet(path)
    exact = o.groupBy("o_orderstatus").agg(F.count_distinct("o_custkey").alias("customers"))
    whole = D.distinct_from_sketches(sketches, [], ["o_custkey"]).first()[0]  # one number
    all_customers = o.agg(F.count_distinct("o_custkey")).first()[0]
    near = lambda est, n: F.abs(est - n) <= F.greatest(F.lit(2), 0.05 * n)  # noqa: E731  6 standard errors of 2^14 registers
    return (D.distinct_from_sketches(sketches, ["o_orderstatus"], ["o_custkey"]).join(exact, "o_orderstatus")
            .select("o_orderstatus", near(F.col("o_custkey"), F.col("customers")).alias("within_bound"),
                    near(F.lit(whole), F.lit(all_customers)).alias("whole_within_bound"), "customers"))


@query("string_agg", """
SELECT p_brand, string_agg(nullif(p_type, 'SMALL'), ', ' ORDER BY nullif(p_type, 'SMALL')) AS tipos
FROM part WHERE nullif(p_type, 'SMALL') IS NOT NULL GROUP BY p_brand
""")
def string_agg_q(spark, sf):
    p = t(spark, sf, "part").select("p_brand", F.nullif("p_type", F.lit("SMALL")).alias("tipo"))
    return D.string_agg(p, ["p_brand"], "tipo", ", ", "tipos")


_PCT = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


@query("percentiles", """
SELECT p_brand,
  round(quantile_cont(p_retailprice, 0.5), 6) AS p50, round(quantile_cont(p_retailprice, 0.9), 6) AS p90,
  round(quantile_cont(p_retailprice, 0.95), 6) AS p95, round(quantile_cont(p_retailprice, 0.99), 6) AS p99
FROM part GROUP BY p_brand
""")
def percentiles_q(spark, sf):
    out = D.percentiles(t(spark, sf, "part"), ["p_brand"], "p_retailprice", _PCT)
    return out.select("p_brand", *[F.round(k, 6).alias(k) for k in _PCT])


@query("percentile_window", """
SELECT p_partkey, p_brand,
  round(quantile_cont(p_retailprice, 0.5) OVER (PARTITION BY p_brand), 6) AS p50,
  round(quantile_cont(p_retailprice, 0.9) OVER (PARTITION BY p_brand), 6) AS p90
FROM part
""")
def percentile_window(spark, sf):
    p = t(spark, sf, "part")
    per = D.percentiles(p, ["p_brand"], "p_retailprice", {"p50": 0.5, "p90": 0.9})
    return p.select("p_partkey", "p_brand").join(per, "p_brand").select(
        "p_partkey", "p_brand", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"))


@query("min_max", """
SELECT min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
       min(o_totalprice) AS min_price, max(o_totalprice) AS max_price FROM orders
""")
def min_max(spark, sf):
    return t(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"),
        F.min("o_totalprice").alias("min_price"), F.max("o_totalprice").alias("max_price"))


@query("having", """
SELECT o_custkey, COUNT(1) AS n FROM orders GROUP BY o_custkey HAVING COUNT(1) > 15
""")
def having(spark, sf):
    return (t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 15))


@query("rollup", f"""
SELECT {_YQM_NULLABLE_SQL}, COUNT(1) AS pedidos, {_MONEY_SQL} AS total, {_ES_SQL} AS total_es
FROM lineitem GROUP BY ROLLUP (year(l_shipdate), quarter(l_shipdate), month(l_shipdate))
""")
def rollup_q(spark, sf):
    return _double_keys(D.rollup(_month_base(spark, sf), ["anio", "trimestre", "mes"], _base_aggs()))


@query("cube", f"""
SELECT {_YQM_NULLABLE_SQL}, COUNT(1) AS pedidos, {_MONEY_SQL} AS total, {_ES_SQL} AS total_es
FROM lineitem GROUP BY CUBE (year(l_shipdate), quarter(l_shipdate), month(l_shipdate))
""")
def cube_q(spark, sf):
    return _double_keys(D.cube(_month_base(spark, sf), ["anio", "trimestre", "mes"], _base_aggs()))


@query("grouping_sets", f"""
SELECT {_YQM_NULLABLE_SQL}, COUNT(1) AS pedidos, {_MONEY_SQL} AS total, {_ES_SQL} AS total_es,
       CAST(GROUPING(year(l_shipdate), quarter(l_shipdate), month(l_shipdate)) AS BIGINT) AS grouping_id
FROM lineitem
GROUP BY GROUPING SETS ((year(l_shipdate)), (quarter(l_shipdate)), (month(l_shipdate)), ())
""")
def grouping_sets(spark, sf):
    return _double_keys(D.grouping(_month_base(spark, sf), [["anio"], ["trimestre"], ["mes"], []], _base_aggs(),
                                   keys=["anio", "trimestre", "mes"]))


@query("pivot", """
SELECT anio,
  CAST(SUM(CASE WHEN trimestre = 1 THEN total END) AS DOUBLE) AS T1,
  CAST(SUM(CASE WHEN trimestre = 2 THEN total END) AS DOUBLE) AS T2,
  CAST(SUM(CASE WHEN trimestre = 3 THEN total END) AS DOUBLE) AS T3,
  CAST(SUM(CASE WHEN trimestre = 4 THEN total END) AS DOUBLE) AS T4
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, CAST(quarter(l_shipdate) AS INTEGER) AS trimestre,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS total FROM lineitem) s
GROUP BY anio ORDER BY anio
""")
def pivot(spark, sf):
    li = t(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("anio"), F.quarter("l_shipdate").alias("trimestre"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total"))
    out = D.pivot_sum(li, ["anio"], "trimestre", [1, 2, 3, 4], "total", ["T1", "T2", "T3", "T4"])
    return out.select("anio", *[F.col(c).cast("double").alias(c) for c in ("T1", "T2", "T3", "T4")]
                      ).orderBy("anio")


@query("unpivot", """
SELECT p_partkey, tipo, cantidad FROM (
  UNPIVOT (SELECT p_partkey, p_retailprice AS S, CAST(nullif(p_size, 1) AS DOUBLE) AS T FROM part)
  ON S, T INTO NAME tipo VALUE cantidad)
""")
def unpivot(spark, sf):
    p = t(spark, sf, "part").select(
        "p_partkey", F.col("p_retailprice").alias("S"),
        F.nullif("p_size", F.lit(1)).cast("double").alias("T"))
    return D.unpivot_dropping_nulls(p, ["p_partkey"], ["S", "T"], "tipo", "cantidad")


@query("json_arrayagg", """
SELECT p_brand AS nombre, to_json(list(struct_pack(id := p_partkey, apellidos := p_name) ORDER BY p_partkey)) AS ids
FROM part GROUP BY p_brand
""")
def json_arrayagg(spark, sf):
    from tessera.operators.jsonops import json_array_by

    p = t(spark, sf, "part").select(F.col("p_brand").alias("nombre"),
                                    F.col("p_partkey").alias("id"), F.col("p_name").alias("apellidos"))
    return json_array_by(p, ["nombre"], ["id", "apellidos"], "ids")


@query("json_objectagg", """
SELECT o_custkey, '{' || string_agg(to_json(o_orderpriority) || ':' || CAST(o_orderkey AS VARCHAR), ','
                                    ORDER BY o_orderpriority, o_orderkey) || '}' AS numero
FROM orders GROUP BY o_custkey
""")
def json_objectagg(spark, sf):
    from tessera.operators.jsonops import json_object_by

    return json_object_by(t(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey",
                          "numero")


# --------------------------------------------------------------------------
# E. windows


@query("running_sum", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
       SUM(l_quantity) OVER (ORDER BY l_orderkey, l_partkey) AS total
FROM lineitem
""")
def running_sum(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                                         "l_quantity")
    return running_total(li, [], ["l_orderkey", "l_partkey"], "l_quantity", "total").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "total")


@query("running_avg", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
       AVG(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey) AS avg_qty,
       CAST(trunc(AVG(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey)) AS BIGINT) AS avg_qty_int
FROM lineitem
""")
def running_avg(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                                         "l_quantity")
    r = running_total(li, ["l_orderkey"], ["l_partkey"], "l_quantity", "_sum", count_name="_cnt")
    avg = F.col("_sum") / F.col("_cnt")
    return r.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", avg.alias("avg_qty"),
                    avg.cast("long").alias("avg_qty_int"))


@query("named_windows", """
SELECT o_orderkey, o_custkey,
  CAST(SUM(cents) OVER particionada AS BIGINT) AS total, COUNT(*) OVER particionada AS pedidos,
  rank() OVER (PARTITION BY o_orderstatus, o_custkey ORDER BY o_orderdate, o_orderkey) AS ranking, AVG(cents) OVER ultimos AS media
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
WINDOW particionada AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
  ultimos AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def named_windows(spark, sf):
    w = D.NamedWindows().define("ordenada", order_by=["o_orderdate", "o_orderkey"])
    w.define("particionada", "ordenada", partition_by=["o_custkey"]).define("ultimos", "particionada", frame=("rows", -2, 0))
    orders = t(spark, sf, "orders").withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    return w.select(orders, {
        "total": (F.sum("cents"), "particionada"), "pedidos": (F.count(F.lit(1)), "particionada"),
        "ranking": (F.rank(), w.resolve("ordenada", partition_by=["o_orderstatus", "o_custkey"])), "media": (F.avg("cents"), "ultimos")},
        keep=["o_orderkey", "o_custkey"]).withColumn("ranking", F.col("ranking").cast("long"))


@query("rank_part", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
       rank() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_partkey) AS ranking
FROM lineitem
""")
def rank_part(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                                         "l_quantity")
    r = running_total(li, ["l_partkey"], ["l_orderkey"], "l_quantity", "_sum")
    return r.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
                    F.col("_rank").alias("ranking"))
