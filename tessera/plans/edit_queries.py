"""Queries for table edits as rewrites (K1-K7) over ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import edits as K
from tessera.plans.fixtures import SNAP_COLS
from tessera.plans.registry import query
from tessera.plans.relational_queries import t

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]


@query("update_where", """
SELECT o_orderkey,
  CASE WHEN coalesce(nullif(o_orderpriority, '5-LOW') = '1-URGENT', false) THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN coalesce(nullif(o_orderpriority, '5-LOW') = '1-URGENT', false) THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice,
  o_orderpriority
FROM orders
""")
def update_where(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    pred = F.nullif("o_orderpriority", F.lit("5-LOW")) == "1-URGENT"  # NULL for 5-LOW rows
    return K.update_where(o, pred, {"o_orderstatus": F.lower("o_orderstatus"),
                                    "o_totalprice": F.col("o_totalprice") + 100})


@query("update_from", """
SELECT o.o_orderkey,
  (SELECT CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem l
   WHERE l.l_orderkey = o.o_orderkey) AS o_totalprice
FROM orders o
""")
def update_from(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    li = t(spark, sf, "lineitem")
    sums = li.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("_sum"))
    return K.update_from(o, sums, "o_orderkey", "l_orderkey", {"o_totalprice": F.col("_sum")})


@query("delete_where", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT coalesce(o_orderstatus = 'P', false)
""")
def delete_where(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return K.delete_where(o, F.col("o_orderstatus") == "P")


@query("upsert", """
WITH new_rows AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'X-CHANGED' AS o_orderpriority
  FROM orders WHERE year(o_orderdate) = 1996
  UNION ALL
  SELECT o_orderkey + 1 + (SELECT max(o_orderkey) FROM orders), o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE year(o_orderdate) = 1997)
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_rows)
UNION ALL SELECT * FROM new_rows
""")
def upsert(spark, sf):
    o = t(spark, sf, "orders").select(*_ORDER_COLS)
    changed = o.where(F.year("o_orderdate") == 1996).withColumn("o_orderpriority", F.lit("X-CHANGED"))
    top = o.agg(F.max("o_orderkey")).first()[0] or 0  # new keys lie above all there are
    added = o.where(F.year("o_orderdate") == 1997).withColumn("o_orderkey", F.col("o_orderkey") + 1 + F.lit(top))
    return K.upsert(o, changed.unionByName(added), "o_orderkey")


@query("edit_conflicts", """
WITH cur AS (SELECT user_id, max(event_id) AS stored_version FROM events GROUP BY user_id)
SELECT e.event_id, e.user_id, e.event_id AS read_version, cur.stored_version,
       CASE WHEN cur.user_id IS NULL THEN 'gone' WHEN cur.stored_version = e.event_id THEN 'ok' ELSE 'conflict' END AS status
FROM events e LEFT JOIN cur ON e.user_id = cur.user_id WHERE e.event_type = 'click'
""")
def edit_conflicts(spark, sf):
    e = t(spark, sf, "events")
    current = e.groupBy("user_id").agg(F.max("event_id").alias("read_version"))
    edits = e.where(F.col("event_type") == "click").select(
        "event_id", "user_id", F.col("event_id").alias("read_version"))
    return K.edit_conflicts(current, edits, "user_id", "read_version")


_MERGE_SQL = """o AS (SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders),
s AS (SELECT o_orderkey,
        CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 13 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
        o_orderpriority FROM orders),
m AS (SELECT o_orderkey,
        CASE WHEN o_orderkey % 22 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice,
        o_orderstatus,
        CASE WHEN o_orderkey % 7 = 0 THEN 'X-MINE' ELSE o_orderpriority END AS o_orderpriority FROM orders)"""


def _merge_inputs(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", *SNAP_COLS)
    k = F.col("o_orderkey")
    stored = o.select(
        "o_orderkey",
        F.when(k % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 13 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority")
    mine = o.select(
        "o_orderkey",
        F.when(k % 22 == 0, F.col("o_totalprice") + 5).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderstatus",
        F.when(k % 7 == 0, F.lit("X-MINE")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return o, mine, stored


def _pick(c):
    return (f"CASE WHEN s.{c} IS DISTINCT FROM o.{c} AND m.{c} IS NOT DISTINCT FROM o.{c} "
            f"THEN s.{c} ELSE m.{c} END AS {c}")


def _conflict(c):
    return (f"SELECT m.o_orderkey, '{c}' AS field FROM m JOIN o USING (o_orderkey) JOIN s USING (o_orderkey) "
            f"WHERE m.{c} IS DISTINCT FROM o.{c} AND s.{c} IS DISTINCT FROM o.{c} AND m.{c} IS DISTINCT FROM s.{c}")


@query("three_way_merge", f"""
WITH {_MERGE_SQL}
SELECT m.o_orderkey, {", ".join(_pick(c) for c in SNAP_COLS)}
FROM m LEFT JOIN o ON m.o_orderkey = o.o_orderkey LEFT JOIN s ON m.o_orderkey = s.o_orderkey
""")
def three_way_merge(spark, sf):
    o, mine, stored = _merge_inputs(spark, sf)
    merged, _conflicts = K.three_way_merge(o, mine, stored, "o_orderkey", SNAP_COLS)
    return merged


@query("merge_conflicts", f"""
WITH {_MERGE_SQL}
{" UNION ALL ".join(_conflict(c) for c in SNAP_COLS)}
""")
def merge_conflicts(spark, sf):
    o, mine, stored = _merge_inputs(spark, sf)
    _merged, conflicts = K.three_way_merge(o, mine, stored, "o_orderkey", SNAP_COLS)
    return conflicts


@query("add_drop_columns", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS account
FROM customer
""")
def add_drop_columns(spark, sf):
    from tessera.operators.relational import account_number

    c = t(spark, sf, "customer")
    added = K.add_columns(c, {"account": account_number("c_custkey")})
    return K.drop_columns(added, ["c_acctbal", "no_such_column"])
