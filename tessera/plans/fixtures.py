"""Derived fixtures: change logs, snapshots and histories built from the
driver tables, in Spark and (as SQL text) for the DuckDB oracle.

- change log: ``events`` by ``user_id``, version ``event_id``, operation
  ``signup`` -> I, ``error`` -> D, anything else -> U; tracked columns
  ``event_type``, ``value``, ``props``.
- snapshots: ``orders`` before, and after a batch of edits (some rows
  deleted, prices and statuses changed, new keys added) - every row of the
  table goes through the comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.relational_queries import t

TRACKED = ["event_type", "value", "props"]
NOW = "2024-01-20 00:00:00"  # the reference's GETDATE(), fixed so results are stable
SINCE_TS = NOW

LOG_SQL = """lg AS (
  SELECT user_id, event_id, ts, event_type, value, props,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op
  FROM events)"""

SINCE_SQL = f"(SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '{SINCE_TS}')"


def change_log(spark, sf):
    e = t(spark, sf, "events")
    op = (F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
          .otherwise("U"))
    return e.select("user_id", "event_id", "ts", *TRACKED, op.alias("op"))


def since_version_value(spark, sf):
    """The version to read changes after: last commit before NOW (one scalar)."""
    e = t(spark, sf, "events")
    return e.where(F.col("ts") < F.lit(SINCE_TS).cast("timestamp_ntz")).agg(F.max("event_id")).first()[0]


SNAP_COLS = ["o_totalprice", "o_orderstatus", "o_orderpriority"]

AFTER_SQL = """after_o AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 13 = 0 THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus,
         o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT o_orderkey + 1 + (SELECT max(o_orderkey) FROM orders), o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 101 = 0)"""


def snapshot_after(spark, sf):
    o = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    kept = o.where(k % 97 != 0).select(
        "o_orderkey",
        F.when(k % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 13 == 0, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority")
    top = o.agg(F.max("o_orderkey")).first()[0] or 0  # new keys lie above all there are
    added = o.where(k % 101 == 0).select((k + 1 + F.lit(top)).alias("o_orderkey"), "o_totalprice",
                                         "o_orderstatus", "o_orderpriority")
    return kept.unionByName(added)


def snapshot_before(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", *SNAP_COLS)
