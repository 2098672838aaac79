"""Queries for change data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import changes as C
from tessera.plans.fixtures import (AFTER_SQL, LOG_SQL, NOW, SINCE_SQL, SNAP_COLS, TRACKED,
                                    change_log, since_version_value, snapshot_after,
                                    snapshot_before)
from tessera.plans.registry import query
from tessera.plans.relational_queries import t

_T1 = "2024-01-19 00:00:00"  # NOW - 1 day
_MASK_SQL = ("(CASE WHEN b_et IS DISTINCT FROM a_et THEN 1 ELSE 0 END"
             " + CASE WHEN b_v IS DISTINCT FROM a_v THEN 2 ELSE 0 END"
             " + CASE WHEN b_p IS DISTINCT FROM a_p THEN 4 ELSE 0 END)")

_NET_SQL = f"""{LOG_SQL},
a AS (SELECT user_id, arg_min(op, event_id) AS first_op, arg_max(op, event_id) AS last_op,
             max(event_id) AS ver, arg_max(event_type, event_id) AS a_et, arg_max(value, event_id) AS a_v,
             arg_max(props, event_id) AS a_p
      FROM lg WHERE event_id > {SINCE_SQL} GROUP BY user_id),
b AS (SELECT user_id, arg_max(event_type, event_id) AS b_et, arg_max(value, event_id) AS b_v,
             arg_max(props, event_id) AS b_p
      FROM lg WHERE event_id <= {SINCE_SQL} GROUP BY user_id),
ch AS (SELECT a.user_id, a.ver AS CT_Version,
         CASE WHEN last_op = 'D' THEN 'D' WHEN first_op = 'I' THEN 'I' ELSE 'U' END AS CT_Operation,
         CASE WHEN last_op <> 'D' AND first_op <> 'I' THEN CAST({_MASK_SQL} AS DOUBLE) END AS CT_Columns
       FROM a LEFT JOIN b ON a.user_id = b.user_id),
cur AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
               arg_max(props, event_id) AS props, arg_max(op, event_id) AS last_op
        FROM lg GROUP BY user_id)"""


def _changes(spark, sf):
    # the mask is NULL for inserts and deletes; nullable integers leave as DOUBLE
    ch = C.changes_since(change_log(spark, sf), "user_id", "event_id", "op", TRACKED,
                         since_version_value(spark, sf))
    return ch.withColumn("CT_Columns", F.col("CT_Columns").cast("double"))


def _current(spark, sf):
    return C.current_state(change_log(spark, sf), "user_id", "event_id", "op", TRACKED)


@query("since_version", f"""
SELECT event_id, user_id, event_type FROM events WHERE event_id > {SINCE_SQL}
""")
def since_version(spark, sf):
    rows, _new_last = C.since_version(t(spark, sf, "events"), "event_id", since_version_value(spark, sf))
    return rows.select("event_id", "user_id", "event_type")


@query("changes_since", f"WITH {_NET_SQL} SELECT CT_Version, CT_Operation, CT_Columns, user_id FROM ch")
def changes_since(spark, sf):
    return _changes(spark, sf)


@query("changes_untracked", f"WITH {_NET_SQL} SELECT CT_Version, CT_Operation, CAST(NULL AS DOUBLE) AS CT_Columns, user_id FROM ch")
def changes_untracked(spark, sf):
    # The table tracked without its columns: no mask, and no reading of the log before the version
    ch = C.changes_since(change_log(spark, sf), "user_id", "event_id", "op", TRACKED, since_version_value(spark, sf), track_columns=False)
    return ch.withColumn("CT_Columns", F.col("CT_Columns").cast("double"))


@query("snapshot_diff", f"""
WITH {AFTER_SQL},
j AS (SELECT b.o_orderkey AS bk, a.o_orderkey AS ak,
        (CASE WHEN b.o_totalprice IS DISTINCT FROM a.o_totalprice THEN 1 ELSE 0 END
         + CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN 2 ELSE 0 END
         + CASE WHEN b.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 4 ELSE 0 END) AS m
      FROM orders b FULL OUTER JOIN after_o a ON b.o_orderkey = a.o_orderkey)
SELECT coalesce(ak, bk) AS o_orderkey,
       CASE WHEN bk IS NULL THEN 'I' WHEN ak IS NULL THEN 'D' ELSE 'U' END AS operation,
       CASE WHEN bk IS NOT NULL AND ak IS NOT NULL THEN CAST(m AS DOUBLE) END AS mask
FROM j WHERE bk IS NULL OR ak IS NULL OR m <> 0
""")
def snapshot_diff(spark, sf):
    d = C.snapshot_diff(snapshot_before(spark, sf), snapshot_after(spark, sf), "o_orderkey", SNAP_COLS)
    return d.withColumn("mask", F.col("mask").cast("double"))


@query("change_mask", f"""
WITH {AFTER_SQL},
j AS (SELECT b.o_orderkey,
        (CASE WHEN b.o_totalprice IS DISTINCT FROM a.o_totalprice THEN 1 ELSE 0 END
         + CASE WHEN b.o_orderstatus IS DISTINCT FROM a.o_orderstatus THEN 2 ELSE 0 END
         + CASE WHEN b.o_orderpriority IS DISTINCT FROM a.o_orderpriority THEN 4 ELSE 0 END) AS m
      FROM orders b JOIN after_o a ON b.o_orderkey = a.o_orderkey)
SELECT o_orderkey, CAST(m AS BIGINT) AS mask, (m & 1) <> 0 AS price_changed, (m & 2) <> 0 AS status_changed
FROM j WHERE m <> 0
""")
def change_mask(spark, sf):
    d = C.snapshot_diff(snapshot_before(spark, sf), snapshot_after(spark, sf), "o_orderkey",
                        SNAP_COLS).where(F.col("operation") == "U")
    return d.select("o_orderkey", "mask", C.in_mask("mask", 0).alias("price_changed"),
                    C.in_mask("mask", 1).alias("status_changed"))


@query("changes_current", f"""
WITH {_NET_SQL}
SELECT ch.user_id, ch.CT_Operation, ch.CT_Columns, cur.event_type, cur.value
FROM ch LEFT JOIN (SELECT * FROM cur WHERE last_op <> 'D') cur ON ch.user_id = cur.user_id
WHERE ch.CT_Operation <> 'D'
""")
def changes_current(spark, sf):
    out = C.changes_current(_changes(spark, sf), _current(spark, sf), "user_id")
    return out.select("user_id", "CT_Operation", "CT_Columns", "event_type", "value")


@query("change_feed", f"""
WITH {_NET_SQL}
SELECT ch.CT_Version, ch.CT_Operation, ch.CT_Columns, coalesce(cur.user_id, ch.user_id) AS user_id,
       cur.event_type, cur.value, cur.props
FROM ch LEFT JOIN (SELECT * FROM cur WHERE last_op <> 'D') cur ON ch.user_id = cur.user_id
""")
def change_feed(spark, sf):
    return C.change_feed(_changes(spark, sf), _current(spark, sf), "user_id", TRACKED)


_RANGE_SQL = f"""rng AS (SELECT min(CASE WHEN ts >= TIMESTAMP '{_T1}' THEN event_id END) AS lo,
                             max(CASE WHEN ts <= TIMESTAMP '{NOW}' THEN event_id END) AS hi FROM events)"""


def _commit_range(spark, sf):
    r = C.commit_range(t(spark, sf, "events"), "event_id", "ts", _T1, NOW).first()
    return r["from_commit"], r["to_commit"]


_ALL_SQL = f"""{LOG_SQL}, {_RANGE_SQL},
w AS (SELECT lg.*, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b_et,
             lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b_v,
             lag(props) OVER (PARTITION BY user_id ORDER BY event_id) AS b_p
      FROM lg WHERE event_id <= (SELECT hi FROM rng)),
allc AS (SELECT event_id AS commit_id,
       CASE op WHEN 'D' THEN 1 WHEN 'I' THEN 2 ELSE 4 END AS operation,
       CAST(CASE WHEN op = 'U' THEN (CASE WHEN b_et IS DISTINCT FROM event_type THEN 1 ELSE 0 END
                                     + CASE WHEN b_v IS DISTINCT FROM value THEN 2 ELSE 0 END
                                     + CASE WHEN b_p IS DISTINCT FROM props THEN 4 ELSE 0 END)
                 ELSE 7 END AS BIGINT) AS update_mask,
       user_id, event_type, value
FROM w WHERE event_id >= (SELECT lo FROM rng))"""


@query("time_to_commit", f"WITH {_RANGE_SQL} SELECT lo AS from_commit, hi AS to_commit FROM rng")
def time_to_commit(spark, sf):
    return C.commit_range(t(spark, sf, "events"), "event_id", "ts", _T1, NOW)


@query("cdc_all", f"WITH {_ALL_SQL} SELECT * FROM allc")
def cdc_all(spark, sf):
    lo, hi = _commit_range(spark, sf)
    out = C.all_changes(change_log(spark, sf), "user_id", "event_id", "op", TRACKED, lo, hi)
    return out.select("commit_id", "operation", "update_mask", "user_id", "event_type", "value")


@query("cdc_net", f"""
WITH {LOG_SQL}, {_RANGE_SQL},
a AS (SELECT user_id, arg_min(op, event_id) AS first_op, arg_max(op, event_id) AS last_op,
             max(event_id) AS commit_id, arg_max(event_type, event_id) AS event_type,
             arg_max(value, event_id) AS value, arg_max(props, event_id) AS props
      FROM lg WHERE event_id BETWEEN (SELECT lo FROM rng) AND (SELECT hi FROM rng) GROUP BY user_id)
SELECT commit_id, CASE WHEN last_op = 'D' THEN 1 WHEN first_op = 'I' THEN 2 ELSE 4 END AS operation,
       user_id, event_type, value, props
FROM a WHERE NOT (first_op = 'I' AND last_op = 'D')
""")
def cdc_net(spark, sf):
    lo, hi = _commit_range(spark, sf)
    return C.net_changes(change_log(spark, sf), "user_id", "event_id", "op", TRACKED, lo, hi)


@query("change_audit", f"""
WITH {_ALL_SQL}
SELECT allc.commit_id, allc.operation, allc.user_id, 'svc-' || e.event_type AS committed_by, e.ts AS commit_ts
FROM allc JOIN events e ON allc.commit_id = e.event_id
""")
def change_audit(spark, sf):
    lo, hi = _commit_range(spark, sf)
    changes = C.all_changes(change_log(spark, sf), "user_id", "event_id", "op", TRACKED, lo, hi)
    commits = t(spark, sf, "events").select(
        F.col("event_id").alias("commit_id"),
        F.concat(F.lit("svc-"), "event_type").alias("committed_by"), F.col("ts").alias("commit_ts"))
    return C.change_audit(changes.select("commit_id", "operation", "user_id"), commits)


@query("retention", f"""
SELECT min(event_id) AS min_valid_version, max(event_id) AS current_version, COUNT(*) AS retained
FROM events WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY
""")
def retention(spark, sf):
    kept = C.retain(t(spark, sf, "events"), "ts", 2, NOW)
    return kept.agg(F.min("event_id").alias("min_valid_version"),
                    F.max("event_id").alias("current_version"),
                    F.count(F.lit(1)).alias("retained"))


@query("cdc_all_with_before", f"""
WITH {_ALL_SQL}
SELECT commit_id, operation, update_mask, user_id, event_type, value FROM allc
UNION ALL
SELECT w.event_id, 3, CAST((CASE WHEN b_et IS DISTINCT FROM event_type THEN 1 ELSE 0 END
                          + CASE WHEN b_v IS DISTINCT FROM value THEN 2 ELSE 0 END
                          + CASE WHEN b_p IS DISTINCT FROM props THEN 4 ELSE 0 END) AS BIGINT),
       user_id, b_et, b_v
FROM w WHERE op = 'U' AND event_id >= (SELECT lo FROM rng)
""")
def cdc_all_with_before(spark, sf):
    lo, hi = _commit_range(spark, sf)
    out = C.all_changes(change_log(spark, sf), "user_id", "event_id", "op", TRACKED, lo, hi,
                        with_before=True)
    return out.select("commit_id", "operation", "update_mask", "user_id", "event_type", "value")
