"""Queries for system-versioned history (T1-T6) built from ``events``:
key ``user_id``, version time ``ts``, ties ordered by ``event_id``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import history as H
from tessera.plans.registry import query
from tessera.plans.relational_queries import t

AS_OF = "2024-01-15 00:00:00"
FROM_A, TO_B = "2024-01-10 00:00:00", "2024-01-12 00:00:00"

HIST_SQL = f"""h AS (
  SELECT user_id, event_id, event_type, value, ts AS valid_from,
         coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
                  TIMESTAMP '{H.END_OF_TIME}') AS valid_to
  FROM events),
hist AS (SELECT * FROM h WHERE valid_from < valid_to)"""


def history(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return H.build_history(e, "user_id", "ts", "event_id").drop("ts")


_COLS = ["user_id", "event_id", "event_type", "value", "valid_from", "valid_to"]

# Periods end in year 9999, past what pandas timestamps hold, so the
# registered queries render the period bounds as fixed-format text.
_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_FMT_SQL = "'%Y-%m-%d %H:%M:%S.%f'"


def _text_period(df):
    return df.withColumn("valid_from", F.date_format("valid_from", _FMT)).withColumn(
        "valid_to", F.date_format("valid_to", _FMT))


def _sql_text(cols="user_id, event_id, event_type, value"):
    return f"{cols}, strftime(valid_from, {_FMT_SQL}) AS valid_from, strftime(valid_to, {_FMT_SQL}) AS valid_to"


@query("history", f"WITH {HIST_SQL} SELECT {_sql_text()} FROM hist")
def history_q(spark, sf):
    return _text_period(history(spark, sf).select(*_COLS))


@query("temporal_all", f"""
WITH {HIST_SQL}
SELECT {_sql_text()} FROM hist WHERE valid_to = TIMESTAMP '{H.END_OF_TIME}'
UNION ALL SELECT {_sql_text()} FROM hist WHERE valid_to < TIMESTAMP '{H.END_OF_TIME}'
""")
def temporal_all(spark, sf):
    h = history(spark, sf).select(*_COLS)
    eot = H.end_of_time(h.schema["valid_to"].dataType)
    current, past = h.where(F.col("valid_to") == eot), h.where(F.col("valid_to") < eot)
    return _text_period(current.unionByName(past))


@query("temporal_as_of", f"""
WITH {HIST_SQL}
SELECT {_sql_text()} FROM hist WHERE valid_from <= TIMESTAMP '{AS_OF}' AND TIMESTAMP '{AS_OF}' < valid_to
""")
def temporal_as_of(spark, sf):
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return _text_period(H.versions_as_of(e, "user_id", "ts", "event_id", AS_OF).select(*_COLS))


@query("as_of_join", f"""
WITH {HIST_SQL},
p AS (SELECT event_id AS probe_id, user_id, date_trunc('day', ts) AS probe_t FROM events WHERE event_type = 'purchase')
SELECT p.probe_id, p.user_id, p.probe_t, hist.event_type AS state_type, hist.value AS state_value
FROM p LEFT JOIN hist ON p.user_id = hist.user_id AND hist.valid_from <= p.probe_t AND p.probe_t < hist.valid_to
""")
def as_of_join(spark, sf):
    e = t(spark, sf, "events")
    probes = e.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("probe_id"), "user_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("probe_t"))
    h = history(spark, sf).select("user_id", F.col("event_type").alias("state_type"),
                                  F.col("value").alias("state_value"), "valid_from", "valid_to")
    return H.as_of_join(probes, h, "user_id", "probe_t", ["state_type", "state_value"]).select(
        "probe_id", "user_id", "probe_t", "state_type", "state_value")


@query("temporal_between", f"""
WITH {HIST_SQL}
SELECT {_sql_text()} FROM hist WHERE valid_from <= TIMESTAMP '{TO_B}' AND valid_to > TIMESTAMP '{FROM_A}'
""")
def temporal_between(spark, sf):
    return _text_period(H.between(history(spark, sf).select(*_COLS), FROM_A, TO_B))


@query("key_history", f"""
WITH {HIST_SQL}
SELECT event_type, valid_from FROM hist
WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)
ORDER BY valid_from
""")
def key_history(spark, sf):
    # the key whose row changed last (picked from the data, not a fixed id)
    last_key = t(spark, sf, "events").agg(
        F.max_by("user_id", F.struct("ts", "event_id")).alias("k")).first()["k"]
    # the key is filtered before the history is built, so only its rows are ordered
    one = t(spark, sf, "events").where(F.col("user_id") == F.lit(last_key)).select("user_id", "event_id", "ts", "event_type", "value")
    return H.key_history(H.build_history(one, "user_id", "ts", "event_id").drop("ts"), "user_id", last_key).select("event_type", "valid_from")


@query("backfill", f"""
WITH b AS (SELECT user_id, event_id, event_type, date_trunc('day', ts) AS valid_from FROM events),
h AS (SELECT user_id, event_id, event_type, valid_from,
             coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from, event_id),
                      TIMESTAMP '{H.END_OF_TIME}') AS valid_to FROM b)
SELECT {_sql_text("user_id, event_id, event_type")} FROM h WHERE valid_from < valid_to
""")
def backfill(spark, sf):
    e = t(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    b = H.backfill(e, "vf", "day").select("user_id", "event_id", "event_type", "vf")
    h = H.build_history(b, "user_id", "vf", "event_id")
    return _text_period(h.select("user_id", "event_id", "event_type", "valid_from", "valid_to"))


@query("apply_versions", f"WITH {HIST_SQL} SELECT {_sql_text()} FROM hist")
def apply_versions(spark, sf):
    # history of the first half of January, then the rest applied as new
    # versions: must equal the history built from the whole log (T7 = T1)
    e = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = H.build_history(e.where(F.col("ts") < cut), "user_id", "ts", "event_id")
    grown = H.apply_versions(first, e.where(F.col("ts") >= cut), "user_id", "ts", "event_id")
    return _text_period(grown.select(*_COLS))
