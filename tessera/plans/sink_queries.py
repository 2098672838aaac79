"""Queries for sinks and the write path (A5, A6, K4/K6/L4 through versioned
tables). They write into the session's shared checkpoint folder, read the
result back and return it, so the check sees what was stored."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.operators import edits as K
from tessera.operators import quality as L
from tessera.plans.registry import query
from tessera.plans.relational_queries import t
from tessera.session import ensure_checkpoint_dir
from tessera.sources import tables as S
from tessera.sources import versioned as V


def _scratch(spark, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


@query("append_select", """
SELECT p_partkey, p_name, p_retailprice,
       row_number() OVER (ORDER BY p_partkey, p_name, p_retailprice) AS id
FROM part
""")
def append_select(spark, sf):
    path = _scratch(spark, "a5")
    S.append_select(t(spark, sf, "part"), path, ["p_partkey", "p_name", "p_retailprice"], key="id")
    return spark.read.parquet(path)


@query("json_lines", """
SELECT to_json(struct_pack(id := c_custkey, Info := struct_pack(Nombre := c_name, Segmento := c_mktsegment))) AS value
FROM customer
""")
def json_lines(spark, sf):
    path = _scratch(spark, "a6")
    S.write_json(t(spark, sf, "customer"),
                 {"id": "c_custkey", "Info.Nombre": "c_name", "Info.Segmento": "c_mktsegment"}, path)
    return spark.read.text(path)


@query("save_changes", """
SELECT c_custkey,
       CASE WHEN c_custkey % 10 IN (0, 1) AND c_acctbal >= 0 THEN upper(c_name) ELSE c_name END AS c_name,
       c_acctbal,
       CAST(CASE WHEN c_custkey % 10 IN (0, 1) AND c_acctbal >= 0 THEN 2 ELSE 1 END AS BIGINT) AS version
FROM customer
""")
def save_changes(spark, sf):
    # version 1 of the table, a batch of edits (a tenth read a stale version),
    # the rule gate, the version check and the rewrite as version 2
    base = _scratch(spark, "path4")
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal",
                                        F.lit(1).cast("long").alias("version"))
    first = V.write_version(c, base)
    current = V.read_current(spark, base)
    k = F.col("c_custkey") % 10
    edits = current.where(k < 3).select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_acctbal",
        F.when(k == 2, F.lit(0)).otherwise(F.col("version")).cast("long").alias("version"))
    new, _rejected, _conflicts = K.save_changes(current, edits, "c_custkey", "version",
                                                [L.Check("acctbal", F.col("c_acctbal") >= 0)])
    V.write_version(new, base, expect=first)
    return V.read_current(spark, base)


@query("concurrent_commits", """
SELECT c_custkey,
       CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS c_name,
       CASE WHEN c_custkey % 3 = 1 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       CAST(CASE WHEN c_custkey % 3 IN (0, 1) THEN 2 ELSE 1 END AS BIGINT) AS version
FROM customer
""")
def concurrent_commits(spark, sf):
    # two writers start from version 1: one commits while the other still works, so the other's first
    # commit is refused and its rewrite runs again on the new version; a stale edit of a changed row is not taken
    base = _scratch(spark, "commits")
    c = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", F.lit(1).cast("long").alias("version"))
    V.write_version(c, base)
    seen = V.read_current(spark, base)
    k = F.col("c_custkey") % 3
    mine = seen.where(k < 2).withColumn("c_acctbal", F.lit(0.0))  # of k = 0 too, which the other writer changes first
    theirs = seen.where(k == 0).withColumn("c_name", F.upper("c_name"))
    turns = []

    def rewrite(current):
        if not turns:
            turns.append(V.update(spark, base, lambda now: K.save_changes(now, theirs, "c_custkey", "version")[0]))
        return K.save_changes(current, mine, "c_custkey", "version")[0]

    V.update(spark, base, rewrite)
    return V.read_current(spark, base)
