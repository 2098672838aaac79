"""Hierarchy walks (M3, M4).

A breadth-first walk: each level is one join of the current frontier with
the edge table, so the number of Spark jobs is the depth of the tree, not its
size. Each level is checkpointed into the shared folder so the plan stays
one join deep, and the path column guards against cycles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import target_partitions
from tessera.session import cut_lineage


class RecursionLimitExceeded(RuntimeError):
    """The walk went deeper than the ``max_depth`` the caller allowed."""


def walk(edges: DataFrame, start: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All descendants of the ``start`` rows (columns ``id``; level 0 are the
    start rows' children). ``edges`` has columns ``id`` and ``parent``.
    Returns (level, path, id, parent); ``path`` is ``/a/b/c/`` from the
    first level down.

    The walk always ends: the path guard refuses to revisit a node on the
    same path, so a cycle stops. There is no silent depth cap; with
    ``max_depth`` a deeper tree raises ``RecursionLimitExceeded`` instead of
    being cut short."""
    # Partition the edges by parent once and keep that partitioning: every
    # level then shuffles only the (small) frontier to meet them.
    e = cut_lineage(edges.select("id", "parent").repartition(target_partitions(edges), "parent"))
    frontier = (e.join(start.select(F.col("id").alias("_s")), F.col("parent") == F.col("_s"))
                .select(F.lit(0).alias("level"),
                        F.concat(F.lit("/"), F.col("id").cast("string"), F.lit("/")).alias("path"),
                        "id", "parent"))
    frontier = cut_lineage(frontier)
    levels = [frontier]
    depth = 0
    while not frontier.isEmpty():
        if max_depth is not None and depth >= max_depth:
            raise RecursionLimitExceeded(f"hierarchy deeper than {max_depth} levels")
        depth += 1
        nxt = (frontier.select(F.col("id").alias("_p"), F.col("path").alias("_path"))
               .join(e, F.col("parent") == F.col("_p"))
               .where(~F.col("_path").contains(F.concat(F.lit("/"), F.col("id").cast("string"), F.lit("/"))))
               .select(F.lit(depth).alias("level"),
                       F.concat(F.col("_path"), F.col("id").cast("string"), F.lit("/")).alias("path"),
                       "id", "parent"))
        frontier = cut_lineage(nxt)
        levels.append(frontier)
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


def manager_tree(edges: DataFrame, people: DataFrame, root, first: str, last: str,
                 max_depth: int | None = None) -> DataFrame:
    """M3: all reports of manager ``root`` at any depth with the recursion
    level, the node path and the direct manager's and the employee's names
    (the 7 columns of the reference's result)."""
    spark = edges.sparkSession
    start = spark.range(1).select(F.lit(root).cast(edges.schema["id"].dataType).alias("id"))
    tree = walk(edges, start, max_depth)
    mgr = people.select(F.col("id").alias("_mid"), F.col(first).alias("ManagerFirstName"),
                        F.col(last).alias("ManagerLastName"))
    emp = people.select(F.col("id").alias("_eid"), F.col(first).alias("FirstName"),
                        F.col(last).alias("LastName"))
    return (tree.join(mgr, F.col("parent") == F.col("_mid"), "left")
            .join(emp, F.col("id") == F.col("_eid"), "left")
            .select(F.col("level").cast("int").alias("RecursionLevel"),
                    F.col("path").alias("OrganizationNode"), "ManagerFirstName", "ManagerLastName",
                    F.col("id").alias("BusinessEntityID"), "FirstName", "LastName"))


def hierarchy_level(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """M4: level of every node reachable from a root (a node whose parent
    is not a node); roots are level 0."""
    e = edges.select("id", "parent")
    roots = e.join(e.select(F.col("id").alias("_pid")), F.col("parent") == F.col("_pid"), "left_anti")
    below = walk(e, roots.select("id"), max_depth).select("id", (F.col("level") + 1).alias("level"))
    return roots.select("id", F.lit(0).alias("level")).unionByName(below).withColumn(
        "level", F.col("level").cast("int"))
