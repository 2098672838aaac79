"""Queries for text search (M1, M2), hierarchy walks (M3, M4) and the
compression report (M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import compression as Z
from tessera.operators import hierarchy as M
from tessera.operators import search as S
from tessera.plans.registry import query
from tessera.plans.relational_queries import t

FREE_QUERY = "rewh sich"
RANKED_QUERY = "that orre"
SYNONYMS = {"orre": ["thon"]}
RANKED_LANG = "en"


def _values(pairs):
    return ", ".join(f"('{a}', '{b}')" for a, b in pairs)


_TOK_SQL = r"unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+'))"


@query("free_text", f"""
WITH tok AS (SELECT doc_id, {_TOK_SQL} AS w FROM documents),
f AS (SELECT * FROM (VALUES {_values(S.word_forms(S.query_words(FREE_QUERY)))}) v(term, form))
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM tok JOIN f ON tok.w = f.form)
""")
def free_text(spark, sf):
    d = t(spark, sf, "documents")
    return S.free_text(d, "doc_id", "text", FREE_QUERY).select("doc_id", "lang")


@query("ranked_search", f"""
WITH d AS (SELECT doc_id, text FROM documents WHERE lang = '{RANKED_LANG}'),
tok AS (SELECT doc_id, {_TOK_SQL} AS w FROM d),
f AS (SELECT * FROM (VALUES {_values(S.word_forms(S.query_words(RANKED_QUERY), True, SYNONYMS))}) v(term, form)),
tf AS (SELECT doc_id, term, COUNT(*) AS tf FROM tok JOIN f ON tok.w = f.form GROUP BY doc_id, term),
dfq AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term)
SELECT doc_id, round(SUM(tf * ln(CAST((SELECT COUNT(*) FROM d) AS DOUBLE) / df)), 6) AS score
FROM tf JOIN dfq USING (term) GROUP BY doc_id
""")
def ranked_search(spark, sf):
    d = t(spark, sf, "documents")
    r = S.ranked_search(d, "doc_id", "text", RANKED_QUERY, True, SYNONYMS, RANKED_LANG)
    return r.select("doc_id", F.round("score", 6).alias("score"))


def _edges(spark, sf):
    c = t(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.floor((F.col("c_custkey") - 1) / 10).cast("long").alias("parent"),
                    "c_name", "c_mktsegment")


_EDGES_SQL = ("e AS (SELECT c_custkey AS id, CAST(floor((c_custkey - 1) / 10) AS BIGINT) AS parent, "
              "c_name, c_mktsegment FROM customer)")


@query("manager_tree", f"""
WITH RECURSIVE {_EDGES_SQL},
t(level, path, id, parent) AS (
  SELECT 0, '/' || CAST(id AS VARCHAR) || '/', id, parent FROM e WHERE parent = 0
  UNION ALL
  SELECT t.level + 1, t.path || CAST(e.id AS VARCHAR) || '/', e.id, e.parent
  FROM t JOIN e ON e.parent = t.id)
SELECT CAST(t.level AS INTEGER) AS RecursionLevel, t.path AS OrganizationNode,
       m.c_name AS ManagerFirstName, m.c_mktsegment AS ManagerLastName,
       t.id AS BusinessEntityID, x.c_name AS FirstName, x.c_mktsegment AS LastName
FROM t LEFT JOIN e m ON m.id = t.parent LEFT JOIN e x ON x.id = t.id
""")
def manager_tree(spark, sf):
    e = _edges(spark, sf)
    return M.manager_tree(e, e, 0, "c_name", "c_mktsegment")


@query("hierarchy_level", f"""
WITH RECURSIVE {_EDGES_SQL},
r AS (SELECT id FROM e WHERE parent NOT IN (SELECT id FROM e)),
t(level, id) AS (SELECT 0, id FROM r UNION ALL SELECT t.level + 1, e.id FROM t JOIN e ON e.parent = t.id)
SELECT id, CAST(level AS INTEGER) AS level FROM t
""")
def hierarchy_level(spark, sf):
    return M.hierarchy_level(_edges(spark, sf).select("id", "parent"))


@query("compression_report")
def compression_report(spark, sf):
    # rows-only in the oracle (no gzip in SQL); tests check the round trip
    return Z.compression_report(t(spark, sf, "documents"), ["text"])
