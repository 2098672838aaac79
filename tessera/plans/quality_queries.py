"""Queries for quality rules, row filters and masking (L1-L6) over ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as L
from tessera.plans.registry import query
from tessera.plans.relational_queries import t

_EMAIL_SQL = ("CASE WHEN c_acctbal < 0 THEN lower(replace(c_name, '#', '.')) || 'example.com' "
              "ELSE lower(replace(c_name, '#', '.')) || '@example.com' END")
_TAXID_SQL = ("lpad(CAST(c_custkey AS VARCHAR), 8, '0') || CASE WHEN c_acctbal >= 0 "
              f"THEN substr('{L.TAX_ID_LETTERS}', CAST(c_custkey % 23 AS INTEGER) + 1, 1) ELSE 'A' END")
_EMAIL_RE = L.EMAIL_PATTERN


def _email(c):
    base = F.lower(F.replace("c_name", F.lit("#"), F.lit(".")))
    return F.when(F.col("c_acctbal") < 0, F.concat(base, F.lit("example.com"))).otherwise(
        F.concat(base, F.lit("@example.com")))


def _tax_id():
    letter = F.substring(F.lit(L.TAX_ID_LETTERS), (F.col("c_custkey") % 23 + 1).cast("int"), 1)
    return F.concat(F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
                    F.when(F.col("c_acctbal") >= 0, letter).otherwise(F.lit("A")))


@query("rule_report", f"""
SELECT 'required:c_name' AS rule, CAST(SUM(CASE WHEN c_name IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM customer
UNION ALL SELECT 'max_length:c_name', CAST(SUM(CASE WHEN length(c_name) > 17 THEN 1 ELSE 0 END) AS BIGINT) FROM customer
UNION ALL SELECT 'check:acctbal_not_negative', CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) FROM customer
UNION ALL SELECT 'check:email', CAST(SUM(CASE WHEN NOT regexp_full_match({_EMAIL_SQL}, '{_EMAIL_RE}') THEN 1 ELSE 0 END) AS BIGINT) FROM customer
UNION ALL SELECT 'unique:c_custkey', CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_custkey HAVING COUNT(*) > 1)
UNION ALL SELECT 'unique:c_nationkey,c_mktsegment', CAST(coalesce(SUM(n), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment HAVING COUNT(*) > 1)
UNION ALL SELECT 'foreign_key:c_nationkey', COUNT(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'foreign_key:o_custkey', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'json:props', CAST(SUM(CASE WHEN json_valid(props) AND json_type(props) IN ('OBJECT', 'ARRAY') THEN 0 ELSE 1 END) AS BIGINT) FROM events
UNION ALL SELECT 'json:text', CAST(SUM(CASE WHEN json_valid(text) AND json_type(text) IN ('OBJECT', 'ARRAY') THEN 0 ELSE 1 END) AS BIGINT) FROM benchmark
""")
def rule_report(spark, sf):
    c, n, o = t(spark, sf, "customer"), t(spark, sf, "nation"), t(spark, sf, "orders")
    report = L.rule_report(c, [
        L.Required("c_name"), L.MaxLength("c_name", 17),
        L.Check("acctbal_not_negative", F.col("c_acctbal") >= 0),
        L.Check("email", L.email_ok(_email(c))),
        L.Unique(("c_custkey",)), L.Unique(("c_nationkey", "c_mktsegment")),
        L.ForeignKey("c_nationkey", n, "n_nationkey")])
    orders = L.rule_report(o, [L.ForeignKey("o_custkey", c, "c_custkey")])
    events = L.rule_report(t(spark, sf, "events"), [L.ValidJson("props")])
    bench = L.rule_report(t(spark, sf, "benchmark"), [L.ValidJson("text")])
    return report.unionByName(orders).unionByName(events).unionByName(bench)


@query("tax_id_rule", f"""
SELECT c_custkey, {_TAXID_SQL} AS tax_id,
  regexp_full_match(upper({_TAXID_SQL}), '^\\d{{2,8}}[A-Z]$')
  AND right(upper({_TAXID_SQL}), 1) = substr('{L.TAX_ID_LETTERS}',
        CAST(CAST(regexp_extract(upper({_TAXID_SQL}), '^(\\d{{2,8}})', 1) AS BIGINT) % 23 AS INTEGER) + 1, 1) AS valid
FROM customer
""")
def tax_id_rule(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", _tax_id().alias("tax_id"))
    return c.select("c_custkey", "tax_id", L.tax_id_ok("tax_id").alias("valid"))


@query("email_rule", f"""
SELECT c_custkey, {_EMAIL_SQL} AS email, regexp_full_match({_EMAIL_SQL}, '{_EMAIL_RE}') AS valid FROM customer
""")
def email_rule(spark, sf):
    c = t(spark, sf, "customer")
    return c.select("c_custkey", _email(c).alias("email")).select(
        "c_custkey", "email", L.email_ok("email").alias("valid"))


@query("row_filter", """
SELECT event_id, 'user' || CAST(user_id AS VARCHAR) AS owner, event_type FROM events
WHERE 'user' || CAST(user_id AS VARCHAR) = (SELECT 'user' || CAST(user_id AS VARCHAR) FROM events
                                            ORDER BY ts DESC, event_id DESC LIMIT 1)
""")
def row_filter(spark, sf):
    e = t(spark, sf, "events").withColumn("owner", F.concat(F.lit("user"), F.col("user_id").cast("string")))
    # the principal is the owner of the latest row (the login of the last writer)
    principal = e.agg(F.max_by("owner", F.struct("ts", "event_id")).alias("p")).first()["p"]
    return L.owned_rows(e, "owner", principal).select("event_id", "owner", "event_type")


@query("row_filter_login", """
SELECT event_id, event_type, true AS mine FROM events WHERE user_id % 3 = 0
""")
def row_filter_login(spark, sf):
    # a third of the rows belongs to the login of the session, which the filter names by itself
    e = t(spark, sf, "events").withColumn("owner", F.when(F.col("user_id") % 3 == 0, L.current_login()).otherwise(F.concat(F.lit("not "), L.current_login())))
    return L.owned_rows(e, "owner").select("event_id", "event_type", (F.col("owner") == L.current_login()).alias("mine"))


@query("masked_view", """
SELECT c_custkey,
  regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name,
  regexp_replace(lower(replace(c_name, '#', '.')) || '@example.com', '^(.)[^@]*(@.*)$', '\\1***\\2') AS email,
  'XXXX-XXXX-XXXX-' || right(lpad(CAST(c_custkey * 7919 AS VARCHAR), 16, '0'), 4) AS card,
  CAST(0 AS DOUBLE) AS c_acctbal,
  CAST(DATE '1900-01-01' AS VARCHAR) AS birthday,
  c_mktsegment
FROM customer
""")
def masked_view(spark, sf):
    c = t(spark, sf, "customer").select(
        "c_custkey", "c_name",
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.lpad((F.col("c_custkey") * 7919).cast("string"), 16, "0").alias("card"),
        "c_acctbal", F.lit("1990-05-17").cast("date").alias("birthday"), "c_mktsegment")
    masked = L.masked_view(c, {"c_name": "text", "email": "email", "card": "card",
                               "c_acctbal": "number", "birthday": "date"})
    return masked.withColumn("birthday", F.col("birthday").cast("string"))


@query("gate_rejected", f"""
SELECT c_custkey, concat_ws(',',
    CASE WHEN c_acctbal < 0 THEN 'check:acctbal_not_negative' END,
    CASE WHEN NOT regexp_full_match({_EMAIL_SQL}, '{_EMAIL_RE}') THEN 'check:email' END) AS broken_rules
FROM customer
WHERE c_acctbal < 0 OR NOT regexp_full_match({_EMAIL_SQL}, '{_EMAIL_RE}')
""")
def gate_rejected(spark, sf):
    c = t(spark, sf, "customer")
    _good, rejected = L.gate(c, [L.Required("c_name"),
                                 L.Check("acctbal_not_negative", F.col("c_acctbal") >= 0),
                                 L.Check("email", L.email_ok(_email(c)))])
    return rejected.select("c_custkey", F.array_join("broken_rules", ",").alias("broken_rules"))
