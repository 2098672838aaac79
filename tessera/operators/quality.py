"""Quality rules, write gates, row filters and masking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spanish tax-id check letters, indexed by number mod 23.
TAX_ID_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
TAX_ID_PATTERN = r"^\d{2,8}[A-Z]$"
# Fixed value: the reference's e-mail pattern.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tax_id_ok(col: str | Column) -> Column:
    """L2: NULL is valid; otherwise upper-cased text must be 2-8 digits and
    a letter, and the letter must match the number mod 23."""
    v = F.upper(_c(col))
    digits = F.regexp_extract(v, r"^(\d{2,8})", 1)
    letter = F.substring(F.lit(TAX_ID_LETTERS), (digits.cast("long") % 23 + 1).cast("int"), 1)
    shape = v.rlike(TAX_ID_PATTERN)
    return F.when(v.isNull(), True).when(~shape, False).otherwise(F.substring(v, -1, 1) == letter)


def email_ok(col: str | Column) -> Column:
    """L3: NULL is valid; otherwise the e-mail pattern must match."""
    v = _c(col)
    return F.when(v.isNull(), True).otherwise(v.rlike(EMAIL_PATTERN))


@dataclass(frozen=True)
class Required:
    column: str


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int


@dataclass(frozen=True)
class Check:
    name: str
    ok: Column  # row-level condition; NULL counts as passing (as a CHECK does)


@dataclass(frozen=True)
class ValidJson:
    column: str
    kind: str | None = None  # None: object or array; "ARRAY" / "OBJECT": that kind only


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    ref: DataFrame
    ref_column: str


def _row_rule(rule) -> tuple[str, Column] | None:
    if isinstance(rule, Required):
        return f"required:{rule.column}", F.col(rule.column).isNotNull()
    if isinstance(rule, MaxLength):
        return (f"max_length:{rule.column}",
                F.coalesce(F.length(F.col(rule.column)) <= rule.length, F.lit(True)))
    if isinstance(rule, Check):
        return f"check:{rule.name}", F.coalesce(rule.ok, F.lit(True))
    if isinstance(rule, ValidJson):
        from tessera.functions.jsonfn import is_json

        # NULL passes, as it passes a CHECK (ISJSON(x) > 0) constraint
        return f"json:{rule.column}", F.coalesce(is_json(rule.column, rule.kind) == 1, F.lit(True))
    return None


def rule_report(df: DataFrame, rules: Sequence) -> DataFrame:
    """L1: violations per rule. Row rules are counted in one aggregate pass;
    a unique key by a group count; a foreign key by a left anti join."""
    spark = df.sparkSession
    parts: list[DataFrame] = []
    row_rules = [r for r in (_row_rule(x) for x in rules) if r is not None]
    if row_rules:
        agg = df.agg(*[F.sum(F.when(~ok, 1).otherwise(0)).cast("long").alias(f"_{i}")
                       for i, (_, ok) in enumerate(row_rules)])
        stack = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations"))
                                    for i, (name, _) in enumerate(row_rules)]))
        parts.append(agg.select(stack.alias("_r")).select("_r.rule", "_r.violations"))
    for rule in rules:
        if isinstance(rule, Unique):
            cols = list(rule.columns)
            dup = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                   .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations")))
            parts.append(dup.select(F.lit("unique:" + ",".join(cols)).alias("rule"), "violations"))
        elif isinstance(rule, ForeignKey):
            ref = rule.ref.select(F.col(rule.ref_column).alias("_ref")).distinct()
            orphan = (df.where(F.col(rule.column).isNotNull())
                      .join(ref, F.col(rule.column) == F.col("_ref"), "left_anti")
                      .agg(F.count(F.lit(1)).cast("long").alias("violations")))
            parts.append(orphan.select(F.lit(f"foreign_key:{rule.column}").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gate(df: DataFrame, rules: Sequence, table: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """L4: split a batch into rows that pass every rule and rows that break
    one (with the names of the broken rules). A unique key is checked within
    the batch, where all rows of a repeated key are rejected, and against
    ``table`` if given; a foreign key against its reference (NULL passes).
    A rule of an unknown kind is an error."""
    tagged, flags = df, []
    for i, rule in enumerate(rules):
        row = _row_rule(rule)
        if row is not None:
            flags.append(F.when(~row[1], F.lit(row[0])))
        elif isinstance(rule, Unique):
            cols = list(rule.columns)
            seen = df.select(*cols, F.lit(1).alias("_mine"))
            if table is not None:
                seen = seen.unionByName(table.select(*cols, F.lit(0).alias("_mine")))
            dup = (seen.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.sum("_mine").alias("_m")).where("_n > 1 AND _m > 0")
                   .select(*[F.col(c).alias(f"_u{i}_{c}") for c in cols], F.lit(True).alias(f"_bad{i}")))
            same = [F.col(c).eqNullSafe(F.col(f"_u{i}_{c}")) for c in cols]
            on = same[0]
            for x in same[1:]:
                on = on & x
            tagged = tagged.join(dup, on, "left").drop(*[f"_u{i}_{c}" for c in cols])
            flags.append(F.when(F.col(f"_bad{i}"), F.lit("unique:" + ",".join(cols))))
        elif isinstance(rule, ForeignKey):
            ref = rule.ref.select(F.col(rule.ref_column).alias(f"_ref{i}")).distinct()
            tagged = tagged.join(ref, F.col(rule.column) == F.col(f"_ref{i}"), "left")
            flags.append(F.when(F.col(rule.column).isNotNull() & F.col(f"_ref{i}").isNull(), F.lit(f"foreign_key:{rule.column}")))
        else:
            raise TypeError(f"no such rule: {rule!r}")
    broken = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    tagged = tagged.withColumn("_broken", broken).select(*df.columns, "_broken")
    good = tagged.where(F.size("_broken") == 0).drop("_broken")
    rejected = tagged.where(F.size("_broken") > 0).withColumnRenamed("_broken", "broken_rules")
    return good, rejected


def current_login() -> Column:
    """The login the session runs as (``SUSER_SNAME()``), evaluated when the query runs."""
    return F.current_user()


def owned_rows(df: DataFrame, owner_col: str, principal: str | Column | None = None) -> DataFrame:
    """Rows visible to a principal: the owner column equals the login (the
    session's own by default)."""
    p = current_login() if principal is None else principal if isinstance(principal, Column) else F.lit(principal)
    return df.where(F.col(owner_col) == p)


# Masking rules (chosen; the reference does not spell them out).
def mask_text(col: str | Column) -> Column:
    return F.mask(_c(col))


def mask_email(col: str | Column) -> Column:
    """Keep the first letter and the domain: ``k***@example.com``."""
    v = _c(col)
    return F.regexp_replace(v, r"^(.)[^@]*(@.*)$", "$1***$2")


def mask_card(col: str | Column) -> Column:
    """Keep the last four characters."""
    v = _c(col)
    return F.concat(F.lit("XXXX-XXXX-XXXX-"), F.substring(v, -4, 4))


def masked_view(df: DataFrame, rules: Mapping[str, str], privileged: bool = False) -> DataFrame:
    """The table with personal columns masked unless the reader is
    privileged. ``rules`` maps a column to ``text``, ``email``, ``card``,
    ``number`` (-> 0) or ``date`` (-> 1900-01-01)."""
    if privileged:
        return df
    out = []
    for f in df.schema.fields:
        kind = rules.get(f.name)
        c = F.col(f.name)
        if kind == "text":
            c = mask_text(c)
        elif kind == "email":
            c = mask_email(c)
        elif kind == "card":
            c = mask_card(c)
        elif kind == "number":
            c = F.lit(0).cast(f.dataType)
        elif kind == "date":
            c = F.lit("1900-01-01").cast(f.dataType if not isinstance(f.dataType, T.StringType)
                                         else T.DateType())
        out.append(c.alias(f.name))
    return df.select(*out)
