"""Table edits as DataFrame rewrites (K1-K7).

DataFrames are immutable: an UPDATE / DELETE / upsert returns the new table,
and the caller writes it to a new location (then switches the path), which is
what makes the rewrite atomic on Parquet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pred(p: Column) -> Column:
    # A NULL predicate does not select the row (three-valued logic).
    return F.coalesce(p, F.lit(False))


def update_where(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """K1: ``UPDATE t SET c = expr WHERE predicate``. Every expression sees
    the old row (all assignments are evaluated in one projection)."""
    hit = _pred(predicate)
    return df.select(*[
        (F.when(hit, assignments[c]).otherwise(F.col(c)) if c in assignments else F.col(c)).alias(c)
        for c in df.columns])


def update_from(df: DataFrame, source: DataFrame, key: str, source_key: str,
                assignments: Mapping[str, Column]) -> DataFrame:
    """K2: ``UPDATE t SET c = (correlated query)``: one left join to the
    pre-aggregated source; a row with no match gets NULL, as the scalar
    subquery yields NULL."""
    src = source.withColumnRenamed(source_key, "_src_key")
    j = df.join(src, F.col(key) == F.col("_src_key"), "left")
    return j.select(*[(assignments[c] if c in assignments else F.col(c)).alias(c) for c in df.columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """K3: ``DELETE FROM t WHERE predicate``."""
    return df.where(~_pred(predicate))


def upsert(df: DataFrame, rows: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """K4: insert or replace rows by key: the untouched rows (left anti join)
    plus the new rows. Two new rows for one key, and a NULL key, are errors;
    the plan itself finds them when it runs."""
    keys = [key] if isinstance(key, str) else list(key)
    new = _one_row_a_key(rows.select(*df.columns), keys)
    kept = df.join(new.select(*keys), keys, "left_anti")
    return kept.select(*df.columns).unionByName(new)


def _one_row_a_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``, or an error at run time if a key has several rows or is NULL."""
    others = [c for c in rows.columns if c not in keys]
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *others)).alias("_row"))
    shown = F.to_json(F.struct(*keys))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    checked = (F.when(null_key, F.raise_error(F.concat(F.lit("upsert has a row with a NULL key: "), shown)).cast("boolean"))
               .when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("upsert has several rows for one key, such as "), shown)).cast("boolean"))
               .otherwise(True))
    return per_key.where(checked).select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in rows.columns])


def add_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """K5: ``ALTER TABLE .. ADD``."""
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """K5: ``DROP COLUMN IF EXISTS`` (absent names are ignored)."""
    return df.drop(*names)


def edit_conflicts(current: DataFrame, edits: DataFrame, key: str, version: str) -> DataFrame:
    """K6: optimistic concurrency: an edit whose read version no longer
    matches the stored version is a conflict; a vanished row is one too. Of
    several edits of one key at the stored version one is taken, the first in
    the order of all columns; the others are conflicts."""
    from pyspark.sql import Window

    cur = current.select(F.col(key).alias("_ck"), F.col(version).alias("_stored"))
    j = edits.join(cur, F.col(key) == F.col("_ck"), "left")
    status = F.when(F.col("_ck").isNull(), "gone").when(
        F.col("_stored") == F.col(version), "ok").otherwise("conflict")
    turn = F.row_number().over(Window.partitionBy(key, "_status").orderBy(*edits.columns))
    j = j.withColumn("_status", status).withColumn("_turn", turn)
    status = F.when((F.col("_status") == "ok") & (F.col("_turn") > 1), "conflict").otherwise(F.col("_status"))
    return j.select(*edits.columns, F.col("_stored").alias("stored_version"), status.alias("status"))


def three_way_merge(original: DataFrame, mine: DataFrame, stored: DataFrame, key: str,
                    columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """K7: per field, compare my value and the stored value with the
    original: changed only in the store -> take stored; changed only by me ->
    keep mine; both changed to different values -> conflict (my value stays
    in the merged row and the field is reported). A row that the store no
    longer has is not merged; it is reported once, as the field ``gone``.
    Returns (merged, conflicts)."""
    o = original.select(F.col(key).alias("_k"), F.lit(True).alias("_had"), *[F.col(c).alias(f"_o_{c}") for c in columns])
    m = mine.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_m_{c}") for c in columns])
    s = stored.select(F.col(key).alias("_k"), F.lit(True).alias("_has"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    j = m.join(o, "_k", "left").join(s, "_k", "left")
    merged_cols, conflict_flags = [], []
    for c in columns:
        mo, so, ms = (F.col(f"_m_{c}"), F.col(f"_o_{c}"), F.col(f"_s_{c}"))
        mine_changed = ~mo.eqNullSafe(so)
        store_changed = ~ms.eqNullSafe(so)
        value = F.when(store_changed & ~mine_changed, ms).otherwise(mo)
        merged_cols.append(value.alias(c))
        conflict_flags.append(F.when(mine_changed & store_changed & ~mo.eqNullSafe(ms), F.lit(c)))
    gone = F.col("_had").isNotNull() & F.col("_has").isNull()
    conflicts_arr = F.when(gone, F.array(F.lit("gone"))).otherwise(F.filter(F.array(*conflict_flags), lambda x: x.isNotNull()))
    out = j.select(F.col("_k").alias(key), *merged_cols, conflicts_arr.alias("_conflicts"), gone.alias("_gone"))
    merged = out.where(~F.col("_gone")).drop("_conflicts", "_gone")
    conflicts = out.where(F.size("_conflicts") > 0).select(
        key, F.explode("_conflicts").alias("field"))
    return merged, conflicts


def save_changes(current: DataFrame, edits: DataFrame, key: str, version: str,
                 rules: Sequence = (), whole_batch: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The write path in one step: rule gate (L4), then the version check
    (K6), then the rewrite (K4) of the rows that pass, each with its version
    moved on by one. ``edits`` carry every column of the table and, in
    ``version``, the version they were read at. With ``whole_batch`` one
    rejected row or conflict refuses the batch and the table stays as it is.
    Returns (new table, rejected rows with the rules they break, conflicting
    edits)."""
    from tessera.operators.quality import gate

    if rules:
        good, rejected = gate(edits, rules, current.join(edits.select(key).distinct(), key, "left_anti"))
    else:
        good, rejected = edits, edits.limit(0).withColumn("broken_rules", F.array().cast("array<string>"))
    checked = edit_conflicts(current, good, key, version)
    ok = (checked.where(F.col("status") == "ok").select(*current.columns)
          .withColumn(version, F.col(version) + 1))
    conflicts = checked.where(F.col("status") != "ok")
    if whole_batch and (rejected.limit(1).count() or conflicts.limit(1).count()):
        return current, rejected, conflicts
    return upsert(current, ok, key), rejected, conflicts
