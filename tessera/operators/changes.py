"""Change data (I1-I11): high-water marks, change feeds with column masks,
net changes, commit ranges, audit and retention.

A change log is a DataFrame with a key, a growing version (commit id), an
operation code ``I`` / ``U`` / ``D`` and the tracked columns after the change.
Per-key reductions use ``min_by`` / ``max_by`` aggregates, which combine
map-side, so a key with a third of all changes is never one task's problem.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import group_shift

# Capture operation codes (delete, insert, before update, after update).
CDC_DELETE, CDC_INSERT, CDC_BEFORE, CDC_AFTER = 1, 2, 3, 4


def since_version(df: DataFrame, version_col: str, last) -> tuple[DataFrame, object]:
    """Rows changed after ``last`` and the new high-water mark."""
    rows = df.where(F.col(version_col) > F.lit(last))
    new_last = rows.agg(F.max(version_col)).first()[0]
    return rows, (new_last if new_last is not None else last)


def change_mask(before: Sequence[Column], after: Sequence[Column]) -> Column:
    """Bit ``i`` set when column ``i`` differs (NULL-aware)."""
    bits = [F.when(~b.eqNullSafe(a), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, (b, a) in enumerate(zip(before, after))]
    total = bits[0]
    for b in bits[1:]:
        total = total + b
    return total


def in_mask(mask: str | Column, ordinal: int) -> Column:
    """``CHANGE_TRACKING_IS_COLUMN_IN_MASK`` for a 0-based column ordinal."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return m.bitwiseAND(F.lit(1 << ordinal)) != 0


def mask_names(mask: str | Column, names: Sequence[str]) -> Column:
    """The changed-column set as an array of names."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return F.filter(F.array(*[F.when(m.bitwiseAND(F.lit(1 << i)) != 0, F.lit(n))
                              for i, n in enumerate(names)]), lambda x: x.isNotNull())


def all_bits(n: int) -> Column:
    return F.lit((1 << n) - 1).cast("long")


def _range(log: DataFrame, version: str, lo=None, hi=None, lo_inclusive=False) -> DataFrame:
    out = log
    if lo is not None:
        out = out.where(F.col(version) >= F.lit(lo) if lo_inclusive else F.col(version) > F.lit(lo))
    if hi is not None:
        out = out.where(F.col(version) <= F.lit(hi))
    return out


def _per_key(rows: DataFrame, key: str, version: str, op: str, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(key).agg(
        F.min_by(op, version).alias("_first_op"), F.max_by(op, version).alias("_last_op"),
        F.max(version).alias("_version"),
        F.max_by(F.struct(*columns), version).alias("_last"))


def current_state(log: DataFrame, key: str, version: str, op: str,
                  columns: Sequence[str], upto=None) -> DataFrame:
    """The table the log describes (at ``upto`` if given): last row per key,
    keys whose last change is a delete are absent."""
    last = _per_key(_range(log, version, hi=upto), key, version, op, columns)
    return last.where(F.col("_last_op") != "D").select(
        key, *[F.col("_last")[c].alias(c) for c in columns], F.col("_version").alias(version))


def _collapse(first_op: Column, last_op: Column) -> Column:
    # Collapse rule (chosen, documented): last D -> D; first I -> I; else U.
    return (F.when(last_op == "D", "D").when(first_op == "I", "I").otherwise("U"))


class VersionTooOld(ValueError):
    """The requested start is older than the oldest change still kept: the
    reader must reload the whole table instead."""


def changes_since(log: DataFrame, key: str, version: str, op: str, columns: Sequence[str],
                  since, min_valid_version=None, track_columns: bool = True) -> DataFrame:
    """I2 (log form): ``CHANGETABLE(CHANGES t, since)``: one net row per key
    changed after ``since``: version, operation and, for updates, the mask of
    columns that differ from the key's state at ``since``. With
    ``min_valid_version`` (I10) a start older than the retained log is
    refused rather than answered from partial history. Without
    ``track_columns`` (I11) there is no mask: ``CT_Columns`` is NULL, as where
    the table was tracked with the switch off, and the log before ``since`` is
    not read."""
    if min_valid_version is not None and since is not None and since < min_valid_version - 1:
        raise VersionTooOld(f"version {since} is older than the oldest retained change {min_valid_version}")
    after = _per_key(_range(log, version, lo=since), key, version, op, columns)
    # only the history of keys changed after `since` is reduced and shuffled
    touched = _range(log, version, lo=since).select(F.col(key).alias("_tk")).distinct()
    if not track_columns:
        return after.select(F.col("_version").alias("CT_Version"), _collapse(F.col("_first_op"), F.col("_last_op")).alias("CT_Operation"),
                            F.lit(None).cast("long").alias("CT_Columns"), F.col(key))
    earlier = _range(log, version, hi=since).join(touched, F.col(key) == F.col("_tk"), "left_semi")
    before = _per_key(earlier, key, version, op, columns).select(
        F.col(key).alias("_bk"), F.col("_last").alias("_before"), F.col("_last_op").alias("_bop"))
    j = after.join(before, F.col(key) == F.col("_bk"), "left")
    operation = _collapse(F.col("_first_op"), F.col("_last_op"))
    mask = change_mask([F.col("_before")[c] for c in columns], [F.col("_last")[c] for c in columns])
    return j.select(F.col("_version").alias("CT_Version"), operation.alias("CT_Operation"),
                    F.when(operation == "U", mask).alias("CT_Columns"), F.col(key))


def snapshot_diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """I2 (snapshot form): compare two versions of a table by key. One full
    outer join; unchanged keys produce no row."""
    b = before.select(F.col(key).alias("_bk"), *[F.col(c).alias(f"_b_{c}") for c in columns])
    a = after.select(F.col(key).alias("_ak"), *[F.col(c).alias(f"_a_{c}") for c in columns])
    j = b.join(a, F.col("_bk") == F.col("_ak"), "full_outer")
    mask = change_mask([F.col(f"_b_{c}") for c in columns], [F.col(f"_a_{c}") for c in columns])
    operation = (F.when(F.col("_bk").isNull(), "I").when(F.col("_ak").isNull(), "D")
                 .when(mask != 0, "U"))
    return j.select(F.coalesce("_ak", "_bk").alias(key), operation.alias("operation"),
                    F.when(operation == "U", mask).alias("mask")).where(F.col("operation").isNotNull())


def changes_current(changes: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """I4: net changes joined to the current rows, deletes removed (what a
    cache refresh needs)."""
    return (changes.where(F.col("CT_Operation") != "D")
            .join(current, key, "left"))


def change_feed(changes: DataFrame, current: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The change feed as a table: version, operation, mask, the key
    (from the feed when the row is gone) and the current payload (NULL for
    deleted rows)."""
    cur = current.select(F.col(key).alias("_ck"), *columns)
    j = changes.join(cur, F.col(key) == F.col("_ck"), "left")
    return j.select("CT_Version", "CT_Operation", "CT_Columns",
                    F.coalesce("_ck", key).alias(key), *columns)


def all_changes(log: DataFrame, key: str, version: str, op: str, columns: Sequence[str],
                lo, hi, with_before: bool = False) -> DataFrame:
    """Every change with ``lo <= version <= hi``: operation code 1 delete,
    2 insert, 4 after update (and 3, the before image, with ``with_before``)
    and the update mask against the key's previous row.

    Only the requested range goes through the ordered (distributed LAG)
    pass; the row before a key's first change in the range comes from one
    map-side ``max_by`` aggregate over the earlier log."""
    rows = _range(log, version, lo=lo, hi=hi, lo_inclusive=True).select(key, version, op, *columns)
    touched = rows.select(F.col(key).alias("_tk")).distinct()
    earlier = (_range(log, version).where(F.col(version) < F.lit(lo))
               .join(touched, F.col(key) == F.col("_tk"), "left_semi")
               .groupBy(F.col(key).alias("_ek"))
               .agg(F.max_by(F.struct(*columns), version).alias("_e")))
    prev = group_shift(rows, [key], [version], [version, *columns],
                       ["_p_version", *[f"_l_{c}" for c in columns]], "lag")
    prev = prev.join(earlier, F.col(key) == F.col("_ek"), "left")
    first = F.col("_p_version").isNull()
    prev = prev.select(key, version, op, *columns, *[
        F.when(first, F.col("_e")[c]).otherwise(F.col(f"_l_{c}")).alias(f"_p_{c}") for c in columns])
    code = (F.when(F.col(op) == "D", CDC_DELETE).when(F.col(op) == "I", CDC_INSERT)
            .otherwise(CDC_AFTER))
    mask = F.when(F.col(op) == "U", change_mask([F.col(f"_p_{c}") for c in columns],
                                                 [F.col(c) for c in columns])
                  ).otherwise(all_bits(len(columns)))
    out = prev.select(F.col(version).alias("commit_id"), code.alias("operation"),
                      mask.alias("update_mask"), key, *columns)
    if with_before:
        before = prev.where(F.col(op) == "U").select(
            F.col(version).alias("commit_id"), F.lit(CDC_BEFORE).alias("operation"),
            mask.alias("update_mask"), key, *[F.col(f"_p_{c}").alias(c) for c in columns])
        out = out.unionByName(before)
    return out


def net_changes(log: DataFrame, key: str, version: str, op: str, columns: Sequence[str],
                lo, hi) -> DataFrame:
    """One row per key changed in ``[lo, hi]`` with its last state.
    Inserted-then-deleted keys vanish; last delete -> 1, first insert -> 2,
    otherwise 4."""
    per = _per_key(_range(log, version, lo=lo, hi=hi, lo_inclusive=True), key, version, op, columns)
    keep = per.where(~((F.col("_first_op") == "I") & (F.col("_last_op") == "D")))
    code = (F.when(F.col("_last_op") == "D", CDC_DELETE).when(F.col("_first_op") == "I", CDC_INSERT)
            .otherwise(CDC_AFTER))
    return keep.select(F.col("_version").alias("commit_id"), code.alias("operation"), key,
                       *[F.col("_last")[c].alias(c) for c in columns])


def commit_range(commits: DataFrame, id_col: str, ts_col: str, t1, t2) -> DataFrame:
    """I8: time range to commit range: smallest commit at or after ``t1``,
    largest at or before ``t2``. One aggregate pass."""
    ts = F.col(ts_col)
    return commits.agg(
        F.min(F.when(ts >= F.lit(t1).cast(commits.schema[ts_col].dataType), F.col(id_col))).alias("from_commit"),
        F.max(F.when(ts <= F.lit(t2).cast(commits.schema[ts_col].dataType), F.col(id_col))).alias("to_commit"))


def change_audit(changes: DataFrame, commits: DataFrame, id_col: str = "commit_id") -> DataFrame:
    """Who committed each change: an equi-join on the commit id (the
    script's cross join with the whole transaction log is not repeated)."""
    return changes.join(commits, id_col, "inner")


def retain(log: DataFrame, ts_col: str, days: int, now) -> DataFrame:
    """Drop changes older than the retention period."""
    limit = F.lit(now).cast(log.schema[ts_col].dataType) - F.expr(f"INTERVAL {int(days)} DAYS")
    return log.where(F.col(ts_col) >= limit)


def version_bounds(log: DataFrame, version: str) -> DataFrame:
    """Oldest usable and current version."""
    return log.agg(F.min(version).alias("min_valid_version"), F.max(version).alias("current_version"))
