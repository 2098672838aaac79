"""System-versioned history.

A history row is valid over ``[valid_from, valid_to)``; the current version
is valid to the end of time. Successor times come from LEAD over the key, and
as-of lookups for many points at once are a merge of probes into the version
stream plus a forward fill - never a join that pairs every probe with every
version of its key. ``group_shift`` does both in windows that a hot key cannot
overfill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import group_shift

# Fixed value: the open end of a period (microsecond precision).
END_OF_TIME = "9999-12-31 23:59:59.999999"


def end_of_time(dtype) -> F.Column:
    return F.lit(END_OF_TIME).cast(dtype)


def build_history(versions: DataFrame, key: str, ts: str, tie: str,
                  valid_from: str = "valid_from", valid_to: str = "valid_to",
                  partitions: int | None = None) -> DataFrame:
    """Each version is valid from its time to the next version's time;
    the last one to the end of time. Ties in time are ordered by ``tie``;
    zero-length periods are dropped."""
    dtype = versions.schema[ts].dataType
    led = group_shift(versions, [key], [ts, tie], [ts], ["_next"], mode="lead", partitions=partitions)
    out = (led.withColumn(valid_from, F.col(ts))
           .withColumn(valid_to, F.coalesce(F.col("_next"), end_of_time(dtype)))
           .drop("_next"))
    return out.where(F.col(valid_from) < F.col(valid_to))


def as_of(history: DataFrame, t, valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """``FOR SYSTEM_TIME AS OF t``: ``valid_from <= t < valid_to``."""
    tt = F.lit(t).cast(history.schema[valid_from].dataType)
    return history.where((F.col(valid_from) <= tt) & (tt < F.col(valid_to)))


def versions_as_of(versions: DataFrame, key: str, ts: str, tie: str, t, valid_from: str = "valid_from",
                   valid_to: str = "valid_to") -> DataFrame:
    """T3 on the log of versions, without building its history: of each key the
    last version up to ``t`` and the time of the first after it, found by
    partial aggregates. Equal to ``as_of(build_history(versions, ..), t)``;
    NULL keys are one key, versions without a time are none."""
    at = F.lit(t).cast(versions.schema[ts].dataType)
    others = [c for c in versions.columns if c != key]
    last = versions.where(F.col(ts) <= at).groupBy(key).agg(F.max_by(F.struct(*others), F.struct(ts, tie)).alias("_v"))
    after = versions.where(F.col(ts) > at).groupBy(F.col(key).alias("_k")).agg(F.min(ts).alias("_next"))
    joined = last.join(after, F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(*[F.col(c) if c == key else F.col("_v")[c].alias(c) for c in versions.columns],
                         F.col("_v")[ts].alias(valid_from), F.coalesce("_next", end_of_time(versions.schema[ts].dataType)).alias(valid_to))


def between(history: DataFrame, a, b, valid_from: str = "valid_from",
            valid_to: str = "valid_to") -> DataFrame:
    """T4: ``FOR SYSTEM_TIME BETWEEN a AND b``: ``valid_from <= b`` and
    ``valid_to > a``."""
    dt = history.schema[valid_from].dataType
    return history.where((F.col(valid_from) <= F.lit(b).cast(dt)) & (F.col(valid_to) > F.lit(a).cast(dt)))


def key_history(history: DataFrame, key: str, value, valid_from: str = "valid_from") -> DataFrame:
    """T5: the versions of one key in time order."""
    return history.where(F.col(key) == F.lit(value)).orderBy(valid_from)


def backfill(df: DataFrame, valid_from: str, source: str) -> DataFrame:
    """Set the period start from another column (``ValidFrom = ModifiedDate``)."""
    return df.withColumn(valid_from, F.col(source))


def as_of_join(probes: DataFrame, history: DataFrame, key: str, t: str, columns: Sequence[str],
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               partitions: int | None = None) -> DataFrame:
    """T3 for many points: each probe row (key, t) gets the version valid at
    ``t``. Versions and probes are merged in (key, time) order - versions
    first at equal times, since ``valid_from <= t`` - and the version's period is
    forward-filled; its columns are then looked up by key and period start. A
    probe outside every period gets NULLs. Zero-length periods, which
    ``build_history`` drops, are not allowed."""
    dt = probes.schema[t].dataType
    pcols = [c for c in probes.columns if c != key]
    # only the versions of keys that are probed take part in the merge
    history = history.join(probes.select(F.col(key).alias("_pk")).distinct(),
                           F.col(key) == F.col("_pk"), "left_semi")
    hv = history.select(
        F.col(key), F.col(valid_from).cast(dt).alias("_t"), F.lit(0).alias("_kind"),
        *[F.lit(None).cast(probes.schema[c].dataType).alias(f"_p_{c}") for c in pcols],
        F.col(valid_to).cast(dt).alias("_to"), F.col(valid_from).cast(dt).alias("_from"))
    pr = probes.select(
        F.col(key), F.col(t).alias("_t"), F.lit(1).alias("_kind"),
        *[F.col(c).alias(f"_p_{c}") for c in pcols], F.lit(None).cast(dt).alias("_to"), F.lit(None).cast(dt).alias("_from"))
    merged = hv.unionByName(pr)
    order = ["_t", "_kind", *[f"_p_{c}" for c in pcols]]
    filled = group_shift(merged, [key], order, ["_to", "_from"], ["_f_to", "_f_from"], mode="ffill", partitions=partitions)
    hit = filled.where(F.col("_kind") == 1).withColumn("_at", F.when(F.col("_t") < F.col("_f_to"), F.col("_f_from")))
    # periods of one key do not overlap, so key and period start name the version; its columns,
    # NULLs included, come from that version as a whole
    versions = history.select(F.col(key).alias("_vk"), F.col(valid_from).cast(dt).alias("_vf"), *[F.col(c).alias(f"_h_{c}") for c in columns])
    return (hit.join(versions, (F.col(key) == F.col("_vk")) & (F.col("_at") == F.col("_vf")), "left")
            .select(F.col(key), *[F.col(f"_p_{c}").alias(c) for c in pcols], *[F.col(f"_h_{c}").alias(c) for c in columns]))


def apply_versions(history: DataFrame, new_rows: DataFrame, key: str, ts: str, tie: str,
                   valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Add new versions to a history. The versions of each touched key,
    stored and new, get their periods anew, so rows that arrive late fall into
    their place; keys without new rows are not rebuilt; the NULL key is a key.
    Equal to rebuilding the history from the whole log."""
    touched = new_rows.select(F.col(key).alias("_k")).distinct()
    of_touched = F.col(key).eqNullSafe(F.col("_k"))
    log = [c for c in history.columns if c not in (valid_from, valid_to)]
    old = history.join(touched, of_touched, "left_semi").select(*log)
    rest = history.join(touched, of_touched, "left_anti")
    rebuilt = build_history(old.unionByName(new_rows.select(*log)), key, ts, tie, valid_from, valid_to)
    return rest.unionByName(rebuilt.select(*history.columns))
