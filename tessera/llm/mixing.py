"""Mixing sources to target weights by Pareto order sampling (DataFrame operations only).

Every source gets a word target. A document's expected number of copies is its
weight times its source's factor, at most ``max_repeat``; the whole part is
taken for certain and the rest is its inclusion probability ``p``. Documents
are ranked by ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` uniform from a hash
of the row, and the sample of fixed size is the head of that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_WORD, prepare, stored, unit_hash

#: weights of the sources in order of their names, repeating
DEFAULT_WEIGHTS = (5, 2, 1)


def word_count(text: str | Column) -> Column:
    """Runs of non-white-space; null text has none."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(col, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = DEFAULT_WEIGHTS, share: float = 1.0,
                   max_repeat: int = 3) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``.

    Sources by code point, null last, take ``weights`` in turn and share
    ``share`` of all words by weight. No target exceeds ``max_repeat`` times
    its source; what is above goes to the others by weight until none is above.
    That fixed point is ``min(weight * level, max_repeat * source_size)`` for one
    level, found by sorting the sources by the level at which they reach their
    limit. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = sizes.agg(F.sum("source_size").alias("total_words"))
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("long")
    limit = (F.lit(max_repeat) * F.col("source_size")).cast("long")
    rows = (sizes.withColumn("weight", w).withColumn("limit", limit).crossJoin(F.broadcast(total))
            .withColumn("full_at", F.col("limit").cast("double") / F.col("weight")))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    # level if exactly the sources before this one are at their limit
    rows = rows.withColumn("level", (F.col("total_words") * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
                           / F.sum("weight").over(after).cast("double"))
    level = rows.where("level <= full_at").agg(F.min_by("level", F.struct("full_at", "level")).alias("common"))
    return (rows.crossJoin(F.broadcast(level))
            .withColumn("target", F.when(F.col("common").isNull() | (F.col("full_at") <= F.col("common")), F.col("limit").cast("double"))
                        .otherwise(F.col("weight") * F.col("common")))
            .select("source", "source_size", "weight", "target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = DEFAULT_WEIGHTS, share: float = 1.0, max_repeat: int = 3,
        weight_col: str | None = None, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """Copies of every document in the mix.

    Returns ``id_col, *keep, size, source_size, target, copies, taken``, one row
    for each input row, ``taken = copies * size``. ``weight_col`` holds relative
    document weights (null or negative: 0); without it all weigh 1 and every
    word of a source has the same chance.

    Null text has size 0 and is never taken; null sources are one source; rows
    that repeat are ranked one after the other, so any number of them may be
    taken; equal ranks are broken by id and text hash. An empty table gives no
    rows. Columns of ``docs`` not named are dropped, so their names cannot
    clash; ``keep`` names may not be those of the result.

    A source's sample is the longest head of its Pareto order that fits in the
    words its whole copies leave open, then the one further document whose size
    comes nearest to the rest, if that brings the sum nearer. The order is
    never sorted as a whole: words are summed by source and bucket of the rank
    (about the square root of the row count in buckets), the buckets' running
    sum finds the one in which the words run out, and only that bucket's rows
    are sorted. Rows are spread by source and bucket, so a source holding most
    rows is no hot key.
    """
    spark = docs.sparkSession
    prepare(spark)
    weight = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    text = F.col(text_col).cast("string")
    base = docs.select(F.col(id_col), *[F.col(k) for k in keep], F.col(source_col).cast("string").alias("__source"),
                       word_count(text).alias("size"), weight.alias("__w"),
                       F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("__h"))
    base = base.withColumn("__u", unit_hash(F.col(id_col), F.col("__source"), F.col("__h"), seed=seed))
    rows, path = stored(base.select(id_col, *keep, "__source", "size", "__w", "__u", F.substring("__h", 1, 16).alias("__h")), "mix-rows")

    per = rows.groupBy("__source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = source_targets(per.select(F.col("__source").alias("source"), "source_size"), weights, share, max_repeat)
    targets = targets.select(F.col("source").alias("__source"), "source_size", "target")
    if weight_col is None:
        targets = targets.withColumn("__factor", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    else:
        targets = _factors(rows, targets, max_repeat)
    targets, tpath = stored(targets, "mix-targets")

    # expected copies, whole copies and what is left to chance
    same = rows["__source"].eqNullSafe(targets["__source"])
    r = rows.join(F.broadcast(targets) if _small(targets) else targets, same).drop(targets["__source"])
    e = F.least(F.col("__w") * F.col("__factor"), F.lit(float(max_repeat)))
    r = r.withColumn("__whole", F.floor(e)).withColumn("__p", e - F.floor(e))
    r = r.withColumn("__q", F.when((F.col("__p") > 0) & (F.col("size") > 0),
                                   (F.col("__u") / (1 - F.col("__u"))) / (F.col("__p") / (1 - F.col("__p")))))
    n = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]
    buckets = max(16, int(n ** 0.5))
    # the rank as a number in [0, 1): a monotone map of q, so buckets keep the order
    r = r.withColumn("__b", F.floor(F.col("__q") / (1 + F.col("__q")) * buckets).cast("long"))

    words = r.groupBy("__source", "__b").agg(
        F.sum(F.when(F.col("__b").isNotNull(), F.col("size"))).alias("words"), F.sum(F.col("__whole") * F.col("size")).alias("sure"),
        F.first("target").alias("target"))
    in_order = Window.partitionBy("__source").orderBy(F.col("__b").asc_nulls_first())
    words = (words.withColumn("open", F.col("target") - F.sum("sure").over(Window.partitionBy("__source")))
             .withColumn("upto", F.sum(F.coalesce("words", F.lit(0))).over(in_order))
             .where("__b IS NOT NULL"))
    edge = (words.where("upto > open").groupBy("__source")
            .agg(F.min("__b").alias("__edge"), F.min_by(F.col("upto") - F.col("words"), "__b").alias("__before"), F.first("open").alias("__open")))
    full = (words.groupBy("__source").agg(F.max("upto").alias("__all"), F.first("open").alias("__open_all")))
    cut = full.join(edge.withColumnRenamed("__source", "s2"), F.col("__source").eqNullSafe(F.col("s2")), "left").select(
        F.col("__source").alias("__s"), F.coalesce("__edge", F.lit(1 << 62)).alias("__edge"),
        F.coalesce("__before", "__all").alias("__before"), F.col("__open_all").alias("__open"))
    cut, cpath = stored(cut, "mix-cuts")
    joined = r.join(F.broadcast(cut) if _small(cut) else cut, F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")
    # rows of the bucket in which the words run out, in exact order
    order = Window.partitionBy("__source").orderBy("__q", id_col, "__h", "size")
    at_edge = (joined.where("__b = __edge").withColumn("__run", F.col("__before") + F.sum("size").over(
        order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__rn", F.row_number().over(order)))
    # the order of equal rows is free, yet each number is given once: a stored table fixes it
    at_edge, epath = stored(at_edge, "mix-edge")
    inside = joined.where("__b IS NULL OR __edge IS NULL OR __b <> __edge").withColumn(
        "__hit", F.coalesce((F.col("__b") < F.col("__edge")).cast("long"), F.lit(0).cast("long")))
    edged = at_edge.withColumn("__hit", (F.col("__run") <= F.col("__open")).cast("long"))
    cols = [id_col, *keep, "__source", "size", "source_size", "target", "__whole", "__q", "__h", "__hit", "__open", "__u"]
    chosen = inside.select(*cols, F.lit(0).alias("__rn")).union(edged.select(*cols, F.col("__rn")))
    # words still open, and the one document that comes nearest to them
    left = (edged.groupBy("__source").agg(F.max(F.struct("__open", "__before")).alias("x"),
                                          F.sum(F.col("__hit") * F.col("size")).alias("got"))
            .select(F.col("__source").alias("__s"), (F.col("x.__open") - F.col("x.__before") - F.col("got")).alias("__gap")))
    left, lpath = stored(left, "mix-left")
    cand = chosen.where("__q IS NOT NULL AND __hit = 0").join(
        F.broadcast(left) if _small(left) else left, F.col("__source").eqNullSafe(F.col("__s"))).where("size < 2 * __gap")
    key = F.struct(F.abs(F.col("size") - F.col("__gap")).alias("off"), F.col("__q").alias("q"), F.col(id_col).alias("i"),
                   F.col("__h").alias("h"), F.col("__rn").alias("rn"))
    extra = cand.groupBy("__s").agg(F.min(key).alias("k")).select(
        F.col("__s").alias("__x"), F.col("k.q").alias("xq"), F.col("k.i").alias("xi"), F.col("k.h").alias("xh"), F.col("k.rn").alias("xrn"))
    extra, xpath = stored(extra, "mix-extra")
    out = chosen.join(F.broadcast(extra) if _small(extra) else extra,
                      F.col("__source").eqNullSafe(F.col("__x")) & (F.col("__q") == F.col("xq")) & (F.col(id_col).eqNullSafe(F.col("xi")))
                      & (F.col("__h") == F.col("xh")) & (F.col("__rn") == F.col("xrn")), "left")
    # rows equal in every respect outside the sorted bucket would all match: give the copy to one of them
    same_rows = Window.partitionBy("__source", "__x", "__q", id_col, "__h").orderBy("__rn", "size")
    first = out.where("__x IS NOT NULL OR xq IS NOT NULL").withColumn("__one", (F.row_number().over(same_rows) == 1).cast("long"))
    rest = out.where("__x IS NULL AND xq IS NULL").withColumn("__one", F.lit(0).cast("long"))
    res = first.unionByName(rest)
    copies = (F.col("__whole") + F.col("__hit") + F.col("__one")).cast("long")
    return res.select(id_col, *keep, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _small(df: DataFrame, rows: int = 10_000) -> bool:
    """A stored per-source table may be broadcast only if it has this few rows."""
    return df.limit(rows + 1).count() <= rows


def _factors(rows: DataFrame, targets: DataFrame, max_repeat: int) -> DataFrame:
    """Per source the factor ``c`` with ``sum(size * min(c * w, max_repeat)) = target``.

    Each round sets aside the documents at the limit and shares the rest of the
    target among the others; the set at the limit only grows, and the loop ends
    when no source's factor moves.
    """
    cur = targets.withColumn("__factor", F.lit(0.0))
    for _ in range(1000):
        a, b = rows, cur.select(F.col("__source").alias("s"), "target", "__factor")
        j = a.join(b, a["__source"].eqNullSafe(b["s"]))
        at_limit = (F.col("__w") * F.col("__factor")) >= max_repeat
        agg = j.groupBy("s").agg(F.first("target").alias("t"), F.first("__factor").alias("was"),
                                 F.sum(F.when(at_limit, F.col("size") * max_repeat).otherwise(0)).alias("fixed"),
                                 F.sum(F.when(at_limit, 0.0).otherwise(F.col("size") * F.col("__w"))).alias("free"))
        new = F.when(F.col("free") > 0, F.greatest(F.col("was"), (F.col("t") - F.col("fixed")) / F.col("free"))).otherwise(F.col("was"))
        agg, _p = stored(agg.select("s", new.alias("__factor"), (F.abs(new - F.col("was")) > 1e-9 * F.greatest(new, F.lit(1e-300))).alias("moved")), "mix-factor")
        cur = targets.join(agg, targets["__source"].eqNullSafe(agg["s"]), "left").select(
            *[targets[c] for c in targets.columns], F.coalesce(agg["__factor"], F.lit(0.0)).alias("__factor"))
        if not agg.where("moved").limit(1).count():
            return cur
    raise RuntimeError("the factors of the sources still moved after 1,000 rounds")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of the mix itself: every row of ``docs``, all columns, as often as ``mix`` takes it.

    Rows equal in id, source and text share their copies. Documents of size 0
    are not taken.
    """
    prepare(docs.sparkSession)
    tag = docs.select(F.col(id_col), F.col(text_col), F.col(source_col)).withColumn("__k", _row_key(id_col, text_col, source_col))
    taken = mix(tag, id_col, text_col, source_col, keep=("__k",), **options)
    per, _ = stored(taken.groupBy("__k").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows")).where("__copies > 0"), "mix-copies")
    keyed = docs.withColumn("__k", _row_key(id_col, text_col, source_col))
    out = keyed.join(per.where("__rows = 1"), "__k")
    if per.where("__rows > 1").limit(1).count():
        out = out.unionByName(keyed.join(per.where("__rows > 1"), "__k").dropDuplicates(["__k"]))
    return out.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


def _row_key(id_col: str, text_col: str, source_col: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in (id_col, source_col, text_col)]
    return F.md5(F.concat_ws("\x01", *parts).cast("binary"))
