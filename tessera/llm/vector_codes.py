"""Vectors compressed to one code byte a part: product quantisation in integers.

Member-resident Lloyd: a part (row, position, its integers) lives in the
partition of its owner (position, entry, salt). In every round the owners add up
their resident members, the sums (one row an entry) give the next codebook, and
the owners assign their members again; only parts whose entry changes go through
a shuffle, to their new owner, while all others stay where they are. Entries with
many members have several salts, so no owner holds more than a share of all parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stored, tidied

#: bytes of parts in one partition of owners
PARTITION_BYTES = 64 << 20
#: parts assigned at once
CHUNK = 8192
#: integers above this do not fit a long after the distances are added up
LARGEST = float(2 ** 52)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (ties: the lower one) and its squared distance, both exact."""
    n, d = parts.shape
    index, dist = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not n or not d:
        return index, dist
    top = max(int(np.abs(parts).max()), int(np.abs(book).max()))
    small = 4 * d * top * top < 2 ** 53  # sums of products are then whole numbers that doubles hold
    kind = np.float64 if small else object
    b = book.astype(kind)
    own = (b * b).sum(axis=1)
    for lo in range(0, n, CHUNK if small else 64):
        a = parts[lo:lo + (CHUNK if small else 64)].astype(kind)
        far = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T if small else np.dot(a, b.T)) + own[None, :]
        best = np.argmin(far, axis=1)
        near = far[np.arange(len(a)), best]
        if not small and any(x >= 2 ** 63 for x in near):
            raise OverflowError("a squared distance does not fit 64 bits")
        index[lo:lo + len(a)], dist[lo:lo + len(a)] = best, near.astype(np.int64)
    return index, dist


def salt_of(rows: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Salt of each row below its entry's number of salts, by a hash of the row number."""
    mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (mixed % salts.astype(np.uint64)).astype(np.int64)


def owner_partition(owner: tuple[int, int, int]) -> int:
    """Salts of an entry lie in partitions next to one another; entries begin anywhere."""
    position, entry, salt = owner
    return ((position * 65_537 + entry) * 2_654_435_761 >> 8) + salt


def by_owner(position: int, rows: np.ndarray, parts: np.ndarray, entry: np.ndarray, salt: np.ndarray):
    """``((position, entry, salt), (rows, parts))`` for each owner that gets rows."""
    if not len(rows):
        return
    order = np.lexsort((salt, entry))
    e, s = entry[order], salt[order]
    edge = np.flatnonzero(np.concatenate(([True], (e[1:] != e[:-1]) | (s[1:] != s[:-1]), [True])))
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
        at = order[lo:hi]
        yield (position, int(e[lo]), int(s[lo])), (rows[at], parts[at])


class Codebook:
    """Entries by position, and the number of salts of each entry."""

    def __init__(self, entries: np.ndarray, salts: np.ndarray):
        self.entries, self.salts = entries, salts

    @classmethod
    def from_sums(cls, before: Codebook, sums: list, share: int) -> Codebook:
        entries, salts = before.entries.copy(), np.ones_like(before.salts)
        for (position, entry), (count, total) in sums:
            entries[position, entry] = [int(t) // count for t in total]
            salts[position, entry] = -(-count // share)
        return cls(entries, salts)


def _sums(members: RDD) -> list:
    """``((position, entry), (count, sums))``: each owner adds up its residents; one row an entry is left."""

    def add(blocks):
        got: dict = {}
        for (position, entry, _), (_, parts) in blocks:
            # halves are added apart, so that no sum leaves 64 bits
            total = [(int(h) << 26) + int(lo) for h, lo in zip((parts >> 26).sum(axis=0), (parts & ((1 << 26) - 1)).sum(axis=0))]
            count, held = got.get((position, entry), (0, [0] * len(total)))
            got[position, entry] = (count + len(parts), [x + y for x, y in zip(held, total)])
        return iter(got.items())

    def both(a, b):
        return a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]

    return members.mapPartitions(add).reduceByKey(both).collect()


def _moves(book) -> callable:
    """Members of each owner assigned anew: ``(owner, (moves, rows, parts))``, stayers under their old owner."""

    def assign(blocks):
        for (position, entry, salt), (rows, parts) in blocks:
            index, _ = nearest(parts, book.value.entries[position])
            go = index != entry
            if not go.all():
                yield (position, entry, salt), (False, rows[~go], parts[~go])
            # a large group that moves stays as divided as it was
            salts = np.maximum(book.value.salts[position][index[go]], book.value.salts[position, entry])
            for owner, (r, p) in by_owner(position, rows[go], parts[go], index[go], salt_of(rows[go], salts)):
                yield owner, (True, r, p)

    return assign


def _kept(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is neither null nor holds null or non-finite components, with ``__ints``."""
    vec = F.col(vec_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    ints = F.transform(vec, lambda x: F.when(F.abs(x.cast("double")) * 1024 < LARGEST, F.floor(x.cast("double") * 1024))
                       .otherwise(F.raise_error(F.lit("a component is too large for 64-bit distances")).cast("long")))
    return vectors.where(vec.isNotNull() & ~bad).withColumn("__ints", ints)


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label",
             parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """``(id_col, label_col, code, error, label_error)`` of every kept row, and the codebooks ``[part, entry, component]``.

    A component x becomes floor(1024 * x); vectors are cut into ``parts`` equal
    consecutive parts. The codebook of a part position begins as that part of the
    ``entries`` smallest kept ids (ties of ids by the integers; null ids last;
    fewer rows: fewer entries). Every round assigns all parts to the nearest
    entry (squared Euclidean distance, ties to the lower index) and replaces each
    entry by the componentwise floor of its parts' mean; entries without parts
    stay. The parts are assigned once more at the end.

    ``code`` has two hex digits a part (more above 256 entries), ``error`` the
    squared distances added up over the parts, ``label_error`` the sum of
    ``error`` over equal labels, nulls together (``label_col`` None: over all).

    Rows whose vector is null or holds null or non-finite components are dropped;
    repeated rows and ids are coded each; a table without kept rows gives no rows
    and a codebook of no entries. Vectors of different lengths, a length that
    ``parts`` does not divide, and components from 2^42 on are errors. Columns
    not named are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    named = vectors.select(F.col(id_col).alias("__id"), label.alias("__label"), F.col(vec_col).alias("__vec"))
    rows, _ = stored(_kept(named, "__vec").select("__id", "__label", "__ints").withColumn("__row", F.monotonically_increasing_id()), "codes")
    facts = rows.agg(F.count("*").alias("n"), F.min(F.size("__ints")).alias("lo"), F.max(F.size("__ints")).alias("hi")).head()
    out_names = [F.col("__id").alias(id_col), *([F.col("__label").alias(label_col)] if label_col else [])]
    if not facts["n"]:
        return rows.select(*out_names, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")), np.zeros((parts, 0, 0), dtype=np.int64)
    if facts["lo"] != facts["hi"] or facts["hi"] % parts:
        raise ValueError(f"vectors have {facts['lo']} to {facts['hi']} components; one length is needed that {parts} divides")
    width = facts["hi"] // parts
    seeds = rows.orderBy(F.col("__id").asc_nulls_last(), "__ints").select("__ints").limit(entries).collect()
    start = np.array([r[0] for r in seeds], dtype=np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()

    # as many partitions as their bytes need; an owner holds at most a quarter of a partition's share
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-facts["n"] * parts * (8 * width + 8) // PARTITION_BYTES))
    share = max(1, facts["n"] // n_parts)
    first = sc.broadcast(Codebook(start, np.ones(start.shape[:2], dtype=np.int64)))

    def cut(batch):
        ids = batch.column("__row").to_numpy(zero_copy_only=False)
        ints = batch.column("__ints").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), parts, width)
        return ids, ints

    def count(batches):
        got = np.zeros(start.shape[:2], dtype=np.int64)
        for b in batches:
            _, ints = cut(b)
            for p in range(parts):
                got[p] += np.bincount(nearest(ints[:, p], first.value.entries[p])[0], minlength=got.shape[1])
        p, e = np.nonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(got[p, e])], names=["p", "e", "n"])

    def deal(batches):
        """Owners' blocks as bytes, by the first assignment."""
        for b in batches:
            ids, ints = cut(b)
            made = []
            for p in range(parts):
                index, _ = nearest(ints[:, p], dealt.value.entries[p])
                made += by_owner(p, ids, np.ascontiguousarray(ints[:, p]), index, salt_of(ids, dealt.value.salts[p][index]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0][i] for m in made], pa.int64()) for i in range(3)] + [pa.array([m[1][i].tobytes() for m in made], pa.binary()) for i in range(2)],
                names=["p", "e", "s", "rows", "parts"])

    source = rows.select("__row", "__ints")
    salts = np.ones(start.shape[:2], dtype=np.int64)
    for r in source.mapInArrow(tidied(count), "p long, e long, n long").groupBy("p", "e").agg(F.sum("n").alias("n")).collect():
        salts[r["p"], r["e"]] = -(-r["n"] // share)
    dealt = sc.broadcast(Codebook(start, salts))

    def block(r: Row):
        return (r["p"], r["e"], r["s"]), (np.frombuffer(r["rows"], np.int64), np.frombuffer(r["parts"], np.int64).reshape(-1, width))

    members = source.mapInArrow(tidied(deal), "p long, e long, s long, rows binary, parts binary").rdd.map(block)
    members = members.partitionBy(n_parts, owner_partition)
    n_parts = members.getNumPartitions()
    book = dealt.value
    held = []
    for r in range(rounds):
        if r:  # the members go to the entry that is nearest now
            shared = sc.broadcast(book)
            told = members.mapPartitions(_moves(shared), preservesPartitioning=True)
            told.persist(StorageLevel.DISK_ONLY)
            told.checkpoint()
            told.count()
            held.append(told)
            stay = told.filter(lambda m: not m[1][0]).mapValues(lambda v: v[1:])
            move = told.filter(lambda m: m[1][0]).mapValues(lambda v: v[1:]).partitionBy(n_parts, owner_partition)
            members = stay.union(move)
            if members.getNumPartitions() != n_parts:
                raise RuntimeError("members left the partitions of their owners")
        book = Codebook.from_sums(book, _sums(members), share)
        while len(held) > 1:
            held.pop(0).unpersist()

    final = sc.broadcast(book)

    def code(blocks):
        for (position, _, _), (ids, p) in blocks:
            index, dist = nearest(p, final.value.entries[position])
            yield position, ids.tobytes(), index.tobytes(), dist.tobytes()

    coded = spark.createDataFrame(members.mapPartitions(code), "p int, rows binary, codes binary, errors binary", verifySchema=False)

    def spread(batches):
        for b in batches:
            for p, *cols in zip(*[b.column(k).to_pylist() for k in range(4)]):
                ids, index, dist = (np.frombuffer(c, np.int64) for c in cols)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), p, dtype=np.int32)), pa.array(index), pa.array(dist)],
                                                 names=["__row", "p", "c", "error"])

    digits = max(2, len(f"{len(seeds) - 1:x}"))
    each = coded.mapInArrow(tidied(spread), "__row long, p int, c long, error long")
    codes = each.groupBy("__row").agg(
        F.sum("error").alias("error"),
        F.concat(*[F.lower(F.lpad(F.hex(F.max(F.when(F.col("p") == p, F.col("c")))), digits, "0")) for p in range(parts)]).alias("code"))
    flat, _ = stored(rows.select("__id", "__label", "__row").join(codes, "__row"), "codes-out")
    for h in held:
        h.unpersist()
    # labels are joined by two columns that are never null
    flat = flat.withColumns({"__none": F.col("__label").isNull(), "__key": F.coalesce(F.col("__label").cast("string"), F.lit(""))})
    totals = flat.groupBy("__none", "__key").agg(F.sum("error").alias("label_error"))
    return flat.join(totals, ["__none", "__key"]).select(*out_names, "code", "error", "label_error"), book.entries


def codebook_sha256(entries: np.ndarray) -> str:
    """Digest of all entries' components by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()
