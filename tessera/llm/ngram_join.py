"""Similarity join on word n-gram sets: size-aware, heavy and light sets apart.

Two documents link when the Jaccard similarity of their shingle sets reaches
``percent`` / 100. With all shingles in one global order, rare ones first,
linked sets share a shingle among the first ``n - ceil(t n) + 1`` (the prefix)
and two among one more than these. Small ("light") sets enumerate the pairs of
their prefix shingles, fixed-size subsets that hardly ever meet by chance;
large ("heavy") sets have too many pairs, so the inverted lists of their single
prefix shingles are scanned instead. The boundary is the size at which the
counted costs of both ways add up to the least. All lists are over distinct
sets, so exact copies are one entry.

Only short lists are expanded into all pairs. In longer ones the members are
first compared with a few leaders; what links is one component, and only pairs
of different components that the size and bit-signature bounds leave open are
compared after that. Every link between different sets is thus
either verified or already inside a component.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import connected_components, discard, give_back, prepare, release, stored, tidied

_K = np.uint64(0x9E3779B97F4A7C15)
#: lists up to this length are expanded into all pairs at once
SHORT = 4
#: turns in which the longer lists meet six more leaders each
LEADER_TURNS = 2
#: bits of the tables that say which sets or ids may be needed again (2 MB) and which shingles are shared (8 MB)
NEED_BITS = 24
SHARED_BITS = 26
SIGNATURE = 8  # longs, 512 bits


_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: bytes of text that are hashed at a time
BUFFER = 1 << 18


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word of the buffer (polynomials from prefix sums, then mixed)."""
    raw = np.frombuffer(buf, dtype=np.uint8)
    n = len(raw)
    size = BUFFER * 2 if n < BUFFER * 2 else n + 1
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[raw], [True]])))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_P, size)[:n], out=sums[1:])
    return start, _mix((sums[end] - sums[start]) * _powers(_P_INVERSE, size)[start])


def _fold(h: np.ndarray, size: int) -> np.ndarray:
    code = np.full(len(h) - size + 1, np.uint64(size))
    for k in range(size):
        code = _mix(code * _K + h[k:len(h) - size + 1 + k])
    return code


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles, as uint64.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text with fewer
    than ``width`` words, but not none, has one shingle of all its words.
    """
    out: list[np.ndarray] = []
    lo = 0
    with np.errstate(over="ignore"):
        while lo < len(texts):
            hi, total = lo, 0
            while hi < len(texts) and (hi == lo or total + len(texts[hi] or b"") < BUFFER):
                total += len(texts[hi] or b"") + 1
                hi += 1
            sizes = np.array([len(t or b"") + 1 for t in texts[lo:hi]])
            start, h = _word_hashes(b" ".join(t or b"" for t in texts[lo:hi]).lower())
            first = np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))
            codes = _fold(h, width) if len(h) >= width else None
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                n = b - a
                out.append(np.unique(codes[a:b - width + 1]) if n >= width else _fold(h[a:b], n) if n else np.empty(0, np.uint64))
            lo = hi
    return out


def set_id(s: np.ndarray) -> int:
    """64-bit fingerprint of a set (a signed long)."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def signature(s: np.ndarray) -> list[int]:
    """512 parity bits: two sets' signatures differ in at most as many bits as the sets in shingles."""
    with np.errstate(over="ignore"):
        at = ((s * _K) >> np.uint64(55)).astype(np.int64)
    bits = (np.bincount(at, minlength=512) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64).tolist()


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))


def _table_bits(rows: DataFrame) -> int:
    """Size of the frequency table: about one counter for every 48 bytes of text, 32 MB at most."""
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return min(25, max(18, (size // 48).bit_length()))


def _frequency_levels(rows: DataFrame, width: int, bits: int) -> np.ndarray:
    """Quarter-octave level of how many documents' shingles fall on each counter, over all rows.

    Tasks count into a table (up to 255) and send it in compressed pieces;
    pieces are added up by number as they stream by. The order of shingles made
    of it decides speed only, never results.
    """
    each = 1 << 14
    pieces = (1 << bits) // each

    def count(batches):
        total, held, n = np.zeros(1 << bits, np.uint8), [], 0

        def flush():
            if held:
                at, c = np.unique(np.concatenate(held), return_counts=True)
                total[at] = np.minimum(total[at] + c, 255)
                held.clear()

        for b in batches:
            for t in shingle_sets(b.column("text").to_pylist(), width):
                held.append((t >> np.uint64(64 - bits)).astype(np.int32))
                n += len(t)
                if n > 1 << 21:
                    flush()
                    n = 0
        flush()
        for k in range(0, pieces, 64):
            hit = [i for i in range(k, min(k + 64, pieces)) if total[i * each:(i + 1) * each].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hit, pa.int32()), pa.array([zlib.compress(total[i * each:(i + 1) * each].tobytes(), 1) for i in hit], pa.binary())],
                names=["piece", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("piece").to_pylist(), b.column("counts").to_pylist()):
                c = np.frombuffer(zlib.decompress(c), np.uint8)
                sums[k] = sums[k] + c if k in sums else c.astype(np.int64)
        keys = sorted(sums)
        level = [np.minimum(4 * np.log2(1.0 + sums[k]), 255).astype(np.uint8).tobytes() for k in keys]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(level, pa.binary())], names=["piece", "level"])

    out = np.zeros(1 << bits, np.uint8)
    parts = rows.select("text").mapInArrow(tidied(count), "piece int, counts binary").repartition("piece").mapInArrow(tidied(add), "piece int, level binary")
    for r in parts.toLocalIterator():
        out[r["piece"] * each:(r["piece"] + 1) * each] = np.frombuffer(r["level"], np.uint8)
    return out


def least_size(percent: int) -> int:
    """Smallest set that can link with a different one."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _profiles(spark: SparkSession, rows: DataFrame, levels: np.ndarray, bits: int, width: int, percent: int) -> DataFrame:
    """``doc_id, n, sid, tokens, s0..s7``: size, fingerprint, prefix and one more shingle, signature."""
    table = spark.sparkContext.broadcast(levels)
    floor = least_size(percent)

    def profile(batches):
        lv = table.value
        for b in batches:
            n, sid, tokens, sig = [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), width):
                n.append(len(s))
                sid.append(set_id(s) if len(s) else None)
                if len(s) < floor:
                    tokens.append(None)
                    sig.append([0] * SIGNATURE)
                    continue
                first = np.lexsort((s, lv[(s >> np.uint64(64 - bits)).astype(np.int64)]))[:prefix_size(len(s), percent) + 1]
                tokens.append(s[first].view(np.int64))
                sig.append(signature(s))
            cols = [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))]
            cols += [pa.array([x[k] for x in sig], pa.int64()) for k in range(SIGNATURE)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "sid", "tokens", *[f"s{k}" for k in range(SIGNATURE)]])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidied(profile), f"doc_id {kind}, n long, sid long, tokens array<long>, " + ", ".join(f"s{k} long" for k in range(SIGNATURE)))


def _size_ok(percent: int, a: str, b: str) -> Column:
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def _signature_ok(percent: int, x: str, nx: str, y: str, ny: str) -> Column:
    """Signatures ``x`` and ``y`` (arrays of longs) leave a link possible for sets of these sizes."""
    differ = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(SIGNATURE)), F.lit(0))
    return (100 + percent) * differ <= (100 - percent) * (F.col(nx) + F.col(ny))


def _boundary(active: DataFrame, percent: int) -> tuple[int, Column]:
    """First heavy size class by cost, and the class of a size: powers of 100 / percent."""
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    per_set = active.groupBy("sid").agg(F.first("n").alias("n"), F.count("*").alias("m"),
                                        F.sum(F.when(F.col("extra"), 0).otherwise(F.col("len") - 1)).alias("scan"))
    # one row for each size class: a few hundred at most
    cost = {r["k"]: (r["pairs"], r["scan"]) for r in per_set.groupBy(size_class.alias("k")).agg(
        F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("pairs"), F.sum("scan").alias("scan")).collect()}
    best, at = None, 0
    for bound in sorted([*cost, max(cost, default=0) + 1]):
        total = sum(p if k < bound else s for k, (p, s) in cost.items())
        if best is None or total <= best:
            best, at = total, bound
    return at, size_class


def _shared_prefixes(spark: SparkSession, profiles: DataFrame) -> tuple[DataFrame, str]:
    """``(sid, n, token, extra, len)``: prefix entries of shingles that two or more sets have, and how many have them; and its path."""
    tokens = profiles.where("tokens IS NOT NULL").select("sid", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a <> b").select("token")
    shared, path = stored(shared, "join-shared")
    table = spark.sparkContext.broadcast(_bit_table(shared, SHARED_BITS))

    def select(batches):
        packed = table.value
        for b in batches:
            lists = b.column("tokens")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            keep = _marked(packed, _slot(flat, SHARED_BITS))
            row = np.repeat(np.arange(len(sizes)), sizes)
            extra = np.zeros(len(flat), bool)
            extra[np.cumsum(sizes) - 1] = True
            at = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([b.column("sid").take(at), b.column("n").take(at), pa.array(flat[keep]), pa.array(extra[keep])],
                                             names=["sid", "n", "token", "extra"])

    post = (profiles.where("tokens IS NOT NULL").select("sid", "n", "tokens").mapInArrow(tidied(select), "sid long, n long, token long, extra boolean")
            .dropDuplicates(["token", "sid"]))
    lens = post.groupBy("token").agg(F.count("*").alias("len")).where("len > 1")
    active = stored(post.join(lens, "token"), "join-active")
    discard(spark, path)
    release(spark)
    return active


def _lists(active: DataFrame, percent: int) -> DataFrame:
    """``(key, sid, n, len)`` entries of all lists with two sets or more.

    Short lists of single shingles are taken as they are, whatever the sizes:
    scanning them costs less than any subset. A linked pair that shares no such
    shingle shares two with longer lists, so subsets are made of those only.
    """
    short = active.where(F.col("len") <= SHORT).select(F.col("token").alias("key"), "sid", "n", "len")
    active = active.where(F.col("len") > SHORT)
    bound, size_class = _boundary(active, percent)
    # light sets: pairs of shared prefix shingles as keys
    pairs = F.flatten(F.transform("t", lambda x, i: F.transform(F.slice(F.col("t"), i + 2, F.size("t")), lambda y: F.xxhash64(x, y))))
    light = (active.where(size_class < bound).groupBy("sid").agg(F.sort_array(F.collect_list("token")).alias("t"), F.first("n").alias("n"))
             .where(F.size("t") > 1).select("sid", "n", F.explode(pairs).alias("key")))
    twice = light.groupBy("key").agg(F.count("*").alias("len")).where("len > 1")
    light = light.join(twice, "key").select("key", "sid", "n", "len")
    # heavy sets and those that may be in reach of one: single shingles as keys
    heavy = active.where((size_class >= bound - 2) & ~F.col("extra")).select(F.col("token").alias("key"), "sid", "n", "len")
    return short.union(light).union(heavy)


def _bit_table(values: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of a table of ``2 ** bits`` marking the values (one long column) by their top bits.

    Its size is fixed; where it fills up it only lets more pass, and what passes
    is selected exactly by a join.
    """
    def mark(batches):
        on = np.zeros((1 << bits) // 8, np.uint8)
        for b in batches:
            slots = _slot(b.column(0).to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(on, slots >> 3, (128 >> (slots & 7)).astype(np.uint8))
        if on.any():
            packed = on.tobytes()
            step = 1 << 16
            yield pa.RecordBatch.from_arrays([pa.array(range(0, len(packed), step), pa.int32()),
                                              pa.array([packed[i:i + step] for i in range(0, len(packed), step)], pa.binary())], names=["at", "bits"])

    def either(batches):
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("at").to_pylist(), b.column("bits").to_pylist()):
                v = np.frombuffer(v, np.uint8)
                got[k] = got[k] | v if k in got else v
        yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([v.tobytes() for v in got.values()], pa.binary())],
                                         names=["at", "bits"])

    packed = np.zeros((1 << bits) // 8, np.uint8)
    for r in values.mapInArrow(tidied(mark), "at int, bits binary").repartition("at").mapInArrow(tidied(either), "at int, bits binary").collect():
        packed[r["at"]:r["at"] + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return packed


def _slot(values: np.ndarray, bits: int) -> np.ndarray:
    return (values.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _marked(packed: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (packed[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 == 1


def _marks(spark: SparkSession, values: DataFrame) -> Callable[[str], Column]:
    """A function telling whether a long column falls on a mark of ``values``.

    Declared nondeterministic, or the optimizer would infer it for the other
    side of every join as well and run it there once more.
    """
    table = spark.sparkContext.broadcast(_bit_table(values, NEED_BITS))

    @F.arrow_udf("boolean")
    def marked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for h in batches:
            yield pa.array(_marked(table.value, _slot(h.to_numpy(zero_copy_only=False), NEED_BITS)))
        give_back()

    return marked.asNondeterministic()


def _needed_sets(spark: SparkSession, rows: DataFrame, need: DataFrame, width: int) -> DataFrame:
    """``(sid, s)``: the whole shingle sets of the ids in ``need``, made again from the texts."""
    table = spark.sparkContext.broadcast(_bit_table(need, NEED_BITS))

    def select(batches):
        marks, seen = table.value, set()
        for b in batches:
            ids, sets = [], []
            for s in shingle_sets(b.column("text").to_pylist(), width):
                if not len(s):
                    continue
                i = set_id(s)
                at = (i & ((1 << 64) - 1)) >> (64 - NEED_BITS)
                if marks[at >> 3] >> (7 - (at & 7)) & 1 and i not in seen:
                    if len(seen) < 100_000:  # copies within a task, spared the shuffle
                        seen.add(i)
                    ids.append(i)
                    sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["sid", "s"])

    made = rows.select("text").mapInArrow(tidied(select), "sid long, s array<long>").join(need, "sid", "left_semi")
    return made.groupBy("sid").agg(F.first("s").alias("s"))


def _marked_rows(rows: DataFrame, need: DataFrame) -> DataFrame:
    """The rows whose ``sid`` may be among the values of ``need``: all that are, and a few others. Only the ids go to Python."""
    return rows.where(_marks(rows.sparkSession, need)("sid"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the similarity; only sets that may be in a pair are shuffled.

    They are shuffled once for both sides, which also keeps the two out of one
    stage, whose tasks would hold two Python workers each.
    """
    sets = _marked_rows(sets, pairs.select(F.explode(F.array("a", "b")).alias("sid"))).repartition("sid")
    both = (pairs.join(sets.select(F.col("sid").alias("a"), F.col("s").alias("sa")), "a")
            .join(sets.select(F.col("sid").alias("b"), F.col("s").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """``(a, b)``: all pairs of the lists with ``SHORT`` members at most, where the sizes allow a link."""
    member = F.struct("sid", "n")
    groups = lists.where(F.col("len") <= SHORT).groupBy("key").agg(F.sort_array(F.collect_list(member)).alias("g"))
    pairs = F.flatten(F.transform("g", lambda x, i: F.transform(
        F.filter(F.slice(F.col("g"), i + 2, F.size("g")), lambda y: 100 * F.least(x["n"], y["n"]) >= percent * F.greatest(x["n"], y["n"])),
        lambda y: F.struct(x["sid"].alias("a"), y["sid"].alias("b")))))
    return groups.select(pairs.alias("p")).where(F.size("p") > 0).select(F.explode("p").alias("p")).select("p.a", "p.b").distinct()


def _leader_pairs(lists: DataFrame, percent: int, seeds: tuple[int, ...], label: DataFrame | None = None,
                  links: DataFrame | None = None) -> DataFrame:
    """``(a, b)``: every entry of the longer lists with the leaders of its list, where the sizes allow a link.

    Leaders are the members first in random orders; the orders are the same for
    all lists, so the lists of one group of similar sets tend to have the same
    leaders. With ``label``, pairs inside one component are left out, and the
    leaders are the members with the most ``links`` in random parts of the list:
    the middle of a group of similar sets is most likely to reach the others.
    """
    lists = lists.where(F.col("len") > SHORT).select("key", "sid", "n")
    if label is not None:
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        known = label.join(degree, "node", "left").withColumnRenamed("node", "sid")
        lists = lists.join(known, "sid", "left").withColumns({"label": F.coalesce("label", "sid"), "degree": F.coalesce("degree", F.lit(0))})
    else:
        lists = lists.withColumns({"label": F.col("sid"), "degree": F.lit(0)})

    def first(seed: int) -> Column:
        rank = F.xxhash64("sid", F.lit(seed))
        order = F.struct((F.pmod(rank, F.lit(4)) != 0).alias("part"), (-F.col("degree")).alias("d"), rank.alias("r"), F.struct("sid", "n", "label").alias("y"))
        return F.min(order).alias(f"l{seed}")

    leaders = lists.groupBy("key").agg(*[first(s) for s in seeds]).select("key", F.array(*[F.col(f"l{s}.y") for s in seeds]).alias("ys"))
    if label is not None:
        alike = lists.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
        leaders = leaders.join(alike, "key")
    rows = lists.join(leaders, "key").select("sid", "n", "label", F.explode(F.array_distinct("ys")).alias("y"))
    rows = rows.where((F.col("label") != F.col("y.label")) & _size_ok(percent, "n", "y.n"))
    return rows.select(F.least("sid", "y.sid").alias("a"), F.greatest("sid", "y.sid").alias("b")).distinct()


def _plausible(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs that the signatures leave open."""
    a = facts.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("ga"))
    b = facts.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("gb"))
    return pairs.join(a, "a").join(b, "b").where(_signature_ok(percent, "ga", "na", "gb", "nb")).select("a", "b")


def _rest_pairs(active: DataFrame, facts: DataFrame, label: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """Pairs of different components that share a longer prefix list and that size and signature leave open, and the path they are read from.

    Every pair that links shares a single prefix shingle; where all those it
    shares have short lists, it has been in a short list already. In every list
    the members outside its largest component meet all others, so a large group
    that has become one component is not expanded.
    """
    entry = (active.where((F.col("len") > SHORT) & ~F.col("extra")).select(F.col("token").alias("key"), "sid", "n")
             .join(label.withColumnRenamed("node", "sid"), "sid", "left").withColumn("label", F.coalesce("label", "sid")))
    parts = entry.groupBy("key", "label").agg(F.count("*").alias("c"))
    most = (parts.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("most"), F.count("*").alias("k"))
            .where("k > 1").select("key", "most"))
    open_lists = entry.join(most, "key").join(facts.select("sid", "sig"), "sid")
    open_lists, path = stored(open_lists, "join-open")
    left = open_lists.where("label <> most").select("key", F.col("sid").alias("other"), F.col("n").alias("m"), F.col("label").alias("its"), F.col("sig").alias("gs"))
    met = open_lists.join(left, "key").where(
        (F.col("label") != F.col("its")) & _size_ok(percent, "n", "m") & _signature_ok(percent, "sig", "n", "gs", "m"))
    return met.select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct(), path


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each input row.

    ``component_id`` is the smallest id reachable by links, the row's own
    included. Null or empty texts and texts without words have the empty set
    and link with nothing; equal sets link, so repeated rows and exact copies
    are one component. Null ids are allowed and are never a component's id
    unless all its ids are null. An empty table gives no rows. Only the two
    named columns are read.

    Sets and shingles are known by 64-bit hashes: wrong matches are to be
    expected only beyond some 10^9 distinct sets. Full sets are never stored for
    all documents (they are larger than the texts); those of documents in
    some list are made again from the texts.
    """
    out, _ = _components(_text_rows(docs, id_col, text_col), width, percent)
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _components(rows: DataFrame, width: int, percent: int) -> tuple[DataFrame, list[str]]:
    """``(doc_id, n, sid, label, component_id)`` of ``(doc_id, text)`` rows, one for each, and the paths it is read from.

    ``sid`` is the set's fingerprint and ``label`` the component's, which tells
    components of equal ``component_id`` apart where ids repeat or are null; both
    are null where the set is empty.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    spark = rows.sparkSession
    prepare(spark)
    bits = _table_bits(rows)
    profiles, ppath = stored(_profiles(spark, rows, _frequency_levels(rows, width, bits), bits, width, percent), "join-profiles")
    active, apath = _shared_prefixes(spark, profiles)
    lists, lpath = stored(_lists(active, percent), "join-lists")
    facts = profiles.where("tokens IS NOT NULL").select("sid", "n", F.array(*[f"s{k}" for k in range(SIGNATURE)]).alias("sig"))
    facts = facts.join(active.select("sid").distinct(), "sid", "left_semi").groupBy("sid").agg(F.first("n").alias("n"), F.first("sig").alias("sig"))
    facts, fpath = stored(facts, "join-facts")
    release(spark)

    sets, spath = stored(_needed_sets(spark, rows, facts.select("sid"), width), "join-sets")
    release(spark)
    paths = [ppath, apath, lpath, fpath, spath]  # of what nothing needs once the labels are stored

    def kept(df: DataFrame, label: str) -> DataFrame:
        out, path = stored(df, label)
        paths.append(path)
        return out

    def verify(pairs: DataFrame) -> DataFrame:
        release(spark)
        out = kept(_verified(pairs, sets, percent), "join-links")
        release(spark)
        return out

    first = _short_pairs(lists, percent).union(_leader_pairs(lists, percent, (1, 2))).distinct()
    tried = kept(_plausible(first, facts, percent), "join-pairs")
    links = verify(tried)
    label = connected_components(links)
    # other leaders while they still join components, then whatever remains
    for turn in range(LEADER_TURNS + 1):
        if turn < LEADER_TURNS:
            more = _plausible(_leader_pairs(lists, percent, tuple(range(6 * turn + 3, 6 * turn + 9)), label, links), facts, percent)
        else:
            more, opath = _rest_pairs(active, facts, label, percent)
            paths.append(opath)
        # stored before the anti join, which the optimizer would push below the distinct
        more = kept(kept(more, "join-more").join(tried, ["a", "b"], "left_anti"), "join-rest")
        found = verify(more)
        tried = tried.union(more)
        if found.limit(1).count():
            links = links.union(found)
            label = kept(connected_components(links), "join-components")

    label, labels = stored(label.select(F.col("node").alias("sid"), "label"), "join-labels")
    # of the profiles, what the result is made of
    profiles, ids = stored(profiles.select("doc_id", "n", "sid"), "join-ids")
    discard(spark, *paths)
    release(spark)
    classes = profiles.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("least"))
    classes = classes.join(label, "sid", "left").select("sid", "least", F.coalesce("label", "sid").alias("label"))
    classes, cpath = stored(classes, "join-classes")
    discard(spark, labels)
    roots = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    of_set = classes.join(roots, "label").select("sid", "label", "component_id")
    return profiles.join(of_set, "sid", "left"), [ids, cpath]


#: what the id alone tells of a row
STAYS, GOES, OPEN = 0, 1, 2


def _told_by_id(known: DataFrame) -> tuple[Callable[[Column], Column], DataFrame]:
    """A function from the hash of an id of ``known (doc_id, stays)`` to ``STAYS``, ``GOES`` or ``OPEN``, and the ids that stay among the open ones.

    One bit table marks the ids that go, another the staying ones that fall on a
    mark of the first: an id without the first mark stays, one without the second
    goes. Only rows with both need a join, so that texts are not shuffled for
    it. The tables have a fixed size; where they fill up, more rows are open.
    """
    spark = known.sparkSession
    known = known.withColumn("h", F.xxhash64("doc_id"))
    goes = known.where("NOT stays").select("h")
    close, _ = stored(known.where("stays").where(_marks(spark, goes)("h")).select("doc_id", "h"), "keep-close")
    first = spark.sparkContext.broadcast(_bit_table(goes, NEED_BITS))
    second = spark.sparkContext.broadcast(_bit_table(close.select("h"), NEED_BITS))

    @F.arrow_udf("int")
    def state(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for h in batches:
            slots = _slot(h.to_numpy(zero_copy_only=False), NEED_BITS)
            yield pa.array(np.where(_marked(first.value, slots), np.where(_marked(second.value, slots), OPEN, GOES), STAYS), pa.int32())
        give_back()

    return state, close


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component: the one with the smallest id, with its columns unchanged.

    Documents without words are in no component and all stay. Every component
    keeps one row, also where ids repeat over components or a component has null
    ids alone: of the rows with its smallest id, one with the smallest set id.
    """
    spark = docs.sparkSession
    parts, paths = _components(_text_rows(docs, id_col, text_col), width, percent)
    parts, _ = stored(parts.where("n > 0"), "keep-parts")
    discard(spark, *paths)
    root = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids, _ = stored(parts.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(root).alias("root")), "keep-ids")
    release(spark)
    cols = docs.columns
    words = F.coalesce(F.rlike(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    known = ids.where("doc_id IS NOT NULL").select("doc_id", F.expr("root AND n = 1").alias("stays"))
    state, close = _told_by_id(known)
    told = F.when(F.col(id_col).isNotNull(), state(F.xxhash64(F.col(id_col))))
    out = docs.where(~words | (told == STAYS)).select(*cols)
    if close.limit(1).count():
        out = out.union(docs.where(words & (told == OPEN)).join(close.select(F.col("doc_id").alias(id_col)), id_col, "left_semi").select(*cols))
    words = docs.where(words)
    ids = ids.where("root")
    unclear = ids.where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("__id"))
    if unclear.limit(1).count():  # the id does not tell the row: by id and set
        picked = parts.where(root).join(unclear, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi").groupBy("label").agg(
            F.first("doc_id").alias("__id"), F.min("sid").alias("__root"))
        rows = _with_set_ids(words.join(unclear, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi"), text_col, width)
        rows = rows.join(picked, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__sid") == F.col("__root")), "left_semi")
        out = out.union(rows.dropDuplicates([id_col, "__sid"]).select(*cols))
    return out


def _with_set_ids(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """All columns and ``__sid``, the id of the text's set."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__sid", T.LongType())])

    def run(batches):
        for b in batches:
            sid = [set_id(s) if len(s) else None for s in shingle_sets(b.column("__text").to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in schema.fields[:-1]], pa.array(sid, pa.int64())], names=schema.names)

    return docs.withColumn("__text", F.col(text_col).cast("string").cast("binary")).mapInArrow(tidied(run), schema)
