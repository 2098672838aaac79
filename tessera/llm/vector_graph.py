"""Embedding near-duplicates on a robust-pruned flat graph.

Vectors go to the shards of their nearest centroids, several each. Every shard
builds a graph in which a vector keeps near neighbours that no kept neighbour
already covers; the adjacency lists of all shards a vector is in are united.
Each vector is then searched for in its shards: a greedy beam search from the
shard's medoids, widened through every vector within range. What the search
finds is verified by the cosine in double precision, and a sample of vectors is
compared with all others by brute force to measure the recall.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, prepare, stored


#: ends the path of a shard that is divided into blocks
DENSE = "!"

# ---- inside a shard -------------------------------------------------------------------------------

def _matrix(table: pa.Table) -> np.ndarray:
    """Unit rows in double precision; scaled by the largest component first, so no square overflows."""
    col = table.column("vec").combine_chunks()
    v = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(table), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def robust_prune(v: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours kept of each row's candidates (``-1``: none), all rows at once.

    The nearest candidate is kept; candidates ``alpha`` times nearer to it than
    to the row are dropped; and so on up to ``degree``.
    """
    n, k = cand.shape
    out = np.full((n, degree), -1, dtype=np.int64)
    dist = np.maximum(2 - 2 * sims, 0.0)
    alive = cand >= 0
    rows = np.arange(n)
    for d in range(degree):
        masked = np.where(alive, dist, np.inf)
        best = masked.argmin(axis=1)
        ok = np.isfinite(masked[rows, best])
        if not ok.any():
            break
        pick = cand[rows, best]
        out[ok, d] = pick[ok]
        between = np.maximum(2 - 2 * np.einsum("nkd,nd->nk", v[cand], v[np.where(ok, pick, 0)]), 0.0)
        alive &= alpha * alpha * between > dist
        alive[rows, best] = False
        alive[~ok] = False
    return out


def build_graph(v: np.ndarray, degree: int, alpha: float, candidates: int = 48) -> list[np.ndarray]:
    """Adjacency lists: pruned near neighbours, their reverse edges, and two far edges each."""
    n = len(v)
    if n <= 1:
        return [np.empty(0, np.int64) for _ in range(n)]
    k = min(candidates, n - 1)
    parts = []
    for lo in range(0, n, 256):
        s = v[lo:lo + 256] @ v.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        parts.append(robust_prune(v, top, np.take_along_axis(s, top, axis=1), degree, alpha))
    out = np.concatenate(parts)
    src, col = np.nonzero(out >= 0)
    dst = out[src, col]
    rng = np.random.default_rng(n)
    far = np.column_stack([np.repeat(np.arange(n), 2), rng.integers(0, n, 2 * n)])
    a = np.concatenate([src, dst, far[:, 0], far[:, 1]])
    b = np.concatenate([dst, src, far[:, 1], far[:, 0]])
    keep = a != b
    pair = np.unique(a[keep] * n + b[keep])
    a, b = pair // n, pair % n
    return np.split(b, np.searchsorted(a, np.arange(1, n)))


def medoids(v: np.ndarray, count: int = 4) -> np.ndarray:
    """The row nearest to the mean, then rows far from those chosen."""
    mean = v.mean(axis=0)
    out = [int((v @ mean).argmax())]
    near = v @ v[out[0]]
    while len(out) < min(count, len(v)):
        out.append(int(near.argmin()))
        near = np.maximum(near, v @ v[out[-1]])
    return np.array(sorted(set(out)))


def greedy_search(v: np.ndarray, adj: list[np.ndarray], starts: np.ndarray, beam: int) -> np.ndarray:
    """For every row as query: the rows of its final beam, from a best-first search over the graph."""
    n = len(v)
    width = max(max((len(a) for a in adj), default=1), 1)
    table = np.full((n, width), -1, dtype=np.int64)
    for i, a in enumerate(adj):
        table[i, :len(a)] = a
    result = np.empty((n, beam), dtype=np.int64)
    # queries at once: their neighbours' vectors take 64 MB at most
    step = int(max(1, min(256, (64 << 20) // (8 * width * v.shape[1]))))
    for lo in range(0, n, step):
        q = v[lo:lo + step]
        m = len(q)
        rows = np.arange(m)
        ids = np.full((m, beam), -1, dtype=np.int64)
        sims = np.full((m, beam), -np.inf)
        done = np.ones((m, beam), dtype=bool)
        seen = np.zeros((m, n), dtype=bool)
        c = min(len(starts), beam)
        ids[:, :c], sims[:, :c], done[:, :c] = starts[:c], q @ v[starts[:c]].T, False
        seen[:, starts[:c]] = True
        live = rows
        while len(live):
            open_sims = np.where(done[live], -np.inf, sims[live])
            best = open_sims.argmax(axis=1)
            go = np.isfinite(open_sims[np.arange(len(live)), best])
            live, best = live[go], best[go]
            if not len(live):
                break
            done[live, best] = True
            nb = table[ids[live, best]]
            fresh = (nb >= 0) & ~seen[live[:, None], nb]
            seen[live[:, None], np.where(nb >= 0, nb, ids[live, best][:, None])] = True
            s = np.where(fresh, np.einsum("mkd,md->mk", v[nb], q[live]), -np.inf)
            all_ids = np.concatenate([ids[live], np.where(fresh, nb, -1)], axis=1)
            all_sims = np.concatenate([sims[live], s], axis=1)
            all_done = np.concatenate([done[live], ~fresh], axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live], done[live] = (np.take_along_axis(x, top, axis=1) for x in (all_ids, all_sims, all_done))
        result[lo:lo + m] = ids
    return result


def range_search(v: np.ndarray, adj: list[np.ndarray], found: np.ndarray, least: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(query, row)`` within range: the beams, widened over edges of rows within ``least - slack``."""
    qs, rs = [], []
    for q in range(len(v)):
        front = np.append(found[q][found[q] >= 0], q)
        seen = np.zeros(len(v), dtype=bool)
        front = np.unique(front)
        seen[front] = True
        s = v[front] @ v[q]
        hit = [front[s >= least - 1e-9]]
        front = front[s >= least - slack]
        while len(front):
            nb = np.unique(np.concatenate([adj[i] for i in front]))
            nb = nb[~seen[nb]] if len(nb) else nb
            if not len(nb):
                break
            seen[nb] = True
            s = v[nb] @ v[q]
            hit.append(nb[s >= least - 1e-9])
            front = nb[s >= least - slack]
        r = np.concatenate(hit)
        r = r[r != q]
        qs.append(np.full(len(r), q))
        rs.append(r)
    return np.concatenate(qs) if qs else np.empty(0, int), np.concatenate(rs) if rs else np.empty(0, int)


def spherical_means(v: np.ndarray, k: int, rounds: int = 12, merge: float = 0.9, seed: int = 5) -> np.ndarray:
    """Unit centroids of the rows; of centroids nearer to each other than ``merge`` one is kept, so a dense group has one."""
    rng = np.random.default_rng(seed)
    c = v[rng.choice(len(v), size=min(k, len(v)), replace=False)]
    for _ in range(rounds):
        near = (v @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, v)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    out: list[int] = []
    for i in range(len(c)):
        if not out or (c[out] @ c[i]).max() < merge:
            out.append(i)
    return c[out]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest of ``n`` rows that each can reach over the links ``a[i] - b[i]``.

    Every turn hooks each root below the least root linked to it and shortens all
    paths, so the trees that still have links to others at least halve in number.
    """
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


# ---- over all vectors -----------------------------------------------------------------------------

def clean_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, vec)``: ``vec`` in doubles, null where it is null, empty, zero or not finite throughout."""
    vec = F.transform("__v", lambda x: x.cast("double") + F.lit(0.0))
    bad = (F.col("__v").isNull() | (F.size("__v") <= 0)
           | F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
           | ~F.exists("vec", lambda x: x != 0))
    plain = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("__v"))
    return plain.withColumn("vec", vec).select("vec_id", F.when(~F.coalesce(bad, F.lit(True)), F.col("vec")).alias("vec"))


def _share(n: Column, most: int) -> Column:
    """Condition that keeps about ``most`` of ``n`` nodes, by a hash of the node."""
    return F.pmod(F.xxhash64("nid", F.lit(99)), F.lit(1 << 40)) < F.lit(float(1 << 40)) * most / n


def assign_shards(nodes: DataFrame, overlap: int, shard_size: int, sample: int = 8000, depth: int = 4) -> DataFrame:
    """``(path, nid, vec)``: every node in its nearest shards, ``overlap`` of them at the first level, half of that below.

    Centroids of a shard are fitted on at most about ``sample`` of its nodes in
    one task; every node is then placed. Shards above ``shard_size`` are divided
    again, until they are small, or dense (one centroid), or ``depth`` is reached.
    """
    members = nodes.select(F.lit("r").alias("path"), "nid", "vec")
    ready = []
    for level in range(depth):
        sizes, _ = stored(members.groupBy("path").agg(F.count("*").alias("n")), "graph-sizes")
        big = sizes.where(F.col("n") > shard_size)
        r = overlap if level == 0 else max(2, overlap // 2)
        few = big.count()
        if not few:
            break

        def fit(key, table):
            v, n = _matrix(table), table.column("n")[0].as_py()
            k = max(1, min(256, len(v) // 4, -(-n * r // shard_size)))
            c = spherical_means(v, k)
            return pa.table({"path": pa.array([key[0].as_py()]), "k": pa.array([len(c)], pa.int32()),
                             "cents": pa.array([c.ravel().tolist()], pa.list_(pa.float64()))})

        cents = (members.join(F.broadcast(big) if few <= 10_000 else big, "path").where(_share(F.col("n"), sample))
                 .groupBy("path").applyInArrow(fit, "path string, k int, cents array<double>"))
        cents, _ = stored(cents, "graph-centroids")
        split = cents.where("k > 1")
        ways = split.count()
        if not ways:
            break
        keys = split.select("path")
        ready.append(members.join(F.broadcast(keys) if ways <= 10_000 else keys, "path", "left_anti"))

        def place(batches, r=r):
            for b in batches:
                if not b.num_rows:
                    continue
                t = pa.Table.from_batches([b])
                v, paths = _matrix(t), b.column("path").to_pylist()
                ids, cent = b.column("nid").to_pylist(), b.column("cents")
                out_path, out_row = [], []
                for p in dict.fromkeys(paths):
                    at = np.array([i for i, x in enumerate(paths) if x == p])
                    c = cent[int(at[0])].values.to_numpy().reshape(-1, v.shape[1])
                    s = v[at] @ c.T
                    m = min(r, len(c))
                    top = np.argpartition(-s, m - 1, axis=1)[:, :m]
                    for i, row in zip(at, top):
                        out_path += [f"{p}.{j}" for j in row]
                        out_row += [i] * m
                vec = b.column("vec").take(pa.array(out_row, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(out_path), pa.array([ids[i] for i in out_row], pa.int64()), vec], names=["path", "nid", "vec"])

        table = split.select("path", "cents")
        # a path's centroids are one bounded row; few paths are sent to every task, many are joined
        moved = members.join(F.broadcast(table) if ways <= 64 else table, "path").mapInArrow(place, "path string, nid long, vec array<double>")
        members, _ = stored(moved.dropDuplicates(["path", "nid"]), "graph-members")
    out = members
    for x in ready:
        out = out.union(x)
    return out


def _tasks(members: DataFrame, shard_size: int) -> DataFrame:
    """``(task, block, nid, vec, paths)``: shards above the size limit become one task for each pair of their blocks."""
    sizes = members.groupBy("path").agg(F.count("*").alias("n"))
    blocks = F.when(F.col("n") > shard_size, F.ceil(F.col("n") * 2 / shard_size)).otherwise(1).cast("int")
    m = members.join(sizes, "path").withColumn("s", blocks)
    m = m.withColumn("path", F.when(F.col("s") > 1, F.concat("path", F.lit(DENSE))).otherwise(F.col("path")))
    paths = m.groupBy("nid").agg(F.collect_set("path").alias("paths"))
    m = m.join(paths, "nid")
    m = m.withColumn("block", F.pmod(F.xxhash64("nid", F.lit(7)), F.col("s")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    # a block alone is a task only where the shard is one block; else it is in the pair tasks
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    return m.select("path", F.concat_ws("#", "path", lo, hi).alias("task"), (lo == hi).alias("alone"), "block", "nid", "vec", "paths", "copies")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = 0.95, overlap: int = 4,
                    shard_size: int = 2000, degree: int = 20, alpha: float = 1.2, beam: int = 24, slack: float = 0.08,
                    audit_queries: int = 200, target_recall: float = 0.97) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``, one row for each input row.

    ``n_links`` counts the other rows found with a cosine of ``min_cosine`` or
    more, ``component_id`` is the smallest id reachable by links and ``kept``
    says that this is the row's own. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing; vectors of different
    lengths do not link. Equal vectors are one node of the graph and link with
    each other exactly; rows that repeat an id count like others. An empty table
    gives no rows; labels and other columns are not read.

    Work and memory: a task holds one shard of at most ``shard_size`` vectors.
    A shard that no centroids divide is a dense group; its blocks are paired, so
    its work grows with the square of the group, which its links do as well, but
    never in one task, and only counts and one edge for each vector leave a
    task. Pairs that several shards may find are counted once, whichever found
    them. A row with a null id and no vector is its own component of null id,
    so its ``kept`` is false, as it is for any null id.

    The index is one flat graph in that adjacency lists are united over the
    shards of a vector; a search stays within the shard, so that a task never
    needs another task's vectors. If the audit finds less than ``target_recall``
    of the links of a sample of vectors, on average over those that have links,
    the index is built again with twice the overlap; a third failure is an error.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows, _ = stored(clean_vectors(vectors, id_col, vec_col).withColumn("nid", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "graph-rows")
    nodes, _ = stored(rows.where("vec IS NOT NULL").groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"),
                                                                       F.first("nid").alias("nid")), "graph-nodes")
    parts = []
    for dim in [r["d"] for r in nodes.select(F.size("vec").alias("d")).distinct().orderBy("d").collect()]:
        own = nodes.where(F.size("vec") == dim)
        for attempt in range(3):
            counts, edges = _links(own, min_cosine, overlap << attempt, shard_size, degree, alpha, beam, slack)
            recall = audit(own, counts, min_cosine, audit_queries)
            if recall >= target_recall:
                break
        else:
            raise RuntimeError(f"only {recall:.3f} of the links of the sampled vectors were found")
        parts.append((counts, edges))
    if not parts:
        return rows.select(F.col("vec_id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts, edges = parts[0]
    for c, e in parts[1:]:
        counts, edges = counts.union(c), edges.union(e)
    label = connected_components(edges)
    info = (nodes.select("nid", "copies", "least").join(counts, "nid", "left")
            .join(label.withColumnRenamed("node", "nid"), "nid", "left")
            .select("nid", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "nid").alias("label")))
    info, _ = stored(info, "graph-info")
    roots = info.groupBy("label").agg(F.min("least").alias("component_id"))
    info = info.join(roots, "label").select("nid", "n_links", "component_id")
    out = rows.select("vec_id", "nid").join(info, "nid", "left")
    comp = F.when(F.col("nid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(F.col("vec_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(False)).alias("kept"))


def _links(nodes: DataFrame, least: float, overlap: int, shard_size: int, degree: int, alpha: float, beam: int, slack: float) -> tuple[DataFrame, DataFrame]:
    """``(nid, links)`` and ``(a, b)``: linked rows of each node, and edges that span what links."""
    members = assign_shards(nodes, overlap, shard_size).join(nodes.select("nid", "copies"), "nid")
    tasks, _ = stored(_tasks(members, shard_size), "graph-tasks")
    # blocks of a divided shard meet in the pair tasks, so a block needs no graph of its own then
    def build(key, table):
        ids = table.column("nid").to_numpy()
        order = np.argsort(ids)
        adj = build_graph(_matrix(table.take(pa.array(order))), degree, alpha)
        ids = ids[order]
        return pa.table({"nid": pa.array(ids), "near": pa.array([ids[a] for a in adj], pa.list_(pa.int64()))})

    near = tasks.groupBy("task").applyInArrow(build, "nid long, near array<long>")
    union = near.groupBy("nid").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(key, table):
        order = np.argsort(table.column("nid").to_numpy())
        table = table.take(pa.array(order))
        ids, v = table.column("nid").to_numpy(), _matrix(table)
        n = len(ids)
        lists = table.column("near").to_pylist()
        adj = []
        for x in lists:
            x = np.asarray(x, dtype=np.int64)
            at = np.searchsorted(ids, x)
            at[at == n] = 0
            adj.append(np.sort(at[ids[at] == x]) if len(x) else np.empty(0, np.int64))
        found = greedy_search(v, adj, medoids(v), min(beam, max(n, 1)))
        q, r = range_search(v, adj, found, least, slack)
        pair = np.unique(np.minimum(q, r) * n + np.maximum(q, r))
        a, b = pair // n, pair % n
        # the exact check
        ok = np.array([float(v[i] @ v[j]) >= least for i, j in zip(a, b)], dtype=bool) if len(a) < 64 else np.einsum("nd,nd->n", v[a], v[b]) >= least
        a, b = a[ok], b[ok]
        root = roots(n, a, b)
        # a pair with one shard in common counts here; in a divided shard, in the first such task that has
        # both; other pairs leave the task, and are counted once however many shards have found them
        path, alone = table.column("path")[0].as_py(), table.column("alone")[0].as_py()
        block = table.column("block").to_numpy()
        sets = [frozenset(p) for p in table.column("paths").to_pylist()]
        mine, shared = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=bool)
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
            common = sets[i] & sets[j]
            dense = [p for p in common if p.endswith(DENSE)]
            if dense:
                mine[k] = min(dense) == path
            else:
                mine[k], shared[k] = len(common) == 1, len(common) > 1
        mine &= alone | (block[a] != block[b])
        copies = table.column("copies").to_numpy()
        links = np.zeros(n, np.int64)
        np.add.at(links, a[mine], copies[b[mine]])
        np.add.at(links, b[mine], copies[a[mine]])
        a, b = a[shared], b[shared]
        own, none = pa.nulls(n, pa.int64()), pa.nulls(2 * len(a), pa.int64())
        return pa.table({"nid": pa.concat_arrays([pa.array(ids), pa.array(ids[np.concatenate([a, b])])]),
                         "links": pa.concat_arrays([pa.array(links), pa.array(copies[np.concatenate([b, a])])]),
                         "root": pa.concat_arrays([pa.array(ids[root]), none]),
                         "other": pa.concat_arrays([own, pa.array(ids[np.concatenate([b, a])])])})

    out = tasks.join(union, "nid").groupBy("task").applyInArrow(search, "nid long, links long, root long, other long")
    out, _ = stored(out, "graph-found")
    several = out.where("other IS NOT NULL").select("nid", "other", "links").distinct().select("nid", "links")
    counts = out.where("other IS NULL").select("nid", "links").union(several).groupBy("nid").agg(F.sum("links").alias("links"))
    edges = out.where("nid <> root").select(F.col("nid").alias("a"), F.col("root").alias("b")).distinct()
    return stored(counts, "graph-counts")[0], edges


def audit(nodes: DataFrame, counts: DataFrame, least: float, queries: int) -> float:
    """Share of a node's links that ``counts`` has, on average over sampled nodes with links, by brute force.

    About ``queries`` nodes are sampled from all, and as many from those that
    ``counts`` gives links, so that rare links are seen too; a large group weighs
    no more than its nodes. 1.0 where none of them has a link. The sample goes to every task (its size is the parameter); nodes are read in
    blocks; only one sum for each sampled node and task comes back.
    """
    n = nodes.count()
    if not n:
        return 1.0
    linked = nodes.join(counts.where("links > 0").select("nid"), "nid", "left_semi")
    picked = nodes.where(_share(F.lit(n), queries)).union(linked.where(_share(F.lit(max(1, linked.count())), queries)).select(*nodes.columns))
    picked = picked.select("nid", "vec").dropDuplicates(["nid"]).toArrow()
    if not len(picked):
        return 1.0
    ids, q = picked.column("nid").to_numpy(), _matrix(picked)
    shared = nodes.sparkSession.sparkContext.broadcast((ids, q))

    def scan(batches):
        ids, q = shared.value
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            if b.num_rows:
                t = pa.Table.from_batches([b])
                own, copies = b.column("nid").to_numpy(), b.column("copies").to_numpy()
                total += ((q @ _matrix(t).T >= least) & (ids[:, None] != own[None, :])) @ copies
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["nid", "true_links"])

    true = nodes.select("nid", "vec", "copies").mapInArrow(scan, "nid long, true_links long").groupBy("nid").agg(F.sum("true_links").alias("t"))
    share = F.least("t", F.coalesce("links", F.lit(0))) / F.col("t")
    got = true.where("t > 0").join(counts, "nid", "left").agg(F.avg(share).alias("recall")).head()
    return 1.0 if got["recall"] is None else got["recall"]
