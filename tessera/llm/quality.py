"""Quality classifier: naive Bayes support vectors.

N-gram indicators are scaled by the log ratio of their class frequencies and a
linear hinge-loss model is fitted to them by dual coordinate descent. A
sigmoid fitted on rows the descent does not see turns margins into scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import TASK_CACHES, give_back, id_text, prepare, tidied, unit_hash

_PARTS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_K = np.uint64(0x9E3779B97F4A7C15)


class _Chunks(dict):
    """Token hashes of recent runs between white space, 100,000 at most."""

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        out = chunk_tokens(chunk)
        if len(chunk) <= 64:
            if len(self) >= 100_000:
                self.clear()
            self[chunk] = out
        return out


_CHUNKS = _Chunks()
TASK_CACHES.append(_CHUNKS)


def chunk_tokens(chunk: str) -> tuple[int, ...]:
    """Hashes of the tokens of a run between white space.

    Words are lower-cased, numbers are one token, adjacent signs are one token;
    a word in capitals is followed by a token saying so.
    """
    out = []
    for part in _PARTS.findall(chunk):
        if part[0].isalpha():
            out.append("w" + part.lower())
            if len(part) > 1 and part.isupper():
                out.append("CAPS")
        elif part[0].isdigit():
            out.append("NUM")
        else:
            out.append("s" + part)
    return tuple(xxhash.xxh64_intdigest(t) for t in out)


def indicators(text: str | None, bits: int) -> np.ndarray:
    """Distinct buckets of the text's token unigrams and bigrams; a repeated bigram has a bucket of its own."""
    hashes: list[int] = []
    for chunk in (text or "").split():
        hashes += _CHUNKS[chunk]
    if not hashes:
        return np.empty(0, np.int64)
    h = np.array(hashes, dtype=np.uint64)
    with np.errstate(over="ignore"):
        pairs = (h[:-1] * _K + h[1:]) * np.uint64(0xD6E8FEB86659FD93)
        same = h[:-1] == h[1:]
        if same.any():  # the same word twice in a row, whatever the word
            pairs = np.append(pairs, np.uint64(0x1234567))
    shift = np.uint64(64 - bits)
    return np.unique(np.concatenate([(h * _K) >> shift, pairs >> shift])).astype(np.int64)


@dataclass
class QualityModel:
    bits: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # class log ratio times hinge-loss weight
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, f: np.ndarray) -> float:
        if not len(f) or not len(self.weights):
            return self.bias
        norm = float(np.sqrt((self.ratio[f] ** 2).sum()))
        return float(self.weights[f].sum()) / norm + self.bias if norm else self.bias

    def score(self, text: str | None) -> float:
        z = self.slope * self.margin(indicators(text, self.bits)) + self.offset
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, c: float, passes: int, rng, tolerance: float = 1e-3,
                 cost: np.ndarray | None = None):
    """Weights and bias of the L1-loss linear SVM, one dual variable at a time.

    ``rows`` are (indices, values); the bias is a constant feature of value 1.
    Each step solves its variable's one-dimensional problem exactly within
    ``[0, c * cost]``; passes end early when no projected gradient is large.
    """
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    upper = c * (np.ones(len(rows)) if cost is None else cost)
    q = np.array([float(v @ v) + 1.0 for _, v in rows])
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            f, v = rows[i]
            g = y[i] * (float(w[f] @ v) + bias) - 1.0
            pg = min(g, 0.0) if alpha[i] <= 0 else max(g, 0.0) if alpha[i] >= upper[i] else g
            worst = max(worst, abs(pg))
            if pg:
                new = min(max(alpha[i] - g / q[i], 0.0), upper[i])
                step = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[f] += step * v
                bias += step
        if worst < tolerance:
            break
    return w, bias


def fit_sigmoid(margin: np.ndarray, y01: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset of the logistic curve through margins and labels, by Newton steps on smoothed targets.

    A row counts ``weight`` times, in proportion; targets are smoothed by the rows there are.
    """
    weight = np.ones(len(y01)) if weight is None else weight / weight.mean()
    pos, neg = float(y01.sum()), float(len(y01) - y01.sum())
    t = np.where(y01 > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, float(np.log((weight @ y01 + 1) / (weight @ (1 - y01) + 1)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        d, h = weight * (p - t), weight * np.maximum(p * (1 - p), 1e-9)
        g = np.array([float(d @ margin) + 1e-3 * (a - 1), float(d.sum())])
        hess = np.array([[float(h @ (margin * margin)) + 1e-3, float(h @ margin)], [float(h @ margin), float(h.sum()) + 1e-6]])
        step = np.linalg.solve(hess, g)
        size = 1.0 / max(1.0, float(np.abs(step).max()) / 2)
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def list_arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of an Arrow column as arrays over one buffer each chunk, without Python numbers."""
    out: list[np.ndarray] = []
    for chunk in column.chunks:
        at, flat = chunk.offsets.to_numpy(), chunk.values.to_numpy()
        out += [flat[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
    return out


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int, id_col: str = "doc_id",
             text_col: str = "text", seed: str = "labels") -> DataFrame:
    """``(label, weight, text)``: about ``per_class`` labelled rows of each class, chosen by a hash of the id.

    ``weight`` is the number of labelled rows that a chosen one stands for, 1
    where its class is taken whole; weighted by it the classes are in the
    proportion of the whole table. ``usable`` is a condition on ``id_col``. Ids
    with null or contradicting labels are not used; labels given twice count
    once. The chosen ids, bounded by the parameter, are joined to the documents
    where those lie.
    """
    one = (labels.where(usable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
           .groupBy("__id").agg(F.min("label").alias("label"), F.max("label").alias("top")).where("label = top AND label IN (0, 1)"))
    counts = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("label") == 1, F.lit(min(1.0, per_class / max(1, counts.get(1, 0))))).otherwise(
        F.lit(min(1.0, per_class / max(1, counts.get(0, 0)))))
    chosen = one.where(unit_hash(F.col("__id"), seed=seed) < share).select("__id", "label", (1 / share).alias("weight"))
    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "__id").select(
        "label", "weight", "text")


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_class: int = 3000, bits: int = 18, c: float = 1.0, smoothing: float = 1.0, min_docs: int = 3, mix: float = 0.5, passes: int = 20,
          seed: int = 11) -> QualityModel:
    """Fit the classifier on at most about ``per_class`` labelled rows of each class.

    The scores are for classes in the proportion of all labelled rows, however
    many of each are taken: the sigmoid is fitted with the rows' weights, and the
    hinge loss counts both classes alike. Indicators are made on the executors
    from whole texts; the driver gets those of each sampled row. N-grams in
    fewer than ``min_docs`` of the rows do not count. ``mix`` weighs the fitted
    weights against their mean magnitude. With fewer than two classes
    every score is the share of label 1 (0.5 without rows).
    """
    prepare(docs.sparkSession)
    rows = labelled(docs, labels, label_col, usable, per_class, id_col, text_col, "quality")

    def features(batches):
        for b in batches:
            f = [indicators(t, bits) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("weight"), pa.array([x.astype(np.int32) for x in f], pa.list_(pa.int32()))],
                                             names=["label", "weight", "f"])

    got = rows.mapInArrow(tidied(features), "label int, weight double, f array<int>").toArrow()
    y01 = np.array(got.column("label").to_pylist(), dtype=np.int64)
    stands_for = np.array(got.column("weight").to_pylist(), dtype=float)
    feats = list_arrays(got.column("f"))
    order = sorted(range(len(feats)), key=lambda i: (y01[i], len(feats[i]), feats[i].tobytes()))
    model = QualityModel(bits)
    if len(set(y01.tolist())) < 2:
        p = float(y01.mean()) if len(y01) else 0.5
        model.offset = float(np.log(max(p, 1e-3) / max(1 - p, 1e-3)))
        model.slope = 0.0
        return model
    rng = np.random.default_rng(seed)
    order = [order[i] for i in rng.permutation(len(order))]

    def fit(index: list[int]) -> None:
        size = 1 << bits
        n = [np.zeros(size), np.zeros(size)]
        rows_of = [0, 0]
        for i in index:
            n[y01[i]][feats[i]] += 1
            rows_of[y01[i]] += 1
        p, q = n[1] + smoothing, n[0] + smoothing
        model.ratio = np.log((p / (rows_of[1] + 2 * smoothing)) / (q / (rows_of[0] + 2 * smoothing)))
        model.ratio[n[0] + n[1] < min_docs] = 0.0  # too rare to tell
        scaled = []
        for i in index:
            v = model.ratio[feats[i]]
            norm = np.sqrt((v ** 2).sum())
            scaled.append((feats[i], v / norm if norm else v))
        y = np.where(y01[index] == 1, 1.0, -1.0)
        cost = np.where(y01[index] == 1, len(index) / (2 * max(1, rows_of[1])), len(index) / (2 * max(1, rows_of[0])))
        w, model.bias = dual_descent(scaled, y, size, c, passes, rng, cost=cost)
        mean = float(np.abs(w[w != 0]).mean()) if (w != 0).any() else 0.0
        model.weights = model.ratio * ((1 - mix) * mean + mix * w) if mix < 1 else model.ratio * w

    # the sigmoid is fitted on margins of rows left out of the descent, fold by fold
    margins = np.zeros(len(order))
    for k in range(3):
        out = [j for j in range(len(order)) if j % 3 == k]
        inside = [order[j] for j in range(len(order)) if j % 3 != k]
        if len(set(y01[inside].tolist())) < 2:
            continue
        fit(inside)
        margins[out] = [model.margin(feats[order[j]]) for j in out]
    prior = y01[order].astype(float)
    model.slope, model.offset = fit_sigmoid(margins, prior, stands_for[order])
    fit(order)
    give_back()  # the sample has gone through the driver
    return model


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, score)`` for every row, from the whole text alone.

    Null and empty texts get the score of a text without features; repeated
    rows get equal scores; an empty table gives no rows; columns not named are
    not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    base = docs.select(*[F.col(k) for k in keep], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches):
        for b in batches:
            s = [shared.value.score(t) for t in b.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(s, pa.float64())], names=[*keep, "score"])

    return base.mapInArrow(tidied(run), f"{schema}, score double")


def filter_quality(docs: DataFrame, model: QualityModel, min_score: float = 0.7, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns unchanged, whose text scores at least ``min_score``.

    Only the text goes to Python and only its score comes back; the other columns
    stay where they are, whatever their names.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())
        give_back()

    return docs.where(score(F.col(text_col).cast("string")) >= min_score)


__all__ = ["QualityModel", "filter_quality", "id_text", "indicators", "labelled", "score_quality", "train"]
