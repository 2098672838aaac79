"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams inside
words (word ends count as a character); a linear softmax on that mean gives
the language. Embeddings and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample; a temperature and a rejection
threshold are fitted on a part of the sample that the training does not see.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, tidied, unit_hash
from tessera.llm.quality import list_arrays

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII that is no letter separates words; everything else is kept
_TO_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MULT = np.uint32(0x9E3779B1)


def subword_buckets(buffer: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and buckets of the ``n``-grams of ``buffer`` that lie in one word.

    The buffer is bytes with single words between spaces; an n-gram may begin or
    end with the space at a word's border but holds none inside.
    """
    if len(buffer) < n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    m = len(buffer) - n + 1
    code = np.full(m, np.uint32(n * 2654435 + 1))
    for k in range(n):
        code = code * np.uint32(0x01000193) + buffer[k:k + m]
    space = buffer == 32
    inside = np.zeros(m, dtype=bool)
    for k in range(1, n - 1):
        inside |= space[k:k + m]
    if n == 2:
        inside = space[:m] & space[1:]
    at = np.flatnonzero(~inside)
    return at, ((code[at] * _MULT) >> np.uint32(32 - bits)).astype(np.int64)


def letters(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode().translate(_TO_LETTERS).split()) + b" "


@dataclass
class LanguageModel:
    """``table[bucket, class]`` is the embedding times the softmax weights, folded after training."""

    classes: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    bits: int
    orders: tuple[int, ...]

    def logits(self, texts: list[str]) -> np.ndarray:
        """Class scores of each text: sums of table rows over its n-grams, divided by their number."""
        out = np.tile(self.bias, (len(texts), 1)).astype(np.float64)
        parts = [letters(t) for t in texts]
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        ends = np.cumsum(sizes)
        lo = 0
        while lo < len(parts):  # groups of texts of about 1 MB, so that the vectors stay small
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20))))
            if hi == lo + 1 and sizes[lo] > 1 << 22:  # one very long text: in pieces, summed
                total, count = np.zeros(len(self.classes)), 0
                step = 1 << 20
                top = max(self.orders) - 1
                for a in range(0, len(parts[lo]), step):
                    buf = np.frombuffer(parts[lo][a:a + step + top], dtype=np.uint8)
                    for n in self.orders:
                        at, b = subword_buckets(buf, n, self.bits)
                        b = b[at < step]
                        total += self.table[b].sum(axis=0)
                        count += len(b)
                out[lo] += total / max(count, 1)
            else:
                buf = np.frombuffer(b"".join(parts[lo:hi]), dtype=np.uint8)
                base = ends[lo] - sizes[lo]
                owner_ends = ends[lo:hi] - base
                sums, counts = np.zeros((hi - lo, len(self.classes))), np.zeros(hi - lo)
                for n in self.orders:
                    at, b = subword_buckets(buf, n, self.bits)
                    doc = np.searchsorted(owner_ends, at, side="right")
                    first = at - np.concatenate([[0], owner_ends])[doc]
                    ok = first + n <= sizes[lo:hi][doc]  # not across two texts
                    doc, b = doc[ok], b[ok]
                    counts += np.bincount(doc, minlength=hi - lo)
                    for c in range(len(self.classes)):
                        sums[:, c] += np.bincount(doc, weights=self.table[b, c], minlength=hi - lo)
                out[lo:hi] += sums / np.maximum(counts, 1)[:, None]
            lo = hi
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, calibrated probability, and whether it falls below the rejection threshold."""
        known = [i for i, t in enumerate(texts) if t and self.classes and _LETTER.search(t)]
        lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if known:
            p = softmax(self.logits([texts[i] for i in known]) / self.temperature)
            best = p.argmax(axis=1)
            for i, c, q in zip(known, best, p):
                lang[i], score[i], rejected[i] = self.classes[c], float(q[c]), bool(q[c] < self.threshold)
        return lang, score, rejected


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sparse(text: str, bits: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(letters(text), dtype=np.uint8)
    return np.unique(np.concatenate([subword_buckets(buf, n, bits)[1] for n in orders]), return_counts=True)


def training_rows(docs: DataFrame, label: Column, usable: Column, id_col: str, text_col: str, per_class: int, seed: str) -> DataFrame:
    """``(label, text)`` of about ``per_class`` rows of each label, chosen by a hash of the id.

    The number of rows per class is a parameter, not a share of the input: the
    classes are counted over all rows, then rows with a hash below
    ``per_class / count`` are taken. Every label there is takes part; their
    counts are broadcast.
    """
    rows = docs.where(usable & label.isNotNull() & F.col(text_col).isNotNull()).select(
        label.alias("label"), unit_hash(F.col(id_col), seed=seed).alias("__u"), F.col(text_col).cast("string").alias("text"))
    shares = rows.groupBy("label").agg((F.lit(float(per_class)) / F.count("*")).alias("__share"))
    return rows.join(F.broadcast(shares), "label").where(F.col("__u") < F.least(F.col("__share"), F.lit(1.0))).select("label", "text")


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_class: int = 700,
          dim: int = 16, bits: int = 15, orders: tuple[int, ...] = (2, 3, 4), epochs: int = 6, rate: float = 0.5,
          target_precision: float = 0.99, seed: int = 7) -> LanguageModel:
    """Fit the model on at most about ``per_class`` rows of each language among the ``usable`` ones.

    N-grams are counted on the executors over whole texts; the driver gets the
    bucket counts of each sampled row, ``2 ** bits`` at most. Rows with null
    text or language are not used; without any row the model has no class and
    answers ``und``.
    """
    prepare(docs.sparkSession)
    rows = training_rows(docs, F.col(lang_col).cast("string"), usable, id_col, text_col, per_class, "langid")

    def features(batches):
        for b in batches:
            f = [_sparse(t, bits, orders) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([x.astype(np.int32) for x, _ in f], pa.list_(pa.int32())),
                                              pa.array([c.astype(np.int32) for _, c in f], pa.list_(pa.int32()))], names=["label", "b", "c"])

    got = rows.mapInArrow(tidied(features), "label string, b array<int>, c array<int>").toArrow()
    labels = got.column("label").to_pylist()
    data = [(b, c.astype(np.float32)) for b, c in zip(list_arrays(got.column("b")), list_arrays(got.column("c")))]
    order = sorted((i for i in range(len(labels)) if len(data[i][0])), key=lambda i: (labels[i], len(data[i][0]), data[i][0].tobytes()))
    classes = sorted({labels[i] for i in order})
    if not classes:
        return LanguageModel([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0, 1.0, bits, orders)
    y = {c: k for k, c in enumerate(classes)}
    rng = np.random.default_rng(seed)
    order = [order[i] for i in rng.permutation(len(order))]
    cut = max(1, len(order) * 4 // 5)
    learn, hold = order[:cut], order[cut:]
    emb = rng.normal(0, 1 / dim, (1 << bits, dim))
    w, bias = rng.normal(0, 0.1, (dim, len(classes))), np.zeros(len(classes))
    steps, step = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learn)):
            b, c = data[learn[i]]
            weight = c / c.sum()
            h = weight @ emb[b]
            z = h @ w + bias
            e = np.exp(z - z.max())
            g = e / e.sum()
            g[y[labels[learn[i]]]] -= 1.0
            lr = rate * (1 - step / steps)
            step += 1
            back = w @ g
            w -= lr * np.outer(h, g)
            bias -= lr * 0.1 * g
            # a mean spreads its gradient over many rows; the scale keeps a row's step useful
            emb[b] -= (lr * 20.0) * np.outer(weight, back)
    table = emb @ w
    model = LanguageModel(classes, table, bias, 1.0, 0.0, bits, orders)
    hold = hold or learn
    z = np.array([(data[i][1] / data[i][1].sum()) @ table[data[i][0]] + bias for i in hold])
    t = np.array([y[labels[i]] for i in hold])
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(z / k)[np.arange(len(t)), t], 1e-12)).mean() for k in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    # the lowest threshold above which the kept predictions reach the wanted precision
    p = softmax(z / model.temperature)
    conf, right = p.max(axis=1), p.argmax(axis=1) == t
    by = np.argsort(-conf)
    good = np.cumsum(right[by]) / np.arange(1, len(by) + 1) >= target_precision
    model.threshold = float(conf[by][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, lang_pred, score, rejected)`` for every row, from the text alone.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no
    letter; ``rejected`` marks predictions below the calibrated threshold, which
    a filter should treat as unknown. Whole texts are read, very long ones in
    pieces whose sums are added. Repeated rows get equal answers; an empty table
    gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    base = docs.select(*[F.col(k) for k in keep], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches):
        for b in batches:
            lang, score, rejected = shared.value.predict(b.column("__text").to_pylist())
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], names=[*keep, "lang_pred", "score", "rejected"])

    return base.mapInArrow(tidied(run), f"{schema}, lang_pred string, score double, rejected boolean")
