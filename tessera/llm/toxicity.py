"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first (case, accents, look-alike letters, digits and signs
used as letters), so disguised spellings meet the same entries. An entry is a
whole word or the beginning of one; words inside an exception phrase do not
count. Weights are learned from labels as log ratios of document frequencies;
the sum of the matched weights, raw and by text length, goes through a small
logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stored, tidied
from tessera.llm.quality import labelled

#: letters of other scripts that look like Latin ones (by shape, lower case)
_LOOKALIKE = dict(zip("авеорсухкмнтіїјѕԁһԛԝгп" "αβεικνορτυχωγη" "ıøđłſ", "abeopcyxkmhtiijsdhqwrn" "abeikvoptuxwyn" "iodls"))
#: digits and signs used as letters, folded only next to a letter
_DIGIT = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
#: a whole run of them, of any length, with a letter at either end
_AS_LETTERS = re.compile(r"(?<=[^\W\d_])[01345789@$]+|[01345789@$]+(?=[^\W\d_])")
_DIGITS = str.maketrans(_DIGIT)
_LOOKALIKES = str.maketrans(_LOOKALIKE)
_ANY_LOOKALIKE = re.compile(f"[{''.join(_LOOKALIKE)}]")
_LATIN = re.compile("[a-z]")
_WORDS = re.compile(r"[^\W_]+")
_NOT_WORD = re.compile(r"[\W_]+")
_HIDDEN = re.compile("[­​-‏⁠﻿]")


class _Table(dict):
    """Translation of non-ASCII characters, filled as they occur."""

    def __missing__(self, code: int):
        ch = chr(code)
        if code < 128:
            out = ch
        else:
            out = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).lower() or ch
        self[code] = out
        return out


_TABLE = _Table()


def fold_text(text: str) -> str:
    """Words of the folded text between single spaces, with a space at both ends.

    Look-alike letters are folded in words that also have Latin letters; words
    wholly in another script stay as they are.
    """
    t = text.lower()
    if not t.isascii():
        t = _HIDDEN.sub("", t).translate(_TABLE)
        if _ANY_LOOKALIKE.search(t):
            t = _WORDS.sub(lambda m: m[0].translate(_LOOKALIKES) if _LATIN.search(m[0]) else m[0], t)
    t = _AS_LETTERS.sub(lambda m: m[0].translate(_DIGITS), t)
    return f" {_NOT_WORD.sub(' ', t).strip()} "


@dataclass
class ToxicityModel:
    """``lexicon`` maps a folded word, or a stem ending in ``*``, to its weight."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    center: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    coef: np.ndarray = field(default_factory=lambda: np.zeros(3))
    bias: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        entries: dict[str, tuple] = {}
        for term, w in self.lexicon.items():
            key = f" {term[:-1]}" if term.endswith("*") else f" {term} "
            entries[key] = (len(key), w, False)
        for phrase in self.exceptions:
            key = f" {fold_text(phrase).strip()} "
            entries[key] = (len(key), entries.get(key, (0, 0.0, False))[1], True)
        for key, value in entries.items():
            a.add_word(key, value)
        a.make_automaton()
        return a

    def features(self, text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, float, float]:
        """Log of the summed weight, log of the weight per hundred words, largest weight."""
        if not text or not len(automaton):
            return 0.0, 0.0, 0.0
        folded = fold_text(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, w, exempt) in automaton.iter(folded):
            start = end - size + 1
            if exempt:
                spared.append((start, end))
            elif w > best.get(start, 0.0):  # the strongest entry of a word counts
                best[start] = w
        if spared and best:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
        total = sum(best.values())
        words = max(1, folded.count(" ") - 1)
        return float(np.log1p(total)), float(np.log1p(100.0 * total / words)), max(best.values(), default=0.0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.center) / self.scale) @ self.coef + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@lru_cache(maxsize=2)
def _automaton_of(lexicon: tuple, exceptions: tuple) -> ahocorasick.Automaton:
    return ToxicityModel(dict(lexicon), exceptions).automaton()


def _terms(text: str, stems: tuple[int, int]) -> set[str]:
    out: set[str] = set()
    for w in set(fold_text(text).split()):
        out.add(w)
        out.update(w[:k] + "*" for k in range(stems[0], min(stems[1], len(w) - 1) + 1))
    return out


def learn_lexicon(rows: DataFrame, min_docs: int = 4, min_ratio: float = 1.5, min_deviance: float = 20.0,
                  stems: tuple[int, int] = (5, 8)) -> dict[str, float]:
    """Terms of label 1 texts with their log ratios, from ``(label, text)`` rows.

    Document frequencies of words and word beginnings are counted by a shuffle;
    the driver gets the terms whose deviance (likelihood ratio against equal
    frequencies) is ``min_deviance`` or more, a small share of the terms of the
    bounded sample. A stem is kept only if it says more than its own words do, that is if it is
    found in more label 1 texts than any of them.
    """
    def emit(batches):
        for b in batches:
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                t = sorted(_terms(text or "", stems))
                for i in range(0, len(t), 20_000):
                    part = t[i:i + 20_000]
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(part), pa.int32()), pa.array(part, pa.string())], names=["label", "term"])

    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}
    counts = rows.mapInArrow(tidied(emit), "label int, term string").groupBy("term").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")).where(F.col("pos") >= min_docs)
    ratio = F.log((F.col("pos") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(n0 + 1.0))
    share = n1 / (n1 + n0)
    both = F.col("pos") + F.col("neg")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (both * p))).otherwise(0.0)
    deviance = 2 * (part(F.col("pos"), share) + part(F.col("neg"), 1 - share))
    top = (counts.withColumn("ratio", ratio).withColumn("deviance", deviance)
           .where((F.col("ratio") >= min_ratio) & (F.col("deviance") >= min_deviance))
           .orderBy("term").collect())
    most: dict[str, int] = {}  # of the words with each beginning
    for r in top:
        if not r["term"].endswith("*"):
            for k in range(stems[0], min(stems[1], len(r["term"])) + 1):
                most[r["term"][:k]] = max(most.get(r["term"][:k], 0), r["pos"])
    out = {}
    for r in top:
        term = r["term"]
        if term.endswith("*") and most.get(term[:-1], 0) >= r["pos"]:
            continue
        out[term] = float(r["ratio"])
    return out


def learn_exceptions(rows: DataFrame, lexicon: dict[str, float], min_docs: int = 5) -> tuple[str, ...]:
    """Two-word phrases around entries that occur in at least ``min_docs`` label 0 texts and in no other, from ``(label, text)`` rows."""
    words = [t for t in lexicon if not t.endswith("*")]
    if not words:
        return ()

    def emit(batches):
        want = set(words)
        for b in batches:
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                ws = fold_text(text or "").split()
                got = set()
                for i, w in enumerate(ws):
                    if w in want:
                        if i:
                            got.add(f"{ws[i - 1]} {w}")
                        if i + 1 < len(ws):
                            got.add(f"{w} {ws[i + 1]}")
                if got:
                    got_list = sorted(got)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(got_list), pa.int32()), pa.array(got_list)], names=["label", "term"])

    top = (rows.mapInArrow(tidied(emit), "label int, term string").groupBy("term").agg(F.sum("label").alias("pos"), F.count("*").alias("n"))
           .where((F.col("pos") == 0) & (F.col("n") >= min_docs)).orderBy("term").collect())
    return tuple(r["term"] for r in top)


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = 3000, exceptions: tuple[str, ...] = (), **options) -> ToxicityModel:
    """Fit lexicon and curve on at most about ``per_class`` labelled rows of each class.

    Two thirds of the rows give the lexicon, the rest the curve, each row with its
    weight, so that the scores are for classes in the proportion of all labelled
    rows, however many of each are taken. ``exceptions``
    are added to the learned phrases. Without rows of both classes nothing
    matches and the score is the share of label 1 (0.5 without rows).
    """
    prepare(docs.sparkSession)
    rows, _ = stored(labelled(docs, labels, label_col, usable, per_class, id_col, text_col, "toxicity"), "toxicity-rows")
    part = F.pmod(F.xxhash64("text"), F.lit(3))
    words = rows.where(part != 0).select("label", "text")
    lexicon = learn_lexicon(words, **options)
    model = ToxicityModel(lexicon, tuple(sorted({*exceptions, *learn_exceptions(words, lexicon)})))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches):
        m = shared.value
        a = m.automaton()
        for b in batches:
            x = [m.features(t, a) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("weight"), *[pa.array([r[k] for r in x], pa.float64()) for k in range(3)]],
                                             names=["label", "weight", "a", "b", "c"])

    got = rows.where(part == 0).mapInArrow(tidied(features), "label int, weight double, a double, b double, c double").toPandas()
    got = got.sort_values(["label", "a", "b", "c"])
    y = got["label"].to_numpy(dtype=float)
    if len(set(y.tolist())) < 2:
        p = float(y.mean()) if len(y) else 0.5
        model.bias = float(np.log(max(p, 1e-3) / max(1 - p, 1e-3)))
        return model
    x = got[["a", "b", "c"]].to_numpy(dtype=float)
    weight = got["weight"].to_numpy(dtype=float)
    weight = weight / weight.mean()
    model.center = np.average(x, axis=0, weights=weight)
    model.scale = np.maximum(np.sqrt(np.average((x - model.center) ** 2, axis=0, weights=weight)), 1e-9)
    z = np.column_stack([(x - model.center) / model.scale, np.ones(len(x))])
    theta = np.zeros(4)
    ridge = np.diag([1e-2, 1e-2, 1e-2, 1e-6]) * len(x)
    for _ in range(60):  # Newton steps of a ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -35, 35)))
        g = z.T @ (weight * (p - y)) + ridge @ theta * 0.1
        h = (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + ridge * 0.1
        step = np.linalg.solve(h, g)
        step *= 1.0 / max(1.0, float(np.abs(step).max()) / 2)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    model.coef, model.bias = theta[:3], float(theta[3])
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keep, score)`` for every row, from the whole text alone.

    Null and empty texts have no match and get the score of such a text; repeated
    rows get equal scores; an empty table gives no rows; columns not named are
    not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    base = docs.select(*[F.col(k) for k in keep], F.col(text_col).cast("string").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])

    def run(batches):
        m = shared.value
        a = _automaton_of(tuple(m.lexicon.items()), m.exceptions)
        for b in batches:
            x = np.array([m.features(t, a) for t in b.column("__text").to_pylist()], dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], pa.array(m.probability(x), pa.float64())], names=[*keep, "score"])

    return base.mapInArrow(tidied(run), f"{schema}, score double")
