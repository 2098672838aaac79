"""Periodic runs of words: stretches that repeat a phrase at least four times.

Seed and extend along diagonals. A run of period q in [2^j, 2^(j+1)) matches
itself shifted by q over at least three periods, so it holds a k-gram of that
guaranteed overlap twice, q words apart. For every scale j the k-grams are
indexed by exact names (the name of a 2k-gram is the name of a pair of k-grams),
each occurrence is paired with the next one in the same document, and pairs whose
lag belongs to the scale are seeds. As k is at least q there, two occurrences
inside a run of smallest period q are a multiple of q apart: the next occurrence
is enough, and its lag is the smallest period. A seed is extended word by word in
both directions unless the furthest position covered at its lag lies beyond it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, tidied

#: documents are searched together up to this many words; a longer one is searched alone
GROUP_WORDS = 300_000
RUN_TYPE = "array<struct<start:long,length:long,period:long>>"


def _named(keys: np.ndarray, at: np.ndarray, size: int):
    """Names of equal keys that occur more than once, and each such place with the next of its name.

    ``at`` are ascending places. Returns ``(names by place, -1 elsewhere; place; next place)``.
    """
    names = np.full(size, -1, dtype=np.int64)
    if not len(at):
        return names, at, at
    order = np.argsort(keys, kind="stable")
    k, p = keys[order], at[order]
    same = k[1:] == k[:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    again = np.zeros(len(p), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    names[p[again]] = group[again]
    return names, p[:-1][same], p[1:][same]


def _longer(a: np.ndarray, b: np.ndarray, ka: int, kb: int, end: np.ndarray):
    """Grams of ``ka + kb`` words named by the names of their two ends; grams that do not repeat are left out."""
    size = len(a)
    at = np.flatnonzero(a >= 0)
    at = at[at + ka + kb <= end[at]]
    right = b[at + ka]
    at, right = at[right >= 0], right[right >= 0]
    return _named(a[at] * np.int64(size + 1) + right, at, size)


def _reach(words: np.ndarray, at: int, lag: int, stop: int, step: int) -> int:
    """First place from ``at`` in direction ``step`` whose word differs from the one ``lag`` further (or ``stop``)."""
    width = 32
    while at != stop:
        width = min(width * 2, abs(stop - at))
        lo, hi = (at, at + width) if step > 0 else (at - width + 1, at + 1)
        differ = np.flatnonzero(words[lo:hi] != words[lo + lag:hi + lag])
        if len(differ):
            return int(lo + (differ[0] if step > 0 else differ[-1]))
        at += step * width
    return stop


def find_runs(words: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray,
              min_length: int = 6, min_periods: int = 4) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every maximal run, starts counted over all documents laid end to end.

    ``words`` are word numbers, ``doc`` the document of each place, ``first`` and
    ``last`` the bounds of the documents.
    """
    size = len(words)
    end = last[doc] if size else doc
    one, _, _ = _named(doc * np.int64(int(words.max(initial=0)) + 1) + words, np.arange(size), size)
    runs: list[tuple[int, int, int]] = []
    covered: dict[int, int] = {}
    grams = {1: one}

    def gram(k: int):
        """Names of k-grams with the seeds, built from those of about half the length."""
        if k == 1:
            return one, None, None
        left = (k + 1) // 2
        if left not in grams:
            grams[left] = gram(left)[0]
        if k - left not in grams:
            grams[k - left] = gram(k - left)[0]
        return _longer(grams[left], grams[k - left], left, k - left, end)

    low = 1
    while low * min_periods <= int((last - first).max(initial=0)):
        high = 2 * low
        k = min(max(min_length, min_periods * q) - q for q in range(low, min(high, low + min_length)))
        names, here, there = gram(k)
        grams = {g: v for g, v in grams.items() if g == 1 or low == 1 or g * 4 >= k} | {k: names}
        lag = there - here
        mine = (lag >= low) & (lag < high)
        here, lag = here[mine], lag[mine]
        order = np.lexsort((here, lag))
        here, lag = here[order], lag[order]
        # seeds in a row at one lag belong to one match: only the first is looked at
        head = np.ones(len(here), dtype=bool)
        head[1:] = (lag[1:] != lag[:-1]) | (here[1:] != here[:-1] + 1)
        for at, q in zip(here[head].tolist(), lag[head].tolist()):
            if covered.get(q, -1) > at:
                continue
            lo, hi = int(first[doc[at]]), int(last[doc[at]])
            right = _reach(words, at + k, q, hi - q, 1)
            left = _reach(words, at - 1, q, lo - 1, -1) + 1
            covered[q] = right
            if right - left + q >= max(min_length, min_periods * q):
                runs.append((left, right - left + q, q))
        low = high
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _groups(texts: list[bytes | None]):
    """Documents' words in lists of up to ``GROUP_WORDS`` words, with the number of the first document."""
    at, held, count = 0, [], 0
    for i, raw in enumerate(texts):
        words = raw.split() if raw else []
        if held and count + len(words) > GROUP_WORDS:
            yield at, held
            at, held, count = i, [], 0
        held.append(words)
        count += len(words)
    if held:
        yield at, held


def search(texts: list[bytes | None], min_length: int = 6, min_periods: int = 4):
    """For each text: number of words, runs, and the text collapsed to one period of each run."""
    out: list[tuple[int, list[dict], bytes]] = []
    for _, held in _groups(texts):
        lengths = np.array([len(w) for w in held], dtype=np.int64)
        last = np.cumsum(lengths)
        first = last - lengths
        number: dict[bytes, int] = {}
        flat = np.fromiter((number.setdefault(w, len(number)) for ws in held for w in ws), dtype=np.int64, count=int(lengths.sum()))
        doc = np.repeat(np.arange(len(held), dtype=np.int64), lengths)
        runs: list[list[dict]] = [[] for _ in held]
        drop = np.zeros(len(flat), dtype=bool)
        for start, length, period in find_runs(flat, doc, first, last, min_length, min_periods):
            d = int(doc[start])
            runs[d].append({"start": start - int(first[d]), "length": length, "period": period})
            drop[start + period:start + length] = True
        for d, words in enumerate(held):
            if runs[d]:
                gone = drop[first[d]:last[d]].tolist()
                words = [w for w, g in zip(words, gone) if not g]
            out.append((int(lengths[d]), runs[d], b" ".join(words)))
    return out


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                  min_length: int = 6, min_periods: int = 4) -> DataFrame:
    """``(*keep, n_words, runs, collapsed)`` for every row of ``docs``.

    Words are runs of anything but ASCII white space. A run is a maximal stretch
    of words with smallest period q of at least ``max(min_length, min_periods *
    q)`` words; ``runs`` has start, length and period by start, then period.
    ``collapsed`` is the kept words joined by one space, without the words that
    any run contains after its first q. ``min_periods`` is at least 3: below
    that the next occurrence of a k-gram is not enough.

    Null and empty texts have no words, no runs and the empty collapsed text;
    rows that repeat are each reported; null ids are kept; an empty table gives
    no rows; columns not named are not read. A text is searched as a whole in
    the task that reads it: there is no shuffle, and no pair of distant
    occurrences is ever made.
    """
    if min_periods < 3 or min_length < 2:
        raise ValueError("min_periods is at least 3, min_length at least 2")
    prepare(docs.sparkSession)
    base = docs.select(*[F.col(k) for k in keep], F.col(text_col).cast("string").cast("binary").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    run_t = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for big in batches:
            for lo in range(0, big.num_rows, 256):
                b = big.slice(lo, 256)
                found = search(b.column("__text").to_pylist(), min_length, min_periods)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(k) for k in keep], pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], run_t),
                     pa.array([f[2] for f in found], pa.binary())], names=[*keep, "n_words", "runs", "collapsed"])

    out = base.mapInArrow(tidied(run), f"{fields}, n_words long, runs {RUN_TYPE}, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))
