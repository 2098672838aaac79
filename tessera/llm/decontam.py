"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every substring (in words) of the normalised test items.
A document is streamed through it word by word; the state and the longest
matching length at each position tell which item windows end there.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stored, tidied

#: bytes to words: A-Z lower-cased; ASCII other than digits and letters separates
_TO_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) else 32
                  for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | bytes | None) -> list[bytes]:
    """Normalised words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    if text is None:
        return []
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(_TO_WORDS).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word ids of several items.

    ``scan(ids)`` yields ``(end, window_length, item_ids)`` for every position at
    which a window of an item ends: ``window`` consecutive words of it, or the
    whole item where it has fewer.
    """

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[list] = [[]]
        self.short: dict[int, list[tuple[int, object]]] = {}
        for item, ids in items:
            if not ids:
                continue
            last = 0
            for w in ids:
                last = self._add(last, w, ends)
                ends[last].append(item)
            if len(ids) < window:
                self.short.setdefault(last, []).append((len(ids), item))
        # items that hold the window ending in a state: its own ends and those of the states below it
        order = sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True)
        found: list[set] = [set(e) for e in ends]
        for s in order:
            up = self.link[s]
            if self.len[up] >= window:
                found[up] |= found[s]
        self.items = {s: frozenset(found[s]) for s in order if self.len[s] >= window > self.len[self.link[s]]}
        # next state up the links that is the end of a short item
        self.up = [0] * len(self.len)
        for s in reversed(order):
            p = self.link[s]
            self.up[s] = p if p in self.short else self.up[p] if p > 0 else 0

    def _add(self, last: int, w: int, ends: list) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, q, w, ends)
        cur = self._state(length[last] + 1, {}, ends)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, q, w, ends)
        return cur

    def _split(self, p: int, q: int, w: int, ends: list) -> int:
        nxt, link, length = self.next, self.link, self.len
        copy = self._state(length[p] + 1, dict(nxt[q]), ends)
        link[copy], link[q] = link[q], copy
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def _state(self, length: int, edges: dict[int, int], ends: list) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.len.append(length)
        ends.append([])
        return len(self.len) - 1

    def scan(self, ids):
        nxt, link, length, window = self.next, self.link, self.len, self.window
        s = n = 0
        for i, w in enumerate(ids):
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                n += 1
            if n >= window:
                t = s
                while length[link[t]] >= window:
                    t = link[t]
                yield i, window, self.items[t]
            t = s if s in self.short else self.up[s]
            while t:
                for size, item in self.short[t]:
                    if size <= n:
                        yield i, size, (item,)
                t = self.up[t]


class Matcher:
    """Automaton, vocabulary and a screen of adjacent word pairs for one block of items.

    A window of ``k`` words needs ``k - 1`` adjacent pairs that occur in items;
    pairs are looked up in a fixed table of bits (false positives only), and the
    automaton reads just the runs that are long enough.
    """

    BITS = 22

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        vocab: dict[bytes, int] = {}
        coded = [(i, [vocab.setdefault(w, len(vocab) + 1) for w in ws]) for i, ws in items]
        self.vocab = vocab
        self.automaton = SuffixAutomaton(coded, window)
        self.least = min([window, *(len(ws) for _, ws in items if ws)])
        self.pairs = np.zeros(1 << self.BITS, dtype=bool)
        for _, ids in coded:
            if len(ids) > 1:
                a = np.asarray(ids, dtype=np.uint64)
                self.pairs[self._slot(a[:-1], a[1:])] = True

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((a * np.uint64(0x9E3779B97F4A7C15) + b) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.BITS)

    def match(self, docs: list[list[bytes]]) -> dict[int, list[tuple[int, int, tuple]]]:
        """For each document with a window: ``(start, end, items)`` in word positions, end exclusive."""
        get = self.vocab.get
        ids: list[int] = []
        starts = []
        for ws in docs:
            starts.append(len(ids))
            ids += [get(w, 0) for w in ws]
            ids.append(0)
        flat = np.asarray(ids, dtype=np.uint64)
        on = flat > 0
        if self.least > 1:
            on = on[:-1] & on[1:]
            at = np.flatnonzero(on)
            on[at] = self.pairs[self._slot(flat[at], flat[at + 1])]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
        begin, stop = edge[::2], edge[1::2]
        need = self.least - 1 if self.least > 1 else 1
        keep = stop - begin >= need
        out: dict[int, list] = {}
        starts_arr = np.asarray(starts)
        extra = 1 if self.least > 1 else 0
        for a, b in zip(begin[keep].tolist(), (stop[keep] + extra).tolist()):
            d = int(np.searchsorted(starts_arr, a, side="right")) - 1
            for i, size, items in self.automaton.scan(ids[a:b]):
                end = a + i + 1 - starts[d]
                out.setdefault(d, []).append((end - size, end, items))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """Items in blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    block, n = [], 0
    rows = items.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").cast("binary").alias("t"))
    for r in rows.dropDuplicates().toLocalIterator():
        ws = words_of(bytes(r["t"])) if r["t"] is not None else []
        if not ws:
            continue
        if block and n + len(ws) > block_words:
            yield block
            block, n = [], 0
        block.append((r["i"], ws))
        n += len(ws)
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", window: int = 10, block_words: int = 200_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id_col, *keep, text, n_words, spans, items)``, one row a document.

    ``spans`` are the merged word ranges ``[start, end)`` covered by item windows,
    ``items`` the ids (as text) of the items with a window in the document.
    Windows are ``window`` consecutive words of an item, or all words of an item
    with fewer. Null or empty texts have no words and no spans, null or empty
    items no windows; items with equal texts are found under each id; items with
    a null id mark spans without being listed; rows that repeat are each
    reported; empty tables are allowed on both sides. Only the named columns are
    read. Texts stay where they are: there is no shuffle.

    The items are read through the driver one by one and broadcast in blocks of
    ``block_words`` words, which makes an automaton of at most twice as many
    states (about 100 MB by default); the usual test set is one block, and
    further blocks each make another pass over the documents. Only one block is
    held at a time.
    """
    spark = docs.sparkSession
    prepare(spark)
    cur = _unsearched(docs, id_col, text_col, keep)
    schema = cur.schema
    blocks = _blocks(items, id_col=item_id_col, text_col=item_text_col, block_words=block_words)
    for k, block in enumerate(itertools.chain([next(blocks, [])], blocks)):
        if k:
            cur, _ = stored(cur, "leaks-block")
        shared = spark.sparkContext.broadcast(Matcher([(None if i is None else str(i), ws) for i, ws in block], window))

        def run(batches, shared=shared):
            for b, cols in _matched(batches, shared.value):
                yield pa.RecordBatch.from_arrays([cols[n] if n in cols else b.column(n) for n in b.schema.names], names=b.schema.names)

        cur = cur.mapInArrow(tidied(run), schema)
    return cur.select(id_col, *keep, F.col("__text").cast("string").alias("text"), "n_words", "spans", "items")


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _unsearched(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``(id_col, *keep, __text, n_words, spans, items)`` with nothing found yet."""
    cur = docs.select(F.col(id_col), *[F.col(k) for k in keep], F.col(text_col).cast("string").cast("binary").alias("__text"))
    return cur.withColumns({"n_words": F.lit(None).cast("long"), "spans": F.array().cast("array<struct<start:int,end:int>>"),
                            "items": F.array().cast("array<string>")})


def _matched(batches, matcher: Matcher):
    """Parts of the batches with their new ``n_words``, ``spans`` and ``items``: what was found before and what ``matcher`` finds."""
    for big in batches:
        for lo in range(0, big.num_rows, 512):
            b = big.slice(lo, 512)
            docs_words = [words_of(t) for t in b.column("__text").to_pylist()]
            spans, found = b.column("spans").to_pylist(), b.column("items").to_pylist()
            for d, hits in matcher.match(docs_words).items():
                spans[d] = merge(([(s["start"], s["end"]) for s in spans[d]]) + [(s, e) for s, e, _ in hits])
                got = set(found[d])
                for ids in {h[2] for h in hits}:
                    got.update(i for i in ids if i is not None)
                found[d] = sorted(got)
            yield b, {"n_words": pa.array([len(w) for w in docs_words], pa.int64()), "spans": pa.array(spans, _SPANS),
                      "items": pa.array(found, pa.list_(pa.string()))}


def merge(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def remove_spans(raw: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and the white space and signs between them."""
    if not spans:
        return raw
    places = [m.span() for m in _WORD.finditer(raw)]
    out, at = [], 0
    for s in spans:
        out.append(raw[at:places[s["start"]][0]])
        at = places[s["end"] - 1][1]
    out.append(raw[at:])
    return b"".join(out)


def decontaminate(docs: DataFrame, items: DataFrame, max_coverage: float = 0.5, min_words: int = 0, **options) -> DataFrame:
    """Documents without benchmark passages: ``find_leaks`` columns and ``n_hit``, ``text`` cleaned.

    Spans are cut out of the text. Words that a cut brings together may form a
    window again; such texts are searched and cut again until none is left, and
    ``n_hit`` counts all words cut. A document of which more than
    ``max_coverage`` of the words are cut, or that keeps fewer than
    ``min_words`` words after a cut, goes. ``spans``, ``items`` and ``n_words``
    are those of the text as it came. Documents without spans are returned
    unchanged, whatever their length. Edge cases as in ``find_leaks``.
    """
    keep = tuple(options.pop("keep", ()))
    id_col = options.get("id_col", "doc_id")
    ordinary = (id_col, *keep, "text", "n_words", "spans", "items", "n_hit")
    allowed = (F.col("n_hit") <= max_coverage * F.col("n_words")) & (F.col("n_words") - F.col("n_hit") >= min_words)
    block_options = {k: options[k] for k in ("block_words",) if k in options}
    blocks = _blocks(items, id_col=options.get("item_id_col", "item_id"), text_col=options.get("item_text_col", "text"), **({"block_words": 200_000} | block_options))
    only, more = next(blocks, []), next(blocks, None)
    if more is None:  # one automaton holds all items: a text is searched, cut and searched again where it lies, by one worker
        spark = docs.sparkSession
        prepare(spark)
        shared = spark.sparkContext.broadcast(Matcher([(None if i is None else str(i), ws) for i, ws in only], options.get("window", 10)))
        base = _unsearched(docs, id_col, options.get("text_col", "text"), keep).withColumn("n_hit", F.lit(None).cast("int"))

        def clean(batches):
            matcher = shared.value
            for b, cols in _matched(batches, matcher):
                texts, hit = None, [0] * b.num_rows
                for i, spans in enumerate(cols["spans"].to_pylist()):
                    while spans:
                        texts = texts or b.column("__text").to_pylist()
                        hit[i] += sum(s["end"] - s["start"] for s in spans)
                        texts[i] = remove_spans(texts[i], spans).decode(errors="replace").encode()
                        spans = merge([(s, e) for s, e, _ in matcher.match([words_of(texts[i])]).get(0, [])])
                cols["n_hit"] = pa.array(hit, pa.int32())
                if texts is not None:
                    cols["__text"] = pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_arrays([cols[n] if n in cols else b.column(n) for n in b.schema.names], names=b.schema.names)

        found = base.mapInArrow(tidied(clean), base.schema).where((F.col("n_hit") == 0) | allowed)
        return found.withColumn("text", F.col("__text").cast("string")).select(*ordinary)
    hits = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"])
    found = find_leaks(docs, items, keep=keep, **options).withColumn("n_hit", hits)
    schema = found.schema

    def cut(batches):
        for b in batches:
            texts, spans = b.column("text").to_pylist(), b.column("spans").to_pylist()
            new = [remove_spans(t.encode(), s).decode(errors="replace") if s else t for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else b.column(n) for n in b.schema.names],
                                             names=b.schema.names)

    cleaned, _ = stored(found.where((F.col("n_hit") == 0) | allowed).mapInArrow(tidied(cut), schema), "leaks-cut")
    out, again = cleaned.where("n_hit = 0"), cleaned.where("n_hit > 0")
    before = [F.col(c).alias(f"__{c}") for c in ("n_words", "spans", "items", "n_hit")]
    again_options = {**options, "text_col": "text"}
    while again.limit(1).count():
        # what was cut last time, searched once more; each turn that finds something cuts at least a word
        turn = find_leaks(again.select(id_col, *keep, "text", *before), items, keep=(*keep, "__n_words", "__spans", "__items", "__n_hit"), **again_options)
        turn = turn.withColumn("n_hit", hits)
        dirty = turn.mapInArrow(tidied(cut), turn.schema).withColumns(
            {"new": F.col("n_hit"), "n_hit": F.col("n_hit") + F.col("__n_hit"), **{c: F.col(f"__{c}") for c in ("n_words", "spans", "items")}})
        dirty, _ = stored(dirty.where((F.col("new") == 0) | allowed), "leaks-again")
        out = out.unionByName(dirty.where("new = 0").select(*ordinary))
        again = dirty.where("new > 0").select(*ordinary)
    return out.select(*ordinary)
