"""Documents packed into sequences of several lengths.

Hierarchical packing: whole long windows of a long document are sequences at
once; the rest of every document is routed to the smallest context size (tier)
that holds it. Tiers are packed from the longest down: a window opens with a
document of its tier, its gap takes the longest documents of shorter tiers that
fit, and what gap remains takes a cut of a shorter document (of its own tier if
there is none), whose rest is routed anew. So every sequence is exactly as long
as its tier. What cannot fill the shortest window goes on to the next documents
of the task, and from the end of a task to a second, small pass over the rests of
all tasks. Sequences of one length are dealt to step groups of equal token
numbers and nearly equal attention cost.

A task packs the documents it reads, so texts are never shuffled.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, scratch_path, tidied

#: id that ends every document
END_ID = 1
TIERS = (2048, 1024, 512, 256)
#: documents of a task are packed together up to this many tokens
UNIT_TOKENS = 1 << 20
#: rows of rests that one task of the second pass takes
REST_ROWS = 100_000


def _byte_letters() -> dict[int, str]:
    """The usual letters of byte-level vocabularies: printable bytes stand for themselves, others for 256, 257, and so on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()
#: signs that end words and begin no other token (the apostrophe does)
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: pre-tokenizer pattern for which words need not be taken apart by the library (fixed value)
_PLAIN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Recent(dict):
    """A cache of two generations: what neither of the last ``kept`` new entries nor those before used goes."""

    def __init__(self, kept: int):
        super().__init__()
        self.kept, self.old = kept, {}

    def put(self, key, value):
        if len(self) >= self.kept:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordIds(_Recent):
    """Ids of a white-space word as little-endian unsigned 32-bit bytes, computed once per word.

    For vocabularies whose pre-tokenizer drops white space and whose normalizer
    works on each word alone; ASCII white space then always ends a token, so the
    ids of a text are those of its words. ``text_ids`` gives the ids of a whole
    text that way. Words of Latin letters with signs at their end, most of all
    words, are normalised and split here as the library does; all others by it.
    """

    #: entries of a generation of either cache; longer words are not kept at all
    KEPT, LONG = 250_000, 48

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__(self.KEPT)
        self.tokenizer = Tokenizer.from_str(spec)
        self.parts = _Recent(self.KEPT)
        self.tokenize = self.tokenizer.model.tokenize
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.plain = _PLAIN_SPLIT in json.dumps(json.loads(spec)["pre_tokenizer"], ensure_ascii=False).replace("\\\\", "\\")

    def _part(self, piece: str) -> bytes:
        """Ids of a piece in byte letters."""
        parts = self.parts
        got = parts.get(piece)
        if got is None:
            got = parts.old.get(piece)
            if got is None:
                id_bytes = self.id_bytes
                got = b"".join([id_bytes[t.id] for t in self.tokenize(piece)])
            if len(piece) <= self.LONG:
                parts.put(piece, got)
        return got

    def __missing__(self, raw: bytes) -> bytes:
        ids = self.old.get(raw)
        if ids is None:
            word = raw.decode("utf-8", errors="replace")
            # composed letters only, whose lower case does not depend on others; "<|" may begin a special token
            if self.plain and "<|" not in word and (word.isascii() or max(word) < "\u0250"):
                norm = word.lower()
                core = norm if norm.isalpha() else norm.rstrip(_SIGNS)
                if core.isalpha():
                    ids = self._part(core if core.isascii() else core.encode().decode("latin-1").translate(_LETTERS))
                    if len(core) < len(norm):
                        ids += self._part(norm[len(core):])
            if ids is None:
                ids = self._by_library(word)
        if len(raw) <= self.LONG:
            self.put(raw, ids)
        return ids

    def _by_library(self, word: str) -> bytes:
        t = self.tokenizer
        if "<|" in word:
            return b"".join([self.id_bytes[i] for i in t.encode(word, add_special_tokens=False).ids])
        pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(word) if t.normalizer else word)
        return b"".join([self._part(p) for p, _ in pieces])

    def text_ids(self, raw: bytes) -> bytes:
        return b"".join(map(self.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def word_ids(spec: str) -> WordIds:
    return WordIds(spec)


class Pool:
    """Fragments ``(document, start, length)`` of one task, found by length."""

    def __init__(self):
        self.lengths: list[int] = []
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.tokens = 0

    def add(self, doc: int, start: int, length: int) -> None:
        if length not in self.by_length:
            self.by_length[length] = []
            insort(self.lengths, length)
        self.by_length[length].append((doc, start))
        self.tokens += length

    def take(self, at_most: int) -> tuple[int, int, int] | None:
        """The longest fragment of up to ``at_most`` ids."""
        k = bisect_right(self.lengths, at_most) - 1
        if k < 0:
            return None
        length = self.lengths[k]
        doc, start = self.by_length[length].pop()
        if not self.by_length[length]:
            del self.by_length[length]
            del self.lengths[k]
        self.tokens -= length
        return doc, start, length


def pack(pool: Pool, tiers: tuple[int, ...]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """``(window size, fragments)`` of full windows; fewer ids than the smallest tier stay in ``pool``."""
    out = []
    top = tiers[0]
    while pool.lengths and pool.lengths[-1] >= top:
        doc, start, length = pool.take(pool.lengths[-1])
        whole = length // top
        out += [(top, [(doc, start + k * top, top)]) for k in range(whole)]
        if length % top:
            pool.add(doc, start + whole * top, length % top)
    for size, shorter in zip(tiers, (*tiers[1:], 0)):
        while pool.tokens >= size and pool.lengths[-1] > shorter:
            window, gap = [], size
            # opens with the longest; then the longest of a shorter tier that fits
            got = pool.take(pool.lengths[-1])
            while got or gap:
                if got is None:  # none fits: one of the next shorter tiers, or of this one, is cut
                    got = pool.take(max(shorter, gap)) or pool.take(pool.lengths[-1])
                doc, start, length = got
                if length > gap:
                    pool.add(doc, start + gap, length - gap)
                    length = gap
                window.append((doc, start, length))
                gap -= length
                got = pool.take(min(gap, shorter or gap)) if gap else None
            out.append((size, window))
    return out


class Packer:
    """Packs the documents of one task, unit by unit; yields rows of pieces.

    ``last``: the rest that fills no window becomes one padded sequence instead
    of rows for the second pass.
    """

    def __init__(self, base: int, tiers: tuple[int, ...], step_tokens: int, last: bool):
        self.base, self.tiers, self.step_tokens, self.last = base, tiers, step_tokens, last
        self.docs: list[tuple] = []
        self.pool = Pool()
        self.sequences = self.steps = 0
        self.open: dict[int, list] = {}

    def add(self, keep: tuple, ids: bytes, start: int, doc_tokens: int) -> None:
        """Ids of a document, or of a piece of it that begins at ``start``."""
        self.docs.append((keep, ids, start, doc_tokens))
        self.pool.add(len(self.docs) - 1, 0, len(ids) // 4)

    def _row(self, fragment, sequence, offset, window, step, rest=False):
        doc, start, length = fragment
        keep, ids, before, doc_tokens = self.docs[doc]
        part = ids[4 * start:4 * (start + length)]
        return (*keep, before + start, length, zlib.crc32(part), doc_tokens, sequence, offset, window, step, part, rest)

    def _window(self, size: int, fragments) -> tuple[int, list]:
        rows, offset = [], 0
        for f in fragments:
            rows.append(self._row(f, self.base | self.sequences, offset, size, None))
            offset += f[2]
        self.sequences += 1
        return sum(f[2] ** 2 for f in fragments), rows

    def _steps(self, size: int, full: int):
        """``full`` step groups of the windows that wait at this size, dealt in turn from the costliest."""
        per, waiting = max(1, self.step_tokens // size), self.open.get(size, [])
        n = min(len(waiting), full * per)
        waiting.sort(key=lambda w: -w[0])
        # the costliest and the cheapest alike, so that what goes on waiting is not one kind only
        for i, (_, rows) in enumerate(waiting[:n]):
            turn, k = divmod(i, full)
            step = self.base | (self.steps + (k if turn % 2 == 0 else full - 1 - k))
            for r in rows:
                yield (*r[:-3], step, *r[-2:])
        if n:
            self.steps += full
            self.open[size] = waiting[n:]

    def unit(self):
        for size, fragments in pack(self.pool, self.tiers):
            self.open.setdefault(size, []).append(self._window(size, fragments))
        for size in self.tiers:
            yield from self._steps(size, len(self.open.get(size, [])) // max(1, self.step_tokens // size))
        # the rest, at most one short window, moves to the front of the next unit
        left = []
        while self.pool.lengths:
            left.append(self.pool.take(self.pool.lengths[-1]))
        docs = self.docs
        self.docs, self.pool = [], Pool()
        for doc, start, length in left:
            keep, ids, before, doc_tokens = docs[doc]
            self.add(keep, ids[4 * start:4 * (start + length)], before + start, doc_tokens)

    def end(self):
        yield from self.unit()
        for size in self.tiers:
            if self.open.get(size):
                yield from self._steps(size, 1)
        left = []
        while self.pool.lengths:
            left.append(self.pool.take(self.pool.lengths[-1]))
        if self.last and left:
            _, rows = self._window(self.tiers[0], left)
            for r in rows:
                yield (*r[:-3], self.base | self.steps, *r[-2:])
        else:
            for f in left:
                yield self._row(f, None, None, None, None, True)


COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_id long, ids binary"


def _batches(rows, schema: pa.Schema, with_ids: bool):
    held = []

    def made():
        cols = list(zip(*held))
        if not with_ids:  # ids of rests are needed by the second pass
            cols[-2] = [i if rest else None for i, rest in zip(cols[-2], cols[-1])]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    for r in rows:
        held.append(r)
        if len(held) == 4096:
            yield made()
            held = []
    if held:
        yield made()


def pack_documents(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), tiers: tuple[int, ...] = TIERS,
                   step_tokens: int = 16_384, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """``(*keep, start, length, ids_crc32, doc_tokens, sequence_id, offset, window, step_id, ids)``, one row a piece.

    A document is the ids of its text and ``END_ID``. Each id lies in exactly one
    piece: ids ``start`` to ``start + length`` of the document at ``offset`` of a
    sequence of ``window`` ids. All sequences are full but one for each task of
    the second pass, which is padded to the longest window. ``step_id`` groups
    sequences of one length: ``step_tokens`` ids each, fewer in the last group of
    a length in a task. ``ids`` are little-endian unsigned 32-bit bytes, null
    unless ``with_ids``.

    ``tokenizer`` is the path of a vocabulary file of the library `tokenizers`
    on the driver (by default the public lower-case word vocabulary); it reaches
    the executors by broadcast. Its pre-tokenizer must drop white space.

    Null and empty texts are documents of ``END_ID`` alone; null and repeated ids
    are kept, rows that repeat are packed each; an empty table gives no rows;
    columns not named are not read. Which documents share a sequence depends on
    how the input is split into tasks; the written pieces are what later steps
    read, so a retried task changes nothing.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two, longest first")
    spark = docs.sparkSession
    prepare(spark)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    with open(tokenizer, encoding="utf-8") as fh:
        spec = spark.sparkContext.broadcast(fh.read())
    base = docs.select(*[F.col(k) for k in keep], F.col(text_col).cast("string").cast("binary").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    schema = f"{fields}, {COLUMNS}, rest boolean"
    numbers = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
               ("sequence_id", pa.int64()), ("offset", pa.int64()), ("window", pa.int32()), ("step_id", pa.int64()),
               ("ids", pa.binary()), ("rest", pa.bool_())]
    names = len(keep)
    ender = END_ID.to_bytes(4, "little")

    def first(batches):
        task = TaskContext.get().partitionId()
        packer, out_schema = Packer(task << 32, tiers, step_tokens, False), []
        ids_of = word_ids(spec.value)

        def rows():
            for b in batches:
                if not out_schema:
                    out_schema.append(pa.schema([*list(b.schema)[:names], *[pa.field(*n) for n in numbers]]))
                kept = [b.column(k).to_pylist() for k in range(names)]
                for i, raw in enumerate(b.column(names)):
                    ids = ids_of.text_ids(raw.as_py() or b"") + ender
                    packer.add(tuple(c[i] for c in kept), ids, 0, len(ids) // 4)
                    if packer.pool.tokens >= UNIT_TOKENS:
                        yield from packer.unit()
            yield from packer.end()

        made = rows()
        for head in made:  # the schema is known once a row was read
            def again(head=head):
                yield head
                yield from made
            yield from _batches(again(), out_schema[0], with_ids)

    def second(batches):
        task = TaskContext.get().partitionId()
        packer, out_schema = Packer(1 << 62 | task << 32, tiers, step_tokens, True), None

        def rows():
            nonlocal out_schema
            for b in batches:
                out_schema = pa.schema([*list(b.schema)[:names], *[pa.field(*n) for n in numbers]])
                cols = {c: b.column(c).to_pylist() for c in ("start", "doc_tokens", "ids")}
                kept = [b.column(k).to_pylist() for k in range(names)]
                for i, ids in enumerate(cols["ids"]):
                    packer.add(tuple(c[i] for c in kept), ids, cols["start"][i], cols["doc_tokens"][i])
                    if packer.pool.tokens >= UNIT_TOKENS:
                        yield from packer.unit()
            yield from packer.end()

        made = rows()
        for head in made:
            def again(head=head):
                yield head
                yield from made
            yield from _batches(again(), out_schema, with_ids)

    path = scratch_path(spark, "packed")
    base.mapInArrow(tidied(first), schema).write.partitionBy("rest").parquet(path)
    pieces = spark.read.schema(schema).parquet(path)
    full, rests = pieces.where("NOT rest").drop("rest"), pieces.where("rest").drop("rest")
    tasks = -(-rests.count() // REST_ROWS)
    if not tasks:
        return full
    dealt = rests.repartition(tasks, F.xxhash64("start", "ids_crc32", "doc_tokens")).sortWithinPartitions("start", "ids_crc32", "doc_tokens")
    return full.unionByName(dealt.mapInArrow(tidied(second), schema).drop("rest"))
