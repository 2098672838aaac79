"""Training-order materialisation: token ids in fixed-stride binary shards.

Every sequence gets a number (its partition's offset plus its place there) and
a keyed Feistel permutation with cycle-walking turns the number into a global
slot: a shuffle of all sequences that needs no sort by random keys, no state
and no list of slots. Rows go to the task of their slot range and each task
writes one shard of equal records, so a reader finds slot ``s`` by arithmetic
and resumes anywhere.

Record layout, little-endian: ``doc_id`` int64, ``seq_no`` uint32, ``n_tokens``
uint16, ``flags`` uint16 (1: the doc_id is null), then ``seq_len`` ids padded
with ``pad_id``.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import prepare, scratch_path, stored, tidied
from tessera.llm.tokenizer import DEFAULT_PATH, encoder, id_dtype

#: doc_id, seq_no, n_tokens, flags
_HEAD = "<qIHH"
_HEAD_SIZE = struct.calcsize(_HEAD)


def _record_type(seq_len: int, ids: np.dtype) -> np.dtype:
    """A shard as an array of records."""
    return np.dtype([("doc", "<i8"), ("seq", "<u4"), ("n", "<u2"), ("flags", "<u2"), ("ids", ids, (seq_len,))])


def _round_keys(key: str, rounds: int = 6) -> list[int]:
    return [int.from_bytes(hashlib.blake2b(f"{key}/{i}".encode(), digest_size=8).digest(), "little") for i in range(rounds)]


def permute(index: np.ndarray, n: int, key: str) -> np.ndarray:
    """Slots of ``index`` under the keyed permutation of ``range(n)``.

    A balanced Feistel network permutes the smallest even-bit domain holding
    ``n`` (less than ``4 n``); values outside ``range(n)`` are sent through again
    until they fall inside, which keeps the map one to one.
    """
    if n <= 1:
        return np.zeros(len(index), dtype=np.int64)
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), [np.uint64(k) for k in _round_keys(key)]
    shift = np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            h = right + k
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((h ^ (h >> np.uint64(31))) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(index.astype(np.uint64))
        while True:
            outside = out >= n
            if not outside.any():
                return out.astype(np.int64)
            out[outside] = once(out[outside])


def materialise(docs: DataFrame, out_path: str, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 256,
                slots_per_shard: int = 65_536, key: str = "epoch-0", pad_id: int = 0, tokenizer_path: str = DEFAULT_PATH,
                stable: bool = False) -> DataFrame:
    """Write all documents' token ids to ``out_path`` and return the shards' manifest.

    ``(shard, path, first_slot, n_slots, n_tokens, bytes, sha256)``, one row a
    shard. A document is cut into sequences of ``seq_len`` ids, the last one
    padded; texts that are null or empty have no sequence, and an empty table
    writes no shard. Repeated rows are written as often as they occur. Only the
    two named columns are read.

    The ids are made in two passes, counting and writing, because storing them
    between the two would double the space on disk. Both must see the same rows
    in the same partitions: true of Parquet scans; other frames (``stable=False``)
    are first written to the shared folder. The second pass fails if a partition's
    count differs. The driver holds one count for each partition. Shards are
    written under a temporary name and renamed, so a task that is run again
    replaces its shard by an equal one.
    """
    if not 1 <= seq_len < 1 << 16:
        raise ValueError("seq_len must be between 1 and 65535")
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if not stable:
        base, _ = stored(base, "sequences-in")

    def count(batches):
        enc, n = encoder(tokenizer_path), 0
        for b in batches:
            for ids in enc.encode_column(b.column("text")):
                n += -(-len(ids) // seq_len)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([n], pa.int64())],
                                         names=["part", "n"])

    counts = {r["part"]: r["n"] for r in base.mapInArrow(tidied(count), "part int, n long").collect()}
    total, offsets = 0, {}
    for part in sorted(counts):
        offsets[part] = total
        total += counts[part]
    n_shards = -(-total // slots_per_shard)
    vocab = encoder(tokenizer_path).vocab
    if not 0 <= pad_id < 1 << 16:
        raise ValueError("pad_id must fit the id type")
    dtype = id_dtype(vocab)
    stride = _HEAD_SIZE + seq_len * dtype.itemsize

    def cut(batches):
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        at, expected = offsets.get(part, 0), counts.get(part, 0)
        done, kind = 0, _record_type(seq_len, dtype)
        for b in batches:
            held = list(enc.encode_column(b.column("text")))
            size = np.array([len(ids) for ids in held], np.int64)
            pieces = -(-size // seq_len)
            first = np.cumsum(pieces) - pieces  # record at which a document begins
            seq = np.arange(pieces.sum()) - np.repeat(first, pieces)
            flat = np.full(len(seq) * seq_len, pad_id, dtype)
            for lo, ids in zip((first * seq_len).tolist(), held):
                flat[lo:lo + len(ids)] = ids
            del held
            records = np.empty(len(seq), kind)
            doc = b.column("doc_id")
            records["doc"] = np.repeat(doc.fill_null(0).to_numpy(), pieces)
            records["seq"] = seq
            records["n"] = np.minimum(np.repeat(size, pieces) - seq * seq_len, seq_len)
            records["flags"] = np.repeat(doc.is_null().to_numpy(zero_copy_only=False), pieces)
            records["ids"] = flat.reshape(-1, seq_len)
            slots = permute(np.arange(at + done, at + done + len(records)), total, key)
            done += len(records)
            rows = min(8192, (1 << 30) // stride)
            for i in range(0, len(records), rows):
                some = records[i:i + rows]
                ends = np.arange(len(some) + 1, dtype=np.int32) * stride
                yield pa.RecordBatch.from_arrays(
                    [pa.array((slots[i:i + rows] // slots_per_shard).astype(np.int32)), pa.array(slots[i:i + rows]),
                     pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(some)])],
                    names=["shard", "slot", "record"])
        if done != expected:
            raise RuntimeError(f"partition {part} gave {done} sequences after {expected}: the input is not stable")

    def write(batches):
        from pyarrow import fs

        store = base_dir = out = None
        shard = first = None
        n = tokens = 0
        digest = None

        def close():
            out.close()
            store.move(f"{base_dir}/{tmp}", f"{base_dir}/{name}")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([f"{out_path}/{name}"]), pa.array([first], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([tokens], pa.int64()), pa.array([n * stride], pa.int64()), pa.array([digest.hexdigest()])],
                names=["shard", "path", "first_slot", "n_slots", "n_tokens", "bytes", "sha256"])

        for b in batches:
            shards, slots = b.column("shard").to_numpy(), b.column("slot").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if shards[lo] != shard:
                    if out is not None:
                        yield close()
                    if store is None:
                        store, base_dir = fs.FileSystem.from_uri(out_path)
                        store.create_dir(base_dir, recursive=True)
                    shard, first, n, tokens, digest = int(shards[lo]), int(slots[lo]), 0, 0, hashlib.sha256()
                    name = f"shard-{shard:08d}.bin"
                    tmp = f".{name}.{uuid.uuid4().hex}"
                    out = store.open_output_stream(f"{base_dir}/{tmp}")
                if (slots[lo:hi] != np.arange(first + n, first + n + hi - lo)).any():
                    raise RuntimeError(f"the slots from {first + n} on are not all there")
                blob = b"".join(b.column("record").slice(lo, hi - lo).to_pylist())
                out.write(blob)
                digest.update(blob)
                n += hi - lo
                tokens += int(np.frombuffer(blob, _record_type(seq_len, dtype))["n"].sum())
        if out is not None:
            yield close()

    records = base.mapInArrow(tidied(cut), "shard int, slot long, record binary")
    ranged = records.repartitionById(max(1, n_shards), F.col("shard")).sortWithinPartitions("slot")
    manifest = ranged.mapInArrow(tidied(write), "shard int, path string, first_slot long, n_slots long, n_tokens long, bytes long, sha256 string")
    return stored(manifest, "sequences-manifest")[0]


def read_shards(spark: SparkSession, out_path: str, seq_len: int = 256, slots_per_shard: int = 65_536,
                tokenizer_path: str = DEFAULT_PATH, first_slot: int = 0) -> DataFrame:
    """``(slot, shard, doc_id, seq_no, n_tokens, ids_crc32)`` read from the shards, from ``first_slot`` on."""
    dtype = id_dtype(encoder(tokenizer_path).vocab)
    stride = _HEAD_SIZE + seq_len * dtype.itemsize

    def parse(batches):
        for b in batches:
            for path, blob in zip(b.column("path").to_pylist(), b.column("content")):
                shard = int(path.rsplit("shard-", 1)[1].split(".")[0])
                view = memoryview(blob.as_buffer())
                rec = np.frombuffer(view, _record_type(seq_len, dtype))
                first, n = shard * slots_per_shard, rec["n"].astype(np.int64)
                at = np.arange(len(rec)) * stride + _HEAD_SIZE
                crc = [zlib.crc32(view[i:j]) for i, j in zip(at.tolist(), (at + n * dtype.itemsize).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(first, first + len(rec))), pa.array(np.full(len(rec), shard, np.int32)),
                     pa.array(rec["doc"].copy(), pa.int64(), mask=(rec["flags"] & 1).astype(bool)), pa.array(rec["seq"].astype(np.int64)),
                     pa.array(n), pa.array(crc, pa.int64())], names=["slot", "shard", "doc_id", "seq_no", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(out_path).select("path", "content")
    return files.mapInArrow(tidied(parse), "slot long, shard int, doc_id long, seq_no long, n_tokens long, ids_crc32 long").where(
        F.col("slot") >= first_slot)


def read_sequence(out_path: str, slot: int, seq_len: int = 256, slots_per_shard: int = 65_536,
                  tokenizer_path: str = DEFAULT_PATH) -> tuple[int | None, int, np.ndarray]:
    """One slot's ``(doc_id, seq_no, ids)`` by a single ranged read."""
    from pyarrow import fs

    dtype = id_dtype(encoder(tokenizer_path).vocab)
    stride = _HEAD_SIZE + seq_len * dtype.itemsize
    store, base_dir = fs.FileSystem.from_uri(out_path)
    with store.open_input_file(f"{base_dir}/shard-{slot // slots_per_shard:08d}.bin") as fh:
        blob = fh.read_at(stride, slot % slots_per_shard * stride)
    d, seq, n, flags = struct.unpack_from(_HEAD, blob)
    return None if flags & 1 else d, seq, np.frombuffer(blob, dtype=dtype, count=n, offset=_HEAD_SIZE)


def fresh_output(spark: SparkSession) -> str:
    """A new folder for shards inside the shared checkpoint folder, as a URI."""
    path = scratch_path(spark, "shards")
    return path if "://" in path else "file://" + path.removeprefix("file:")


__all__ = ["materialise", "permute", "read_sequence", "read_shards", "fresh_output"]
