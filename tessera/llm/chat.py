"""Chat formatting at token level.

A turn becomes ``[start] role [sep] text [end]``. Role and text are encoded
separately as ordinary text and the three control tokens are spliced in by
their reserved ids, which lie above the vocabulary: no text can produce them.
The loss mask comes from the prefix sums of the segment lengths. Control
strings inside texts are escaped reversibly, so that the rendered string can
be parsed back as well.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, tidied
from tessera.llm.tokenizer import DEFAULT_PATH, encoder

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


@dataclass(frozen=True)
class ChatTemplate:
    """Control strings, each opening with ``<|``, and the roles that carry loss."""

    start: str = "<|im_start|>"
    sep: str = "<|im_sep|>"
    end: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)


def escape(text: str) -> str:
    """Every ``<`` + k backslashes + ``|`` gets one more backslash, so no control string is left."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def format_conversations(turns: DataFrame, template: ChatTemplate = ChatTemplate(),
                         tokenizer_path: str = DEFAULT_PATH) -> DataFrame:
    """``(conv_id, n_turns, ids, mask)``: one token sequence for each conversation.

    ``turns`` has ``conv_id, turn, role, text``; other columns are not read.
    Rows of a conversation are ordered by turn (null first), ties by role and
    text, so repeated rows appear as often as given. Null role or text reads as
    the empty text; a null ``conv_id`` is a conversation of its own; an empty
    table gives no rows. ``mask`` is 1 on the tokens of texts of the loss roles.

    Encoding runs where the rows lie. Rows then go to their conversation's
    partition and are sorted there on disk if need be; a task holds one
    conversation at a time, which is also the size of its output value.
    """
    prepare(turns.sparkSession)
    loss = frozenset(template.loss_roles)
    base = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def encode(batches):
        enc = encoder(tokenizer_path)
        for b in batches:
            role, text = b.column("role").to_pylist(), b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("turn"), b.column("role"), b.column("text"),
                 pa.array([enc.encode(escape(r)) for r in role], pa.list_(pa.int32())),
                 pa.array([enc.encode(escape(t)) for t in text], pa.list_(pa.int32()))],
                names=["conv_id", "turn", "role", "text", "role_ids", "text_ids"])

    def assemble(batches):
        vocab = encoder(tokenizer_path).vocab
        start, sep, end = ([vocab], [vocab + 1], [vocab + 2])
        key, segs, hot, n = None, [], [], 0

        def done():
            lens = np.array([len(s) for s in segs], dtype=np.int64)
            ends = np.cumsum(lens)
            ids = np.concatenate([np.asarray(s, dtype=np.int32) for s in segs])
            step = np.zeros(len(ids) + 1, dtype=np.int64)  # +1 where a loss segment begins, -1 where it ends
            on = np.array(hot, dtype=bool)
            np.add.at(step, ends[on] - lens[on], 1)
            np.add.at(step, ends[on], -1)
            mask = np.cumsum(step)[:-1].astype(np.int8)
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([n], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids)),
                 pa.ListArray.from_arrays(pa.array([0, len(mask)], pa.int32()), pa.array(mask))],
                names=["conv_id", "n_turns", "ids", "mask"])

        for b in batches:
            for conv, role, rid, tid in zip(b.column("conv_id").to_pylist(), b.column("role").to_pylist(),
                                            b.column("role_ids").to_pylist(), b.column("text_ids").to_pylist()):
                if n and conv != key:
                    yield done()
                    segs, hot, n = [], [], 0
                key, n = conv, n + 1
                segs += [start, rid, sep, tid, end]
                hot += [False, False, False, role in loss, False]
        if n:
            yield done()

    encoded = base.mapInArrow(tidied(encode), "conv_id long, turn long, role string, text string, "
                                      "role_ids array<int>, text_ids array<int>")
    ordered = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "role_ids", "text_ids").mapInArrow(
        tidied(assemble), "conv_id long, n_turns long, ids array<int>, mask array<byte>")


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate(),
              tokenizer_path: str = DEFAULT_PATH) -> DataFrame:
    """Turns and loss text recovered from the token sequences alone, as digests.

    ``turns_sha256`` hashes role, newline, text, newline of each turn;
    ``loss_sha256`` hashes the unescaped text under the mask; ``formatted_chars``
    is the length of the rendered string.
    """
    width = len(template.start) + len(template.sep) + len(template.end)

    def parse(batches):
        enc = encoder(tokenizer_path)
        start, sep, end = enc.vocab, enc.vocab + 1, enc.vocab + 2
        for b in batches:
            rows = []
            for conv, ids, mask in zip(b.column("conv_id").to_pylist(), b.column("ids"), b.column("mask")):
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy()
                opens, mids, ends = (np.flatnonzero(ids == x) for x in (start, sep, end))
                turns, loss = hashlib.sha256(), hashlib.sha256()
                chars = loss_chars = 0
                for i, j, k in zip(opens, mids, ends):
                    role, text = enc.decode(ids[i + 1:j]), enc.decode(ids[j + 1:k])
                    chars += width + len(role) + len(text)
                    plain = unescape(text)
                    turns.update(f"{unescape(role)}\n{plain}\n".encode())
                # the text under the mask, run by run, without looking at the roles
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
                for i, j in zip(edge[::2], edge[1::2]):
                    plain = unescape(enc.decode(ids[i:j]))
                    loss_chars += len(plain)
                    loss.update(plain.encode())
                rows.append((conv, len(opens), turns.hexdigest(), loss_chars, loss.hexdigest(), chars, len(ids)))
            cols = list(zip(*rows)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                                                       pa.int64(), pa.int64()])],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"])

    return formatted.mapInArrow(tidied(parse), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long, n_tokens long")
