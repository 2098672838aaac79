"""A public byte-level BPE vocabulary, loaded once per Python worker."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

#: place of the public vocabulary files; a parameter everywhere it is used
DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: the public split pattern this vocabulary was made with (fixed value)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: the same without look-ahead and possessive matching, which a plain automaton runs faster; it
#: splits alike where no two white-space characters are adjacent
PLAIN_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
_TWO_SPACES = re.compile(r"\s\s")
#: the same for Arrow, whose own ``\s`` is ASCII alone
_TWO_SPACES_ARROW = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
#: texts longer than this many characters are encoded in parts
LONG_TEXT = 1 << 18
_BORDER = re.compile(r"\S(?= \S)")


class Encoder:
    """``encode(text)`` to ids as the vocabulary gives them, special strings being ordinary text.

    A very long text is encoded in parts of about ``LONG_TEXT`` characters, cut
    where a space follows and precedes non-space characters: no token crosses
    such a border, so the ids are those of the whole text. Where a part has no
    such border it is cut at its end. Decoding the ids always gives the exact
    text back.
    """

    def __init__(self, path: str = DEFAULT_PATH):
        with open(path, "rb") as fh:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
        self._path, self._enc = path, None
        self.vocab = max(ranks.values()) + 1
        # never allowed, so ordinary text; without any special string the library searches for the empty one
        self._special = {"<|endoftext|>": self.vocab}
        self.plain = tiktoken.Encoding("public-plain", pat_str=PLAIN_PATTERN, mergeable_ranks=ranks, special_tokens=self._special)

    @property
    def enc(self) -> tiktoken.Encoding:
        """The encoding with the full pattern, made when the first text needs it."""
        if self._enc is None:
            with open(self._path, "rb") as fh:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
            self._enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self._special)
        return self._enc

    def _part(self, text: str) -> list[int]:
        return (self.enc if _TWO_SPACES.search(text) else self.plain).encode_ordinary(text)

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            end = at + LONG_TEXT
            if end < len(text):
                border = None
                for border in _BORDER.finditer(text, end - 4096, end):
                    pass
                end = border.end() if border else end
            yield text[at:end]
            at = end

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_TEXT:
            return self._part(text)
        return [i for part in self._parts(text) for i in self._part(part)]

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text as an array, without Python numbers; none of a null text."""
        none = np.empty(0, np.uint32)
        for text, two in zip(texts.to_pylist(), pc.match_substring_regex(texts, _TWO_SPACES_ARROW).to_pylist()):
            if not text:
                yield none
            elif len(text) <= LONG_TEXT:
                yield (self.enc if two else self.plain).encode_to_numpy(text, disallowed_special=())
            else:
                yield np.concatenate([(self.enc if _TWO_SPACES.search(part) else self.plain).encode_to_numpy(part, disallowed_special=())
                                      for part in self._parts(text)])

    def decode(self, ids) -> str:
        return self.plain.decode_bytes([int(i) for i in ids]).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def encoder(path: str = DEFAULT_PATH) -> Encoder:
    return Encoder(path)


def id_dtype(vocab: int) -> np.dtype:
    """Smallest little-endian unsigned type that holds every id."""
    return np.dtype("<u2") if vocab <= 1 << 16 else np.dtype("<u4")
