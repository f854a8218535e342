"""Words of many texts at once: Arrow string columns to numpy arrays.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D. Word and window
hashes are 64-bit polynomials modulo 2**64 with a final mix, taken for a whole
block of texts by prefix sums, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# texts are worked on in blocks of about so many bytes; a longer text is a block of its own
BLOCK_BYTES = 1 << 20

BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, b, dtype=np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block(NamedTuple):
    first: int  # row of its first text in the column
    data: np.ndarray  # bytes of the texts, one after the other
    offsets: np.ndarray  # where each text starts, and the end
    starts: np.ndarray  # where each word starts
    ends: np.ndarray
    word_from: np.ndarray  # index of each text's first word, and the number of words

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        up, down = _byte_powers.upto(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        h = (total[self.ends] - total[self.starts]) * down[self.starts]
        return mix64(h ^ ((self.ends - self.starts).astype(np.uint64) << np.uint64(48)))

    def counts(self) -> np.ndarray:
        """Words per text."""
        return np.diff(self.word_from)


def block_of(first: int, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> Block:
    """The block of texts that lie in `data` one after the other; words end at the bytes
    that `between` marks."""
    word = ~between[data]
    head, tail = word.copy(), word.copy()
    head[1:] &= ~word[:-1]
    tail[:-1] &= ~word[1:]
    full = offsets[:-1] < offsets[1:]
    a, b = offsets[:-1][full], offsets[1:][full] - 1
    head[a], tail[b] = word[a], word[b]
    starts = np.flatnonzero(head)
    return Block(first, data, offsets, starts, np.flatnonzero(tail) + 1, np.searchsorted(starts, offsets))


def blocks(texts: pa.Array, between: np.ndarray = SPACE) -> Iterator[Block]:
    """Blocks of a string column in order; a null text has no words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, where, body = texts.buffers()
    off = np.frombuffer(where, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + BLOCK_BYTES, "right")) - 1))
        part, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        yield block_of(i, part, o, between)
        i = j


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive word hashes (index = first word)."""
    n = len(h)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = _word_powers.upto(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * up[:-1], out=total[1:])
    return mix64((total[width:] - total[:-width]) * down[:n - width + 1])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
