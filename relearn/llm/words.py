"""Words of Arrow string columns as NumPy arrays of hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D.  In UTF-8 these separators never occur inside
another character, so scanning bytes finds the same words as the pattern ``[^\\x20\\x09-\\x0D]+`` on the text.
A word's hash is a polynomial over a random 64-bit value per byte, read from prefix sums (modulo 2^64), then mixed:
one vectorised pass for a whole slice of documents.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time (a longer document is a slice of its own); bounds a worker's memory.
SLICE_BYTES = 1 << 20
#: Bytes hashed at a time, in place: what that takes stays in the processor's cache.
_PIECE = 1 << 15

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE_BYTE, _BASE_WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (a bijection): spreads every input bit over the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE_BYTE))
_LOWER_VALUES = _BYTE_VALUES.copy()
_LOWER_VALUES[65:91] = _BYTE_VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Other separators: every ASCII byte but letters and digits.
NOT_ALPHANUMERIC = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, extended when a longer slice needs them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def __getstate__(self) -> dict:
        """Without the tables: what is sent to tasks stays small, they make their own."""
        return {"base": self.base, "inverse": self.inverse, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_byte_powers, _word_powers = _Powers(_BASE_BYTE), _Powers(_BASE_WORD)


@dataclass
class Words:
    """Words of a slice of documents, in order."""
    data: np.ndarray      # the slice's bytes
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # byte after each word
    hash: np.ndarray      # uint64
    first: np.ndarray     # per document: index of its first word; one more entry closes the last
    first_doc: int        # row number of the slice's first document in the batch

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1

    def doc(self) -> np.ndarray:
        """The slice's document number of every word."""
        return np.repeat(np.arange(self.n_docs), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of ``n`` consecutive words within one document."""
        total = len(self.hash)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, down = _word_powers(total)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(self.hash * up, out=sums[1:])
        at = np.flatnonzero(np.repeat(self.first[1:], np.diff(self.first)) - np.arange(total) >= n)
        return at, mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64) and bytes of a string column; null as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data or b"", np.uint8)


def slices(column: pa.Array, lower: bool = False, most: int = SLICE_BYTES, space: np.ndarray = _SPACE) -> Iterator[Words]:
    """The words of a batch's texts, some documents at a time; ``lower`` folds A-Z to a-z in the hashes.

    ``space`` marks the bytes that separate words."""
    offsets, data = text_bytes(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield scan(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lower, a, space)
        a = b


def scan(data: np.ndarray, offsets: np.ndarray, lower: bool = False, first_doc: int = 0, space: np.ndarray = _SPACE) -> Words:
    """Words of the documents at ``offsets`` of ``data``."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = np.frombuffer(data.tobytes().translate((~space).tobytes()), bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    cut = np.unique(offsets[1:-1])
    cut = cut[inside[cut] & inside[cut + 1]]          # a document's end also ends a word
    start, end = (np.insert(x, np.searchsorted(x, cut), cut) for x in (edges[::2], edges[1::2]))
    up, down = _byte_powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    values = _LOWER_VALUES if lower else _BYTE_VALUES
    for a in range(0, n, _PIECE):
        part = sums[a + 1:a + 1 + _PIECE]
        np.take(values, data[a:a + _PIECE], out=part, mode="clip")
        part *= up[a:a + len(part)]
        part[:1] += sums[a:a + 1]
        np.cumsum(part, out=part)
    return Words(data, start, end, mix((sums[end] - sums[start]) * down[start]), np.searchsorted(start, offsets), first_doc)
