"""Words of whole texts as hash arrays, computed over Arrow buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (UTF-8 keeps those bytes for
themselves). Texts are handled in blocks of a few hundred kilobytes, a text never being cut, so
that memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)

            def run(base):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                return np.cumprod(step, dtype=np.uint64)

            self.up, self.down = run(self.base), run(_inverse(self.base))

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Polynomial hashes of values[start:end] for each span, equal for equal contents."""
        n = len(values)
        self.grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=total[1:])
        return mix((total[end] - total[start]) * self.down[start])


_BYTE_POWERS = Powers(0xD6E8FEB86659FD93)
WORD_POWERS = Powers(0xA0761D6478BD642F)
CHECK_POWERS = Powers(0xE7037ED1A0B428DB)
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans data[start:end], equal for equal bytes."""
    return _BYTE_POWERS.spans(_BYTE_VALUES[data], start, end)


@dataclass
class Block:
    """Some texts: their bytes, and the bounds and hashes of their words."""

    first: int  # position of the first text in the batch
    data: np.ndarray  # bytes
    text_at: np.ndarray  # bounds of the texts in the bytes, one more than texts
    start: np.ndarray  # bounds of the words in the bytes
    end: np.ndarray
    word_at: np.ndarray  # bounds of the texts in the words, one more than texts
    hash: np.ndarray  # of the words, unsigned 64-bit

    @property
    def texts(self) -> int:
        return len(self.text_at) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of k words inside a text, and the bounds of the texts in them."""
        counts = np.maximum(self.counts - (k - 1), 0)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        shift = self.word_at[:-1] - bounds[:-1]
        return np.arange(bounds[-1]) + np.repeat(shift, counts), bounds


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the bounds of its texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at.astype(np.int64)


def block(data: np.ndarray, text_at: np.ndarray, first: int = 0, lower: bool = False) -> Block:
    """Split the texts data[text_at[i]:text_at[i + 1]] into words."""
    data, text_at = data[text_at[0] : text_at[-1]], text_at - text_at[0]
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    border = np.zeros(n + 1, bool)
    border[text_at] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    word_at = np.searchsorted(start, text_at)
    return Block(first, data, text_at, start, end, word_at, byte_hashes(data, start, end))


def blocks(column: pa.Array, lower: bool = False, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks, in order."""
    data, at = _buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield block(data, at[first : last + 1], first, lower)
        first = last
