"""Whole columns of text as byte arrays: word bounds, 64-bit word hashes and n-grams in numpy.

A block is a run of rows of an Arrow column. Blocks are bounded in bytes, so that the working
arrays stay a few MB; a single longer text makes a block of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BLOCK_BYTES = 1 << 19


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection on 64 bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return splitmix((np.arange(1, n + 1, dtype=U) + U(seed) * U(1_000_003)) * U(0x9E3779B97F4A7C15)) | U(1)


_BYTE = constants(256, 1)
_POS = constants(1 << 12, 2)
_GRAM = constants(64, 3)

#: Words as maximal runs without white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words as letters, digits and underscore; bytes of non-ASCII characters count as letters.
WORDISH = np.zeros(256, bool)
WORDISH[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True


@dataclass
class Block:
    first: int  # row of the batch
    data: np.ndarray  # uint8
    off: np.ndarray  # int64, one more than rows

    @property
    def rows(self) -> int:
        return len(self.off) - 1


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # row in the block
    hash: np.ndarray

    def gram(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words within a row, and the index of each run's first word."""
        n = len(self.doc) - k + 1
        if n <= 0:
            return np.zeros(0, U), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        g = self.hash[at] * _GRAM[0]
        for j in range(1, k):
            g = g + self.hash[at + j] * _GRAM[j]
        return splitmix(g), at

    def counts(self, rows: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=rows)


def column_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A string column as its bytes and offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if lower:
        column = pc.utf8_lower(column)
    n, bufs = len(column), column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def blocks(column: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    data, off = column_bytes(column, lower)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield Block(a, data[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


def bounds(block: Block, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the words of a block by the table's byte class, none of them crossing a row's end."""
    m, n = table[block.data], len(block.data)
    if not n:
        return tuple(np.zeros((3, 0), np.int64))
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = m[:-1], m[1:]
    inner = block.off[1:-1]
    before[inner[inner < n]] = False
    after[inner[inner > 0] - 1] = False
    start, end = np.flatnonzero(m & ~before), np.flatnonzero(m & ~after) + 1
    return start, end, np.searchsorted(block.off, start, "right") - 1


def words(block: Block, table: np.ndarray) -> Words:
    """The words of bounds() with their hashes."""
    start, end, doc = bounds(block, table)
    return Words(start, end, doc, run_hash(block.data, start, end))


def run_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs, which may not be empty, overlap or go back."""
    if not len(start):
        return np.zeros(0, U)
    size = end - start
    first = np.cumsum(size) - size
    pos = np.arange(int(size.sum()), dtype=np.int64)
    at = pos - np.repeat(first, size)
    pos += np.repeat(start - first, size)
    longest = int(size.max())
    table = _POS if longest <= len(_POS) else constants(longest, 2)
    h = np.add.reduceat(_BYTE[data[pos]] * table[at], first)
    return splitmix(h + size.astype(U) * U(0x9E3779B97F4A7C15))


def per_row_sum(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of values between offsets, zero for empty rows."""
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[off[1:]] - c[off[:-1]]
