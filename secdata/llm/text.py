"""Arrow text columns as flat byte arrays, and word hashes over them.

The operators of this subpackage read whole texts. Their Python tasks take Arrow batches, cut them into pieces of bounded
size (``pieces``), and work on one flat byte array per piece, so that no step runs per word or per character in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in ``column`` each; a longer value makes a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 1)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def flat(column: pa.Array, end: str = " ") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, each followed by ``end``, and the n + 1 offsets of the values. Null counts as empty."""
    kind = pa.large_string()
    joined = pc.binary_join_element_wise(pc.fill_null(column.cast(kind), ""), pa.scalar("", kind), pa.scalar(end, kind))
    _, offsets, data = joined.buffers()
    starts = np.frombuffer(offsets, np.int64)[: len(joined) + 1]
    return np.frombuffer(data, np.uint8)[: starts[-1]], starts


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a binary column without nulls, and the n + 1 offsets of the values."""
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), starts


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _series(name: str, base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[name] = np.multiply.accumulate(have)
    return have[:n]


class Words:
    """The words of all values of a piece: maximal runs of bytes that ``table`` maps to a value other than 0.

    data: the bytes after the mapping; begin, end: each word's byte range; first: the n + 1 word offsets of the values;
    hashes: one 64-bit hash per word, the same for the same bytes anywhere.
    """

    def __init__(self, column: pa.Array, table: np.ndarray):
        raw, self.starts = flat(column)
        self.data = table[raw]
        inside = self.data != 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.begin, self.end = edge[0::2], edge[1::2]
        self.inside = inside
        self.first = np.searchsorted(self.begin, self.starts)
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.begin)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """For each word, the index of its value."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = self._made()
        return self._hashes

    def _made(self) -> np.ndarray:
        n = len(self.data)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum(self.data * _series("up", _BASE, n), out=total[1:])
        inverse = pow(_BASE, -1, 1 << 64)
        return mix((total[self.end] - total[self.begin]) * _series("down", inverse, n + 1)[self.begin] + (self.end - self.begin).astype(np.uint64))


def byte_table(keep, lower: bool = True) -> np.ndarray:
    """A 256-entry mapping for Words: bytes for which ``keep`` holds stay (A-Z as a-z if ``lower``), others become 0."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        table[b] = c if keep(c) else 0
    return table


#: Words of letters, digits and everything outside ASCII.
WORD_BYTES = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Words between ASCII white space. NUL is a word byte here, so it is moved to a byte that UTF-8 never uses.
SPACED_BYTES = byte_table(lambda b: b != 32 and not 9 <= b <= 13)
SPACED_BYTES[0] = 255


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1 .. (count[0] of them), then the same for begin[1], and so on."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    jump = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return jump + np.arange(total)
