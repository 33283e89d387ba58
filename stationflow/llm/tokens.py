"""Words, word windows and content-chosen anchors of whole Arrow text columns, as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09 to 0x0D. These bytes never occur inside
a multi-byte UTF-8 character, so bytes may be cut where characters may. Hashes are 64-bit
polynomials, taken with wrap-around and mixed at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

PIECE_BYTES = 1 << 20

_BYTE_VALUES = np.random.default_rng(20240601).integers(1, 2**63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(size, x, dtype=np.uint64) for x in (_BASE, _INVERSE))
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(20, int(size - 1).bit_length()))
    return up[:size], down[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over the whole 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values weighted by powers, one longer than values."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(max(len(values), 1))[0][: len(values)], out=out[1:])
    return out


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of each `length` consecutive values; empty if there are fewer."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    sums = _sums(values)
    return mixed((sums[length:] - sums[:n]) * powers(len(values) + 1)[1][:n])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def byte_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hash of the bytes between offsets."""
    sums = _sums(_BYTE_VALUES[data])
    return mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * powers(len(data) + 1)[1][offsets[:-1]])


class Texts:
    """A run of rows of a text column: their bytes, put one after the other."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        self.offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        start, end = int(self.offsets[0]), int(self.offsets[-1])
        body = column.buffers()[2]
        self.data = np.frombuffer(body, dtype=np.uint8)[start:end] if body is not None else np.zeros(0, np.uint8)
        self.offsets = self.offsets - start
        self.rows = len(column)

    def row_of_byte(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows, dtype=np.int32), np.diff(self.offsets))


class Words:
    """Words of a run of texts: first byte, end byte, row and hash of each. outside: the bytes between words."""

    def __init__(self, texts: Texts, lower: bool = False, outside: np.ndarray = SPACE):
        data = texts.data
        self.raw = texts.data.tobytes()
        inside = ~outside[data]
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        begins = texts.offsets[:-1][texts.offsets[:-1] < len(data)]
        edge[begins] = inside[begins]
        self.start = np.flatnonzero(edge)
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        ends = texts.offsets[1:][texts.offsets[1:] > 0] - 1
        stop[ends] = inside[ends]
        self.end = np.flatnonzero(stop) + 1
        #: Of the words: row r has those from first[r] up to first[r + 1].
        self.first = np.searchsorted(self.start, texts.offsets)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(texts.rows, dtype=np.int64), self.count)
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        sums = _sums(_BYTE_VALUES[data])
        self._sums = sums
        self.hash = mixed((sums[self.end] - sums[self.start]) * powers(len(data) + 1)[1][self.start])

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Row, and hash of the first `size` bytes, of the words longer than that."""
        start = self.start[self.end - self.start > size]
        hashes = (self._sums[start + size] - self._sums[start]) * powers(len(self._sums))[1][start]
        return self.row[self.end - self.start > size], mixed(hashes)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of `length` words inside one row."""
        hashes = window_hashes(self.hash, length)
        at = np.flatnonzero(self.row[: len(hashes)] == self.row[length - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        return at, hashes[at]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches into runs of rows of about `most` bytes of text (a longer text alone); a null text is empty."""
    for batch in batches:
        text = batch.column(column).cast(pa.large_binary())
        text = text.fill_null(b"") if text.null_count else text
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        begin = 0
        while begin < len(text):
            end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), len(text))
            yield batch.slice(begin, end - begin), Texts(text.slice(begin, end - begin))
            begin = end


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    have, low = 1, values
    while 2 * have <= width:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def anchors(hashes: np.ndarray, row: np.ndarray, width: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Choose one gram of each window by the window's content alone: that of the least hash, of equals the last.

    hashes: of the grams at each place, as window_hashes gives them. row: of each unit. A window has `width`
    grams and `length` units. Returns the chosen grams in ascending order and, for each, the first and the last
    of the windows that chose it. Equal windows choose grams at the same place inside them.
    """
    n = len(row) - length + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none, none, none
    rank = (hashes & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(hashes), dtype=np.uint64))
    low = least(rank, width)[:n]
    at = np.flatnonzero(row[:n] == row[length - 1 :])
    if not len(at):
        return none, none, none
    chosen = (np.uint64(0xFFFFFFFF) - (low[at] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
    return chosen[new], at[new], at[np.concatenate((new[1:] - 1, [len(at) - 1]))]


def runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each run of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def cover(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True at each place of [start, end) of any pair."""
    delta = np.zeros(size + 1, dtype=np.int64)
    np.add.at(delta, start, 1)
    np.add.at(delta, end, -1)
    return np.cumsum(delta[:-1]) > 0
