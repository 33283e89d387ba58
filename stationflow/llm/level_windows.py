"""Removal of repeated word windows, found level by level.

Level one looks at windows of `first` words, and of them only at anchors: each window of full length chooses one
of the short windows inside it by content alone, so equal windows choose equal anchors. Those that occur once are
done with. Windows around the others are extended to twice the length, and so on until the full length is reached
or none is left. The windows of full length that are left are compared as such, and all but the first
occurrence, by document and place, are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import CHUNK_BYTES, PAGE, Rows, answered, deal, paged, read_answers, write_pages
from .tokens import Words, anchors, cover, pieces, window_hashes


def _repeated(chunk: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a key occurs twice or more in all."""
    _, at = np.unique(keys, return_inverse=True)
    return np.bincount(at, weights=counts)[at] >= 2


def _first(chunk: np.ndarray, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether an entry has the first document of its key; of equal documents in two chunks the first chunk has it."""
    order = np.lexsort((chunk, docs, keys))
    key = keys[order]
    out = np.zeros(len(keys), dtype=bool)
    out[order[np.concatenate(([True], key[1:] != key[:-1]))]] = True
    return out


class _Piece:
    """Words of some rows of a chunk, and the windows still under suspicion."""

    def __init__(self, rows: pa.RecordBatch, words: Words, length: int, first: int):
        self.base = rows.column("row")[0].as_py() if rows.num_rows else 0
        self.words, self.length = words, length
        hashes = window_hashes(words.hash, first)
        self.chosen, self.low, self.high = anchors(hashes, words.row, length - first + 1, length)
        self.gram, self.keys = first, hashes[self.chosen]

    def keep(self, which: np.ndarray) -> None:
        self.chosen, self.low, self.high, self.keys = self.chosen[which], self.low[which], self.high[which], self.keys[which]

    def double(self) -> None:
        """Extend each anchor to twice its length: to the right for windows that hold that, to the left for the others."""
        long = 2 * self.gram
        hashes = window_hashes(self.words.hash, long)
        split = self.chosen + long - self.length
        right, left = self.high >= split, self.low < split
        chosen = np.concatenate((self.chosen[right], self.chosen[left] - self.gram))
        low = np.concatenate((np.maximum(self.low, split)[right], self.low[left]))
        high = np.concatenate((self.high[right], np.minimum(self.high, split - 1)[left]))
        self.chosen, self.low, self.high, self.gram, self.keys = chosen, low, high, long, hashes[chosen]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window left, in order."""
        count = self.high - self.low + 1
        at = np.repeat(self.low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(int(count.sum())) if len(count) else count
        at = np.sort(at)
        return at, window_hashes(self.words.hash, self.length)[at] if len(at) else np.zeros(0, dtype=np.uint64)


def _pieces(rows: Rows, length: int, first: int) -> Iterator[_Piece]:
    for batch, texts in pieces(rows.batches()):
        yield _Piece(batch, Words(texts), length, first)


def _survivors(rows: Rows, answers: pa.Table | None, levels: list[int], length: int, n: int, upto: int) -> tuple[list[_Piece], np.ndarray, np.ndarray]:
    """Pieces after `upto` levels have been answered, with the keys they hold in page order and how often each occurs (2 at most)."""
    parts = list(_pieces(rows, length, levels[0]))
    for i in range(upto):
        keys, _ = _keys(parts, n)
        left = np.sort(keys[read_answers(answers, i).astype(bool)])
        for part in parts:
            part.keep(np.isin(part.keys, left, kind="sort"))
            if i + 1 < len(levels):
                part.double()
    return parts, *_keys(parts, n)


def _keys(parts: list[_Piece], n: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p.keys for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
    keys, counts = np.unique(keys, return_counts=True)
    order = paged(keys, n)
    return keys[order], np.minimum(counts[order], 2).astype(np.uint8)


def _full(rows: Rows, parts: list[_Piece], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows left in the chunk: where each stands among the distinct keys, whether it is the chunk's first of
    its key; the distinct keys in page order, and the document of the first of each."""
    hashes, docs = [], []
    for part in parts:
        at, h = part.windows()
        hashes.append(h)
        docs.append(rows.keys[part.base + part.words.row[at]])
    every = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    doc = np.concatenate(docs) if docs else np.zeros(0, dtype=np.int64)
    keys, begin, at = np.unique(every, return_index=True, return_inverse=True)
    leads = np.zeros(len(every), dtype=bool)
    leads[begin] = True
    order = paged(keys, n)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.arange(len(keys))
    return place[at], leads, keys[order], doc[begin][order]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 20, first: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_words, n_removed, kept) of every row: `kept` is the words left, joined by one space.

    A word goes if a window of `length` words over it also starts earlier: in a document of a smaller key, or further
    ahead in the same. Keys are integers; a null key comes first. Rows equal in key and text are one document and
    get the same result; of rows with a key in common and other texts, the one in the lower chunk or else with the
    smaller text comes first. A null text is empty; texts of fewer than `length` words keep all of them.
    length is first times a power of two. Windows are compared by 64-bit hashes.
    """
    levels = []
    while not levels or levels[-1] < length:
        levels.append(2 * levels[-1] if levels else first)
    if levels[-1] != length or length < 2 * first:
        raise ValueError("length is first times a power of two")
    levels = levels[:-1]
    dealt, n = deal(docs, key, text, chunk_bytes)
    by_chunk = dealt.groupBy("chunk")

    def chunk_of(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def ask_first(table: pa.Table) -> pa.Table:
        _, keys, counts = _survivors(Rows(table), None, levels, length, n, 0)
        return write_pages(chunk_of(table), keys, counts, n)

    def ask_next(level: int):
        def ask(table: pa.Table, answers: pa.Table) -> pa.Table:
            _, keys, counts = _survivors(Rows(table), answers, levels, length, n, level)
            return write_pages(chunk_of(table), keys, counts, n)

        return ask

    def ask_full(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = Rows(table)
        parts, _, _ = _survivors(rows, answers, levels, length, n, len(levels))
        _, _, keys, docs_of = _full(rows, parts, n)
        return write_pages(chunk_of(table), keys, docs_of, n)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = Rows(table)
        parts, _, _ = _survivors(rows, answers, levels, length, n, len(levels))
        place, leads, _, _ = _full(rows, parts, n)
        first_of_all = read_answers(answers, len(levels)).astype(bool)
        gone = ~(leads & first_of_all[place]) if len(place) else np.zeros(0, dtype=bool)
        n_words, n_removed, kept, used = [], [], [], 0
        for part in parts:
            at, _ = part.windows()
            mine, used = gone[used : used + len(at)], used + len(at)
            words = part.words
            covered = cover(len(words.start), at[mine], at[mine] + length)
            for row in range(len(words.count)):
                a, b = int(words.first[row]), int(words.first[row + 1])
                here = np.flatnonzero(~covered[a:b]) + a
                n_words.append(b - a)
                n_removed.append(b - a - len(here))
                kept.append(_joined(words, here))
        return rows.out(n_words=n_words, n_removed=n_removed, kept=kept).rename_columns([key, "n_words", "n_removed", "kept"])

    answers = answered(by_chunk.applyInArrow(ask_first, PAGE), 0, np.uint8, _repeated)
    for level in range(1, len(levels)):
        pages = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(ask_next(level), PAGE)
        answers = answers.unionByName(answered(pages, level, np.uint8, _repeated))
    pages = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(ask_full, PAGE)
    answers = answers.unionByName(answered(pages, len(levels), np.int64, _first))
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_words long, n_removed long, kept string"
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(remove, schema)


def _joined(words: Words, which: np.ndarray) -> str:
    raw = words.raw
    return b" ".join([raw[a:b] for a, b in zip(words.start[which].tolist(), words.end[which].tolist())]).decode("utf-8", "surrogateescape")
