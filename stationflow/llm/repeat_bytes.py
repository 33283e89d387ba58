"""Removal of bytes in repeated strings, found by a suffix array and its tree of common-prefix intervals.

Every window of `length` bytes chooses one place in it, its anchor, by content alone: equal windows have
equal anchors. Anchors whose gram occurs once are done with. Around each other anchor a chunk sends its
context, all the windows that chose it; contexts that are equal throughout are sent once. All contexts of a
gram meet in one task. There the suffixes that start at anchors are sorted, their common prefixes taken, and a
stack scan lists the intervals: sets of suffixes that share more than those around them. An interval is a
maximal repeat to the right; inside it the bytes to the left are compared, and sets that share enough on both
sides are repeats, with all their occurrences. What is covered goes back to the chunk by position.

A gram with very many occurrences would gather too many contexts. Above `most` its windows are compared
by hash instead, which spreads them over all tasks: exact as well, only without the intervals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunks import ANSWER, CHUNK_BYTES, PAGE, Rows, answered, deal, paged, read_answers, write_pages
from .tokens import Texts, anchors, byte_values, cover, mixed, pieces, runs, window_hashes

GRAM = 64
#: Occurrences of a gram, over all chunks, from which on its windows are compared by hash.
MOST = 4096
_ONCE, _SOME, _MANY = 0, 1, 2

CONTEXTS = "chunk long, page long, keys binary, lefts binary, sizes binary, counts binary, body binary"


# --- The suffix array of a set of contexts ---------------------------------------------------------------


def common_prefixes(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two rows of bytes, of which the first a_size and b_size count."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, np.minimum(a_size, b_size))


def intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(shared, first, last) of all common-prefix intervals that share `least` or more.

    lcp[i] is what suffix i shares with suffix i - 1; lcp[0] is 0. One scan with a stack: an
    interval is opened where the shared length grows and closed where it falls below.
    """
    out, stack = [], [(0, 0)]
    for i, shared in enumerate([*lcp[1:], 0], 1):
        start = i - 1
        while stack[-1][0] > shared:
            high, start = stack.pop()
            if high >= least:
                out.append((high, start, i - 1))
        if stack[-1][0] < shared:
            stack.append((shared, start))
    return out


@dataclass
class Found:
    """A set of occurrences that share `right` bytes from the anchor on: which contexts, and how far each one's best
    partner in the set agrees with it to the left."""

    right: np.ndarray
    context: np.ndarray
    left: np.ndarray


def find(keys: np.ndarray, contexts: list[bytes], lefts: np.ndarray, counts: np.ndarray, length: int, gram: int) -> Iterator[Found]:
    """Repeats among contexts with the same key that are `length` bytes or longer.

    A context has lefts[i] bytes ahead of its anchor. counts: how often it occurs; one that occurs twice
    repeats itself in full.
    """
    n = len(contexts)
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    rights = sizes - lefts
    twice = np.flatnonzero(counts >= 2)
    yield Found(rights[twice], twice, lefts[twice])
    after = [c[a:] for c, a in zip(contexts, lefts.tolist())]
    before = [c[:a][::-1] for c, a in zip(contexts, lefts.tolist())]
    prefix = keys.astype(">u8").tobytes()
    named = [prefix[8 * i : 8 * i + 8] + after[i] for i in range(n)]
    order = np.array(sorted(range(n), key=named.__getitem__), dtype=np.int64)
    rank = np.empty(n, dtype=np.int64)
    rank[sorted(range(n), key=before.__getitem__)] = np.arange(n)
    right_bytes, left_bytes = _matrix(after, rights), _matrix(before, lefts)
    lcp = np.zeros(n, dtype=np.int64)
    one, two = order[:-1], order[1:]
    for k in range(0, n - 1, 1 << 15):
        s = slice(k, k + (1 << 15))
        lcp[1:][s] = np.where(keys[one[s]] == keys[two[s]], common_prefixes(right_bytes[one[s]], right_bytes[two[s]], rights[one[s]], rights[two[s]]), 0)
    tree = np.array(intervals(lcp.tolist(), gram), dtype=np.int64).reshape(-1, 3)
    width = tree[:, 2] - tree[:, 1] + 1
    # Intervals in blocks of bounded size; one alone may be larger, up to the contexts of a gram.
    block = np.cumsum(width) >> 15
    for b in np.split(np.arange(len(tree)), np.flatnonzero(np.diff(block)) + 1):
        if len(b):
            yield _extend_left(tree[b], width[b], order, rank, left_bytes, lefts)


def _extend_left(tree: np.ndarray, width: np.ndarray, order: np.ndarray, rank: np.ndarray, left_bytes: np.ndarray, lefts: np.ndarray) -> Found:
    """Of each member of each interval, the most bytes to the left that another member shares."""
    total = int(width.sum())
    node = np.repeat(np.arange(len(tree)), width)
    at = np.repeat(tree[:, 1] - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(total)
    member = order[at]
    # With the members in the order of what stands to their left, the best partner is a neighbour.
    sorting = np.lexsort((rank[member], node))
    node, member = node[sorting], member[sorting]
    shared = common_prefixes(left_bytes[member[:-1]], left_bytes[member[1:]], lefts[member[:-1]], lefts[member[1:]])
    shared = np.where(node[:-1] == node[1:], shared, -1)
    left = np.maximum(np.concatenate(([-1], shared)), np.concatenate((shared, [-1])))
    return Found(tree[node, 0], member, left)


def _matrix(rows: list[bytes], sizes: np.ndarray) -> np.ndarray:
    width = int(sizes.max(initial=0))
    out = np.zeros((len(rows), max(width, 1)), dtype=np.uint8)
    body = np.frombuffer(b"".join(rows), dtype=np.uint8)
    row = np.repeat(np.arange(len(rows)), sizes)
    out[row, np.arange(len(body)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = body
    return out


def repeated_windows(keys: np.ndarray, contexts: list[bytes], lefts: np.ndarray, counts: np.ndarray, length: int, gram: int) -> list[list[tuple[int, int]]]:
    """Of each context, the windows that occur elsewhere: runs (first, last), counted from the context's start."""
    which, begin, end = [], [], []
    for found in find(keys, contexts, lefts, counts, length, gram):
        enough = found.left + found.right >= length
        member = found.context[enough]
        which.append(member)
        begin.append(lefts[member] - found.left[enough])
        end.append(lefts[member] + found.right[enough] - length)
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if which:
        w, b, e = (np.concatenate(x) for x in (which, begin, end))
        order = np.lexsort((b, w))
        for i, x, y in zip(w[order].tolist(), b[order].tolist(), e[order].tolist()):
            have = out[i]
            if have and x <= have[-1][1] + 1:
                have[-1] = (have[-1][0], max(have[-1][1], y))
            else:
                have.append((x, y))
    return out


# --- Chunks ---------------------------------------------------------------------------------------------


class _Piece:
    """Bytes of some rows of a chunk, and the anchors its windows choose."""

    def __init__(self, base: int, texts: Texts, length: int, gram: int):
        self.base, self.texts = base, texts
        self.hashes = window_hashes(byte_values(texts.data), gram)
        self.chosen, self.low, self.high = anchors(self.hashes, texts.row_of_byte(), length - gram + 1, length)
        self.keys = self.hashes[self.chosen]
        del self.hashes


def _pieces(rows: Rows, length: int, gram: int) -> Iterator[_Piece]:
    for batch, texts in pieces(rows.batches()):
        yield _Piece(batch.column("row")[0].as_py(), texts, length, gram)


def _keys(parts: list[_Piece], n: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p.keys for p in parts]) if parts else np.zeros(0, dtype=np.uint64)
    keys, counts = np.unique(keys, return_counts=True)
    order = paged(keys, n)
    return keys[order], counts[order].astype(np.uint32)


def _coded(parts: list[_Piece], answers: pa.Table, n: int) -> list[np.ndarray]:
    """How often the gram of each anchor occurs in all: once, some times or many."""
    keys, _ = _keys(parts, n)
    code = read_answers(answers, 0)
    order = np.argsort(keys)
    keys, code = keys[order], code[order]
    return [code[np.searchsorted(keys, p.keys)] if len(keys) else np.zeros(0, np.uint8) for p in parts]


def _contexts(parts: list[_Piece], codes: list[np.ndarray], length: int, n: int) -> tuple[list[tuple], list[np.ndarray]]:
    """Distinct contexts (page, key, left, body, count), sorted; and for each piece's anchors with some occurrences the place of theirs."""
    found: dict[tuple, int] = {}
    mine = []
    for part, code in zip(parts, codes):
        body, here = part.texts.data.tobytes(), []
        some = np.flatnonzero(code == _SOME)
        for key, at, low, high in zip(part.keys[some].tolist(), part.chosen[some].tolist(), part.low[some].tolist(), part.high[some].tolist()):
            item = (key % n, key, at - low, body[low : high + length])
            found[item] = found.get(item, 0) + 1
            here.append(item)
        mine.append(here)
    listed = sorted(found)
    place = {item: i for i, item in enumerate(listed)}
    return [(*item, found[item]) for item in listed], [np.array([place[i] for i in here], dtype=np.int64) for here in mine]


def _windows(parts: list[_Piece], codes: list[np.ndarray], length: int, n: int) -> tuple:
    """Windows of anchors with many occurrences: distinct hashes in page order, with a second hash and the count of
    each; then the place of every window among the distinct, and by piece the windows' first bytes and where they end."""
    ats, every, second = [], [], []
    for part, code in zip(parts, codes):
        many = code == _MANY
        low, count = part.low[many], (part.high - part.low + 1)[many]
        at = np.sort(np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum())))
        values = byte_values(part.texts.data)
        ats.append(at)
        every.append(window_hashes(values, length)[at] if len(at) else np.zeros(0, np.uint64))
        second.append(window_hashes(mixed(values), length)[at] if len(at) else np.zeros(0, np.uint64))
    hashes = np.concatenate(every) if every else np.zeros(0, np.uint64)
    other = np.concatenate(second) if second else np.zeros(0, np.uint64)
    keys, first, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    order = paged(keys, n)
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.arange(len(keys))
    ends = np.cumsum([len(a) for a in ats])[:-1] if ats else []
    values = np.empty(len(keys), dtype=[("other", np.uint64), ("count", np.uint32)])
    values["other"], values["count"] = other[first][order], counts[order]
    return keys[order], values, place[inverse], ats, ends


def _how_often(most: int):
    def decide(chunk: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        _, at = np.unique(keys, return_inverse=True)
        total = np.bincount(at, weights=counts)[at]
        return np.where(total < 2, _ONCE, np.where(total <= most, _SOME, _MANY))

    return decide


def _more_than_once(chunk: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    both = np.empty(len(keys), dtype=[("key", np.uint64), ("other", np.uint64)])
    both["key"], both["other"] = keys, values["other"]
    _, at = np.unique(both, return_inverse=True)
    return np.bincount(at, weights=values["count"])[at] >= 2


def _write_contexts(chunk: int, listed: list[tuple]) -> pa.Table:
    pages: dict[int, list[tuple]] = {}
    for item in listed:
        pages.setdefault(item[0], []).append(item)
    return pa.table({
        "chunk": pa.array([chunk] * len(pages), pa.int64()),
        "page": pa.array(list(pages), pa.int64()),
        "keys": pa.array([np.array([x[1] for x in p], dtype=np.uint64).tobytes() for p in pages.values()], pa.binary()),
        "lefts": pa.array([np.array([x[2] for x in p], dtype=np.uint32).tobytes() for p in pages.values()], pa.binary()),
        "sizes": pa.array([np.array([len(x[3]) for x in p], dtype=np.uint32).tobytes() for p in pages.values()], pa.binary()),
        "counts": pa.array([np.array([x[4] for x in p], dtype=np.uint32).tobytes() for p in pages.values()], pa.binary()),
        "body": pa.array([b"".join(x[3] for x in p) for p in pages.values()], pa.binary()),
    })


_RUN = np.dtype([("context", np.uint32), ("first", np.uint32), ("last", np.uint32)])


def _answer_contexts(length: int, gram: int):
    def answer(table: pa.Table) -> pa.Table:
        def column(name: str, kind: type) -> list[np.ndarray]:
            return [np.frombuffer(x, dtype=kind) for x in table.column(name).to_pylist()]

        keys, lefts, sizes, counts = column("keys", np.uint64), column("lefts", np.uint32), column("sizes", np.uint32), column("counts", np.uint32)
        contexts = []
        for body, size in zip(table.column("body").to_pylist(), sizes):
            ends = np.cumsum(size, dtype=np.int64).tolist()
            contexts += [body[a:b] for a, b in zip([0, *ends], ends)]
        # Equal contexts of several chunks are one context that occurs so often.
        items = list(zip(np.concatenate(keys).tolist(), np.concatenate(lefts).tolist(), contexts))
        place: dict[tuple, int] = {}
        at = np.array([place.setdefault(x, len(place)) for x in items], dtype=np.int64)
        distinct = list(place)
        total = np.bincount(at, weights=np.concatenate(counts))
        found = repeated_windows(np.array([x[0] for x in distinct], dtype=np.uint64), [x[2] for x in distinct], np.array([x[1] for x in distinct], dtype=np.int64), total, length, gram)
        out, used = [], 0
        for size in sizes:
            listed = [(i, a, b) for i, x in enumerate(at[used : used + len(size)].tolist()) for a, b in found[x]]
            out.append(np.array(listed, dtype=_RUN).tobytes())
            used += len(size)
        return pa.table({"chunk": table.column("chunk"), "page": table.column("page"), "level": pa.array(np.full(len(out), 1, dtype=np.int32)), "answer": pa.array(out, pa.binary())})

    return answer


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, gram: int = GRAM, most: int = MOST, chunk_bytes: int = CHUNK_BYTES, carry: list[str] | None = None, as_text: bool = False) -> DataFrame:
    """(key, carried columns, n_bytes, n_removed, starts, ends, kept) of every row: the removed runs of bytes, and the bytes left.

    A byte goes if a string of `length` bytes over it also starts anywhere else, in the same text or another.
    Texts are UTF-8 bytes; a null text is empty; texts shorter than `length` stay whole. Strings are judged on the
    input. Rows equal in key and text repeat each other as any other two do. Keys are integers. `kept` is binary, as a run may begin inside a character; as_text makes it
    a string, without the characters that a run has cut.
    """
    if not 0 < gram < length:
        raise ValueError("a gram is shorter than a string")
    carry = carry or []
    dealt, n = deal(docs, key, text, chunk_bytes, carry)
    by_chunk = dealt.groupBy("chunk")

    def chunk_of(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def ask_grams(table: pa.Table) -> pa.Table:
        return write_pages(chunk_of(table), *_keys(list(_pieces(Rows(table), length, gram)), n), n)

    def ask_contexts(table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = list(_pieces(Rows(table), length, gram))
        return _write_contexts(chunk_of(table), _contexts(parts, _coded(parts, answers, n), length, n)[0])

    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = list(_pieces(Rows(table), length, gram))
        keys, values, *_ = _windows(parts, _coded(parts, answers, n), length, n)
        return write_pages(chunk_of(table), keys, values, n)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        rows = Rows(table)
        parts = list(_pieces(rows, length, gram))
        codes = _coded(parts, answers, n)
        listed, mine = _contexts(parts, codes, length, n)
        begin_of_page: dict[int, int] = {}
        for i, item in enumerate(listed):
            begin_of_page.setdefault(item[0], i)
        repeats: dict[int, list[tuple[int, int]]] = {}
        for page, level, body in zip(*(answers.column(c).to_pylist() for c in ("page", "level", "answer"))):
            if level == 1:
                for i, a, b in np.frombuffer(body, dtype=_RUN).tolist():
                    repeats.setdefault(begin_of_page[page] + i, []).append((a, b))
        _, _, place, ats, ends = _windows(parts, codes, length, n)
        again = read_answers(answers, 2).astype(bool)[place] if len(place) else np.zeros(0, dtype=bool)
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "starts": [], "ends": [], "kept": []}
        for part, code, here, at, flags in zip(parts, codes, mine, ats, np.split(again, ends)):
            first, last = [at[flags]], [at[flags]]
            for low, i in zip(part.low[code == _SOME].tolist(), here.tolist()):
                for a, b in repeats.get(i, ()):
                    first.append([low + a])
                    last.append([low + b])
            first, last = np.concatenate(first).astype(np.int64), np.concatenate(last).astype(np.int64)
            gone = cover(len(part.texts.data), first, last + length)
            body = part.texts.data
            for row, (a, b) in enumerate(zip(part.texts.offsets.tolist(), part.texts.offsets[1:].tolist()), part.base):
                if rows.times[row] > 1 and b - a >= length:
                    gone[a:b] = True
                s, e = runs(gone[a:b])
                out["n_bytes"].append(b - a)
                out["n_removed"].append(int((e - s).sum()))
                out["starts"].append(s.tolist())
                out["ends"].append(e.tolist())
                out["kept"].append(_text_left(body[a:b].tobytes(), s.tolist(), e.tolist()) if as_text else body[a:b][~gone[a:b]].tobytes())
        table = rows.out(n_bytes=pa.array(out["n_bytes"], pa.int64()), n_removed=pa.array(out["n_removed"], pa.int64()), starts=pa.array(out["starts"], pa.list_(pa.int64())), ends=pa.array(out["ends"], pa.list_(pa.int64())), kept=pa.array(out["kept"], pa.string() if as_text else pa.binary()))
        return table.rename_columns([key, *carry, *table.column_names[1 + len(carry) :]])

    answers = answered(by_chunk.applyInArrow(ask_grams, PAGE), 0, np.uint32, _how_often(most))
    contexts = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(ask_contexts, CONTEXTS)
    windows = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(ask_windows, PAGE)
    found = contexts.groupBy("page").applyInArrow(_answer_contexts(length, gram), ANSWER)
    again = answered(windows, 2, np.dtype([("other", np.uint64), ("count", np.uint32)]), _more_than_once)
    everything = answers.unionByName(found).unionByName(again)
    given = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in [key, *carry])
    schema = f"{given}, n_bytes long, n_removed long, starts array<long>, ends array<long>, kept {"string" if as_text else "binary"}"
    return by_chunk.cogroup(everything.groupBy("chunk")).applyInArrow(remove, schema)


def _text_left(body: bytes, starts: list[int], ends: list[int]) -> str:
    return "".join(body[a:b].decode("utf-8", "ignore") for a, b in zip([0, *ends], [*starts, len(body)]))
