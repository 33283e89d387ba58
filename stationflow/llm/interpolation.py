"""Scores of texts under an n-gram language model with deleted interpolation.

A text is its words and one end. The estimate of a word after the n - 1 before it is mixed with that of one word less, down
to an even chance for each known word and one for all others. How much each estimate weighs depends on how often its
context occurs, in buckets of powers of two. The weights are learned by expectation-maximisation on a part of the
training texts, from the counts of the rest; scores take the counts of all training texts.

Texts are dealt into chunks. A chunk lists its distinct n-grams with their counts, in pages by hash; all
pages of one number are added up in one task, and the totals go back to the chunk, by position. So an n-gram that all
texts hold costs an entry per chunk. Orders are counted one after the other: an n-gram that holds a shorter one known to
no other chunk is known to no other chunk either, and isn't listed. Of a text its counts are kept, a few
bytes a word, which is all that learning the weights and scoring read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder
from .tokens import _BASE, Texts, Words, mixed, pieces

CHUNK_BYTES = 8 << 20
#: Bytes of text that are dealt to chunks at once.
RUN_BYTES = 16 << 20
#: Bytes of text whose n-grams make up a page.
PAGE_BYTES = 16 << 20
#: Chunks and pages beyond so many go through a task one after the other.
MOST_PARTITIONS = 20_000

START, END = (mixed(np.array([x], dtype=np.uint64))[0] for x in (0x51ED27001, 0x51ED27002))

#: One training text in so many learns the weights.
DELETED = 10
#: There is a weight for each power of two of a context's count.
BUCKETS = 64
#: No estimate weighs less, nor all but so little.
LEAST = 1e-6
HELD_OUT, KEPT, LEARNS = 0, 1, 2

#: Of n-grams told apart by hashes, one in two to so many meets another.
SPARE_BITS = 24
#: Tokens of a block, but for a longer text, which is one.
BLOCK_TOKENS = 1 << 16

#: Of compression: quick, for what is read again soon.
LEVEL = 3

DEALT = "chunk long, keys array<{}>, roles binary, sizes binary, body binary"
_LISTED = "chunk long, page long, level int, keys binary, t binary, e binary"
_TOTALS = "chunk long, page long, level int, alone binary, t binary, e binary"


def pack(numbers: np.ndarray, raw: bool = False) -> bytes:
    """Numbers, lowest bytes first and all bytes of one rank together, as wide as the largest needs. raw: the lower ones are random."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    plain = max(0, width - 2) if raw else 0
    return bytes([width, plain]) + len(numbers).to_bytes(8, "little") + planes[:plain].tobytes() + zstandard.compress(planes[plain:].tobytes(), LEVEL)


def unpack(body: bytes) -> np.ndarray:
    width, plain = body[0], body[1]
    size = int.from_bytes(body[2:10], "little")
    at = 10 + plain * size
    planes = np.frombuffer(body[10:at] + zstandard.decompress(body[at:]), dtype=np.uint8).reshape(width, size)
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1).astype(np.int64)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, text, role, chunk) as one row for each chunk and run of rows, with the texts together and compressed."""
    for batch, texts in pieces(batches, most=RUN_BYTES):
        chunk, role = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "role"))
        order = np.argsort(chunk, kind="stable")
        edges = np.flatnonzero(np.diff(chunk[order], prepend=chunk[order[0]] - 1))
        size, raw, begin = np.diff(texts.offsets), texts.data.tobytes(), texts.offsets.tolist()
        parts = np.split(order, edges[1:])
        body = [zstandard.compress(b"".join(raw[begin[i] : begin[i + 1]] for i in part.tolist()), LEVEL) for part in parts]
        keys = pa.ListArray.from_arrays(pa.array([*edges.tolist(), len(order)], pa.int32()), batch.column("key").take(pa.array(order)))
        columns = [pa.array(chunk[order[edges]]), keys, pa.array([role[p].astype(np.int8).tobytes() for p in parts], pa.binary()), pa.array([pack(size[p]) for p in parts], pa.binary()), pa.array(body, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["chunk", "keys", "roles", "sizes", "body"])


def unpacked(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The texts of a chunk, in runs."""
    for sizes, body in zip(table.column("sizes").to_pylist(), table.column("body").to_pylist()):
        offsets = np.concatenate(([0], np.cumsum(unpack(sizes))))
        raw = zstandard.decompress(body) if offsets[-1] else b""
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
        yield from pieces(iter([pa.RecordBatch.from_arrays([texts], names=["text"])]))


def ascending(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order, and their places, of equal ones in that of their places.

    What is sorted are numbers, which is several times as quick as sorting places: of each key the highest bits, with its place below.
    Keys that differ only in the bits that found no room are put in order afterwards; of hashes these are few.
    """
    width = len(keys).bit_length()
    drop = np.uint64(max(0, int(keys.max(initial=0)).bit_length() + width - 64))
    numbers = keys >> drop
    numbers <<= np.uint64(width)
    numbers |= np.arange(len(keys), dtype=np.uint64)
    numbers.sort()
    order = (numbers & np.uint64((1 << width) - 1)).view(np.int64)
    numbers >>= np.uint64(width)
    if not drop:
        return numbers, order
    found = keys[order]
    for high in np.unique(numbers[1:][found[1:] < found[:-1]]):
        a, b = np.searchsorted(numbers, high), np.searchsorted(numbers, high, side="right")
        order[a:b] = order[a:b][np.argsort(found[a:b], kind="stable")]
        found[a:b] = keys[order[a:b]]
    return found, order


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, which of them each key is, the places of keys in their order, and where in that order each distinct one begins."""
    found, order = ascending(keys)
    new = np.ones(len(found), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    number = np.cumsum(new)
    number -= 1
    inverse = np.empty(len(found), dtype=np.int64)
    inverse[order] = number
    begin = np.flatnonzero(new)
    return found[begin], inverse, order, begin


def sums_from(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of values from each of `begin`, the first of which is 0, up to the next."""
    ends = np.append(begin[1:], len(values))[: len(begin)] - 1
    return np.diff(np.cumsum(values, dtype=np.int64)[ends], prepend=0)


def short_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """As window_hashes, for windows so short that their few values are sooner added up than prefix sums are made."""
    n = max(0, len(values) - length + 1)
    out = values[:n].copy()
    for i in range(1, length):
        out += values[i : i + n] * np.uint64(pow(_BASE, i, 2**64))
    return mixed(out)


class Grams:
    """The n-grams that end at each token of a chunk. gram[k] has those of k words; ahead of a text stand START words.

    orders: the k that are wanted, all if None.
    """

    def __init__(self, table: pa.Table, order: int, bits: int = 64, orders: list[int] | None = None):
        gram, size = [[np.zeros(0, np.uint64)] for _ in range(order + 1)], [np.zeros(0, np.int64)]
        for _, texts in unpacked(table):
            words = Words(texts, lower=True)
            first = np.concatenate(([0], np.cumsum(words.count + order)))
            padded = np.full(int(first[-1]), START, dtype=np.uint64)
            padded[words.row * order + np.arange(len(words.row)) + order - 1] = words.hash
            padded[first[1:] - 1] = END
            token = np.ones(len(padded), dtype=bool)
            for k in range(order - 1):
                token[first[:-1] + k] = False
            at = np.flatnonzero(token)
            for k in range(1, order + 1) if orders is None else orders:
                gram[k].append(short_hashes(padded, k)[at - k + 1] >> np.uint64(64 - bits) if len(at) else np.zeros(0, np.uint64))
            size.append(words.count + 1)
        self.gram = [np.concatenate(g) for g in gram]
        self.size = np.concatenate(size)
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        #: Of each row, and of each token.
        self.roles = np.frombuffer(b"".join(table.column("roles").to_pylist()), dtype=np.int8)
        self.role = np.repeat(self.roles, self.size)

    def opens(self) -> np.ndarray:
        out = np.zeros(len(self.role), dtype=bool)
        out[self.first[:-1]] = True
        return out

    def distinct(self, k: int) -> Distinct:
        keys, inverse, order, begin = grouped(self.gram[k])
        role = self.role[order]
        return Distinct(keys, inverse, sums_from(role != HELD_OUT, begin), sums_from(role == LEARNS, begin))


class Distinct:
    """Distinct n-grams of a chunk. inverse: of each token, its n-gram. t, e: how often training texts have it, and those that learn.

    What other chunks have is added by `tell`, if it is told; alone: no other chunk has it.
    """

    def __init__(self, keys: np.ndarray, inverse: np.ndarray, t: np.ndarray, e: np.ndarray):
        self.keys, self.inverse, self.t, self.e = keys, inverse, t, e
        self.alone = np.ones(len(keys), dtype=bool)

    def order(self, chosen: np.ndarray | None, pages: int) -> np.ndarray:
        """Those chosen, by page, then by name, in the order of which they are already."""
        at = np.arange(len(self.keys)) if chosen is None else np.flatnonzero(chosen)
        page = (self.keys[at] % np.uint64(pages)).astype(np.uint16 if pages <= 1 << 16 else np.uint64)
        return at[np.argsort(page, kind="stable")]

    def pages(self, chunk: int, level: int, chosen: np.ndarray | None, pages: int) -> list[tuple]:
        at = self.order(chosen, pages)
        number = (self.keys[at] % np.uint64(pages)).astype(np.int64)
        edges = np.flatnonzero(np.diff(number)) + 1
        out = []
        for part in np.split(at, edges) if len(at) else []:
            above, page = self.keys[part] // np.uint64(pages), int(self.keys[part[0]] % np.uint64(pages))
            out.append((chunk, page, level, pack(np.diff(above, prepend=np.uint64(0)), raw=True), pack(self.t[part]), pack(self.e[part])))
        return out

    def tell(self, chosen: np.ndarray | None, totals: list[tuple], pages: int) -> None:
        at = self.order(chosen, pages)
        alone, t, e = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, flags, some_t, some_e in sorted(totals, key=lambda x: x[0]):
            alone.append(unpack(flags))
            if some_t is not None:
                t.append(unpack(some_t))
                e.append(unpack(some_e))
        alone = np.concatenate(alone).astype(bool)
        if len(alone) != len(at):
            raise RuntimeError("a chunk's texts are not the same as when it listed them: save the input first")
        self.alone[at] = alone
        if len(t) > 1:
            self.t[at[~alone]], self.e[at[~alone]] = np.concatenate(t), np.concatenate(e)


def _listed(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 6
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["chunk", "page", "level", "keys", "t", "e"])


def _add_up(n: int):
    def add(table: pa.Table) -> pa.Table:
        """Totals of all n-grams of a page, for each chunk that lists some; of single words, what they add up to as well."""
        keys, t, e = ([unpack(x) for x in table.column(c).to_pylist()] for c in ("keys", "t", "e"))
        sizes = [len(k) for k in keys]
        names, inverse, order, begin = grouped(np.concatenate([np.cumsum(k.view(np.uint64), dtype=np.uint64) for k in keys]))
        all_t, all_e = (sums_from(np.concatenate(x)[order], begin) for x in (t, e))
        alone = np.diff(begin, append=len(order)) == 1
        page, level = table.column("page")[0].as_py(), table.column("level")[0].as_py()
        out = []
        for chunk, part in zip(table.column("chunk").to_pylist(), np.split(inverse, np.cumsum(sizes)[:-1])):
            shared = part[~alone[part]]
            out.append((chunk, page, level, pack(alone[part]), pack(all_t[shared]), pack(all_e[shared])))
        if level == 1:
            facts = np.array([all_t.sum(), all_e.sum(), (all_t > 0).sum()])
            out.append((page % n, page, 0, pack(facts), b"", b""))
        return _listed(out).rename_columns(["chunk", "page", "level", "alone", "t", "e"])

    return add


def _told(grams: Grams, totals: pa.Table, orders: list[int], pages: int) -> dict[int, Distinct]:
    """Of these orders, the distinct n-grams of a chunk with what other chunks have."""
    by_level: dict[int, list[tuple]] = {}
    for row in zip(*(totals.column(c).to_pylist() for c in ("level", "page", "alone", "t", "e"))):
        by_level.setdefault(row[0], []).append(row[1:])
    found: dict[int, Distinct] = {}
    for k in orders:
        found[k] = grams.distinct(k)
        found[k].tell(_shared(grams, found, k), by_level.get(k, []), pages)
    return found


def _shared(grams: Grams, found: dict[int, Distinct], k: int) -> np.ndarray | None:
    """Of the distinct n-grams of k words, those whose first and last k - 1 words other chunks have as well. Of single words
    and pairs: all."""
    if k < 3:
        return None
    less = ~found[k - 1].alone[found[k - 1].inverse]
    before = np.concatenate(([True], less[:-1])) if len(less) else less
    out = np.zeros(len(found[k].keys), dtype=bool)
    out[found[k].inverse] = less & (before | grams.opens())
    return out


def counted(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", order: int = 3, deleted: int = DELETED, chunk_bytes: int = CHUNK_BYTES, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """Blocks of rows, with how often training texts have the n-grams that end at each of their tokens.

    Returns learns (whether its rows learn the weights), keys (array), sizes (tokens of each row), counts (array, one entry for each length from 1, of all tokens of the block),
    learners_counts (of rows that learn: how many of these occurrences are in texts that learn) and texts (training rows); tokens, learning and
    known add up, over all blocks, to the training tokens, those of texts that learn, and the distinct ones. Numbers are packed.
    The last block of a chunk is without rows.
    """
    learns = F.pmod(F.xxhash64(F.col(key)), F.lit(deleted)) == 0
    role = F.when(~F.coalesce(training, F.lit(False)), HELD_OUT).when(learns, LEARNS).otherwise(KEPT)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), role.cast("int").alias("role"))
    total = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n, n_pages = max(1, -(-total // chunk_bytes)), max(1, -(-total // page_bytes))
    # So wide that one n-gram in 2^SPARE_BITS meets another, while there are 64 bits.
    bits = min(64, total.bit_length() + SPARE_BITS)
    # Equal rows are dealt out as well: the row's own number is part of the hash.
    chunk = F.pmod(F.xxhash64("key", "text", F.monotonically_increasing_id()), F.lit(n))
    key_type = rows.schema["key"].dataType.simpleString()
    dealt = rows.withColumn("chunk", chunk).mapInArrow(packed, DEALT.format(key_type)).repartition(min(n, MOST_PARTITIONS), "chunk")
    by_chunk = dealt.groupBy("chunk")

    def added(listed: DataFrame, levels: int) -> DataFrame:
        pages = listed.repartition(min(n_pages * levels, MOST_PARTITIONS), "level", "page")
        return pages.groupBy("level", "page").applyInArrow(_add_up(n), _TOTALS)

    def list_short(table: pa.Table) -> pa.Table:
        short, number = [*range(1, min(order, 2) + 1)], table.column("chunk")[0].as_py()
        grams = Grams(table, order, bits, short)
        return _listed([x for k in short for x in grams.distinct(k).pages(number, k, None, n_pages)])

    def lister(k: int):
        def list_longer(table: pa.Table, totals: pa.Table) -> pa.Table:
            if not table.num_rows:
                return _listed([])
            grams = Grams(table, order, bits, [*range(2, k + 1)])
            found = _told(grams, totals, [*range(2, k)], n_pages)
            longer = grams.distinct(k)
            return _listed(longer.pages(table.column("chunk")[0].as_py(), k, _shared(grams, found | {k: longer}, k), n_pages))

        return list_longer

    kind = pa.list_(pa.binary())

    def keep(table: pa.Table, totals: pa.Table) -> pa.Table:
        facts = np.zeros(3, dtype=np.int64)
        for body, level in zip(totals.column("alone").to_pylist(), totals.column("level").to_pylist()):
            if level == 0:
                facts += unpack(body)
        out: dict[str, list] = {c: [] for c in ("learns", "keys", "sizes", "counts", "learners_counts", "texts")}
        if table.num_rows:
            grams = Grams(table, order, bits)
            found = _told(grams, totals, [*range(1, order + 1)], n_pages)
            keys = [k for run in table.column("keys").to_pylist() for k in run]
            for learns in (False, True):
                rows, tokens = np.flatnonzero((grams.roles == LEARNS) == learns), np.flatnonzero((grams.role == LEARNS) == learns)
                ends = np.cumsum(grams.size[rows])
                # A block ends with the row that fills it.
                edges = np.flatnonzero(np.diff((ends - 1) // BLOCK_TOKENS)) + 1
                for part in np.split(np.arange(len(rows)), edges) if len(rows) else []:
                    some = tokens[ends[part[0]] - grams.size[rows[part[0]]] : ends[part[-1]]]
                    out["learns"].append(learns)
                    out["keys"].append([keys[i] for i in rows[part].tolist()])
                    out["sizes"].append(pack(grams.size[rows[part]]))
                    out["counts"].append([pack(d.t[d.inverse[some]]) for d in found.values()])
                    out["learners_counts"].append([pack(d.e[d.inverse[some]]) for d in found.values()] if learns else None)
                    out["texts"].append(int((grams.roles[rows[part]] != HELD_OUT).sum()))
        blocks = len(out["keys"])
        types = {"learns": pa.bool_(), "keys": table.schema.field("keys").type, "sizes": pa.binary(), "counts": kind, "learners_counts": kind, "texts": pa.int64()}
        last = {"learns": False, "keys": []}
        return pa.table({
            **{c: pa.array([*values, last.get(c)], types[c]) for c, values in out.items()},
            **{c: pa.array([*[None] * blocks, int(facts[i])], pa.int64()) for i, c in enumerate(("tokens", "learning", "known"))},
        })

    totals = added(by_chunk.applyInArrow(list_short, _LISTED), 2)
    for k in range(3, order + 1):
        # What a chunk needs to know by now: which of its shorter n-grams no other chunk has.
        known = totals.filter(f"level BETWEEN 2 AND {k - 1}").select("chunk", "page", "level", "alone", *[F.lit(None).cast("binary").alias(c) for c in "te"])
        listed = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(lister(k), _LISTED)
        totals = totals.unionByName(added(listed, 1))
    schema = f"learns boolean, keys array<{key_type}>, sizes binary, counts array<binary>, learners_counts array<binary>, texts long, tokens long, learning long, known long"
    return by_chunk.cogroup(totals.groupBy("chunk")).applyInArrow(keep, schema)


class Model:
    """weights[k, b]: what the estimate from k - 1 words weighs where these occur 2^b to 2^(b+1) - 1 times."""

    def __init__(self, order: int, tokens: int, known: int):
        self.order, self.tokens, self.known = order, tokens, known
        self.weights = np.full((order + 1, BUCKETS), 0.5)

    def mixture(self, counts: list[np.ndarray], first: np.ndarray, texts: int) -> tuple[list, list, list]:
        """Of each order: bucket of each token (-1: its context is unknown), weighted estimate, mixed probability.

        first: whether a token opens its text, where the context is that of all texts' first words.
        """
        p = [np.full(len(first), 1 / (self.known + 1))]
        buckets, parts = [None], [None]
        for k in range(1, self.order + 1):
            before = np.concatenate(([0], counts[k - 2][:-1])) if k > 1 and len(first) else np.zeros(len(first), np.int64)
            context = np.where(first, texts, before) if k > 1 else np.full(len(first), self.tokens)
            bucket = np.where(context > 0, np.frexp(np.maximum(context, 1).astype(np.float64))[1] - 1, -1)
            weight = np.where(bucket >= 0, self.weights[k][bucket], 0.0)
            parts.append(weight * counts[k - 1] / np.maximum(context, 1))
            p.append(parts[k] + (1 - weight) * p[k - 1])
            buckets.append(bucket)
        return buckets, parts, p

    def expected(self, counts: list[np.ndarray], first: np.ndarray, texts: int) -> np.ndarray:
        """[k, b]: how often the estimate of order k is expected to have made a token where it could, and how often it could."""
        buckets, parts, p = self.mixture(counts, first, texts)
        out, reach = np.zeros((2, self.order + 1, BUCKETS)), np.ones(len(first))
        for k in range(self.order, 0, -1):
            made = reach * parts[k] / p[k]
            could = buckets[k] >= 0
            for i, x in enumerate((made, reach)):
                out[i, k] = np.bincount(buckets[k][could], weights=x[could], minlength=BUCKETS)[:BUCKETS]
            reach = reach - made
        return out


def _tokens(sizes: bytes, counts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Sizes of the rows of a block, counts of each order, and whether a token opens its row."""
    size = unpack(sizes)
    first = np.zeros(int(size.sum()), dtype=bool)
    first[np.cumsum(size) - size] = True
    return size, [unpack(c) for c in counts], first


def learn(learning: DataFrame, model: Model, texts: int, rounds: int = 12, enough: float = 1e-3) -> Model:
    """Weights by expectation-maximisation over blocks that learn, from even ones, until none of them moves by `enough`.

    texts: how many training texts don't learn. A round is a job; a table of 64 weights an order goes to the driver. Weights are
    rounded to six places, so that the order in which tasks are added up leaves no trace.
    """
    order = model.order
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, order + 1, BUCKETS))
            for batch in batches:
                for sizes, counts, learners in zip(*(batch.column(c).to_pylist() for c in ("sizes", "counts", "learners_counts"))):
                    _, counts, first = _tokens(sizes, counts)
                    sums += model.expected([t - unpack(e) for t, e in zip(counts, learners)], first, texts)
            k, b = np.nonzero(sums[1])
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(b), pa.array(sums[0, k, b]), pa.array(sums[1, k, b])], names=["k", "b", "made", "could"])

        found = learning.select("sizes", "counts", "learners_counts").mapInArrow(expect, "k long, b long, made double, could double")
        moved = 0.0
        for k, b, made, could in found.groupBy("k", "b").agg(F.sum("made"), F.sum("could")).collect():
            # Half a token each way, and never all: what no text had where the weights were learned may come yet.
            new = min(max(round((made + 0.5) / (could + 1), 6), LEAST), 1 - LEAST)
            moved = max(moved, abs(new - model.weights[k, b]))
            model.weights[k, b] = new
        if moved < enough:
            break
    return model


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", order: int = 3, **options) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row of docs, by a model of those where `training` is true.

    Tokens are the words with A-Z in lower case, and one end; a null text has the end only. n_known of them occur in training
    texts. base_score is the log10 probability under single counts plus a half, score under the model. A null
    `training` is false; rows with a null or repeated key are texts of their own; without training texts all scores
    are 0. Weights that no text learns stay at a half. n-grams are told apart by hashes. Of the corpus, five numbers and the
    weights go to the driver. docs should be a table that reads alike again.
    """
    found = counted(docs, training, key, text, order, **options)
    path = f"{shared_folder(docs.sparkSession).rstrip('/')}/counts-{uuid.uuid4().hex}"
    # Rounds of learning read the folder of the blocks that learn, and no others.
    found.write.partitionBy("learns").parquet(path)
    blocks = docs.sparkSession.read.schema(found.schema).parquet(path)
    kept = F.when(~F.col("learns"), F.col("texts"))
    tokens, learning, known, texts, kept = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "learning", "known", "texts", kept)]).first()
    model = Model(order, tokens - learning, known)
    if texts > kept:
        learn(blocks.filter("learns"), model, kept)
    model.tokens = tokens
    names = ["key", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (sizes, counts) in enumerate(zip(batch.column("sizes").to_pylist(), batch.column("counts").to_pylist())):
                size, counts, first = _tokens(sizes, counts)
                row = np.repeat(np.arange(len(size)), size)
                of_rows = lambda x: np.bincount(row, weights=x, minlength=len(size))  # noqa: B023, E731
                base = np.log10((counts[0] + 0.5) / (tokens + 0.5 * (known + 1)))
                p = model.mixture(counts, first, texts)[2][order]
                found = of_rows(counts[0] > 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("keys")[i].values, pa.array(size), pa.array(found), pa.array(np.full(len(size), tokens)), pa.array(of_rows(base)), pa.array(of_rows(np.log10(p)))], names=names)

    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    out = blocks.filter("sizes IS NOT NULL").select("keys", "sizes", "counts")
    return out.mapInArrow(judge, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double").withColumnRenamed("key", key)
