"""BPE encoding and decoding through a table of distinct words.

Texts are dealt into chunks of a bounded size. A chunk lists its distinct words (the pieces the
tokenizer's own pattern splits a text into) in pages by word hash; all pages of one hash meet in
one task, which encodes each distinct word once; the ids come back to the chunk and are joined to
its words by position in the page. Decoding joins ids to the pieces of the vocabulary.

A run of texts is split as a whole: the kind of each character says where words begin, and Arrow's dictionaries tell words apart.

Pages rather than one row per word keep the shuffle small: a chunk's list costs a few bytes a word.
Pages and chunks are bounded: there are as many page hashes as chunks, and both grow with the text.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .interpolation import DEALT, MOST_PARTITIONS, packed, unpacked
from .tokens import Texts, byte_hashes

# How byte-level BPE splits a text, and how it writes bytes as characters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

CHUNK_BYTES = 6 << 20
_GATHER = 1 << 20
_LETTER, _NUMBER, _WHITE, _OTHER = range(4)


def _byte_of_character() -> dict[str, int]:
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point the kind that SPLIT takes it for."""
    kinds = np.full(0x110000, _OTHER, dtype=np.uint8)
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
        for found in regex.finditer(pattern, every):
            kinds[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
    return kinds


class Vocabulary:
    """One tokenizer file: its splitter, its encoder and the bytes of each id."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.model = Tokenizer.from_file(path).model
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.find_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))).finditer
        bytes_of, vocab = _byte_of_character(), spec["model"]["vocab"] | self.special
        self.as_characters = {b: c for c, b in bytes_of.items()}
        pieces = [b""] * (max(vocab.values()) + 1)
        for word, i in vocab.items():
            pieces[i] = bytes(bytes_of[c] for c in word) if all(c in bytes_of for c in word) else word.encode()
        self.pieces = pa.array(pieces, pa.binary())

    def starts(self, texts: Texts) -> np.ndarray:
        """First byte of each word: what SPLIT finds in each text, from its begin or the special token before on."""
        raw = texts.data.tobytes()
        plain = raw.isascii()
        codes = texts.data if plain else np.frombuffer(raw.decode().encode("utf-32-le"), dtype="<u4")
        place = None if plain else np.flatnonzero((texts.data & 0xC0) != 0x80)
        offsets = texts.offsets if plain else np.searchsorted(place, texts.offsets)
        n = len(codes)
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets] = True
        special = self._special(raw, offsets)
        cut[[x for span in special for x in span]] = True
        kind = _kinds()[codes]
        edge = cut.copy()
        edge[1:n] |= kind[1:] != kind[:-1]
        # The last of white space before something else is a word of its own; if it is a space, with what follows.
        last = (kind == _WHITE) & edge[1:] & ~cut[1:]
        begin = edge[:n] | last
        begin[1:][(last & (codes == 0x20))[:-1]] = False
        self._shorten(begin, codes, cut)
        for a, b in special:
            begin[a + 1 : b] = False
        at = np.flatnonzero(begin)
        return at if plain else place[at]

    def _special(self, raw: bytes, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Begin and end of each special token, in characters. None goes from one text to the next."""
        if not any(s.encode() in raw for s in self.special):
            return []
        text = raw.decode()
        return [x.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) if a < b for x in self.find_special(text, a, b)]

    @staticmethod
    def _shorten(begin: np.ndarray, codes: np.ndarray, cut: np.ndarray) -> None:
        """Words 's, 't, 're, 've, 'm, 'll and 'd: an apostrophe that begins a word ends it after these letters."""
        at = np.flatnonzero(begin & (codes == ord("'")))
        at = at[~cut[at + 1]]
        one = np.isin(codes[at + 1], list(map(ord, "stmd")))
        two = at[~one & ~cut[np.minimum(at + 2, len(codes))]]
        pairs = [[ord(c) for c in x] for x in ("re", "ve", "ll")]
        two = two[np.any([(codes[two + 1] == a) & (codes[two + 2] == b) for a, b in pairs], axis=0)]
        for found, size in ((at[one], 2), (two, 3)):
            begin[found + 1] = False
            end = found + size
            begin[end[end < len(begin)]] = True

    def words(self, texts: Texts) -> tuple[pa.Array, np.ndarray]:
        """All words of a run of texts, one after the other, and the place in them where each text begins, and the last ends."""
        start = self.starts(texts)
        ends = np.append(start, len(texts.data)).astype(np.int32)
        found = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(texts.data)])
        return found, np.searchsorted(start, texts.offsets)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has. They are split already, so the model itself gets them."""
        special = {s.encode(): [i] for s, i in self.special.items()}
        table, tokenize = self.as_characters, self.model.tokenize
        found = [special[w] if w in special else [t.id for t in tokenize(w.decode("latin-1").translate(table))] for w in words]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(counts.sum())), counts

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of runs of ids that end at `ends`: a join of ids to the vocabulary by id. What is no UTF-8 becomes U+FFFD."""
        body, size = [], [np.zeros(1, np.int64)]
        for k in range(0, len(ids), _GATHER):
            part = self.pieces.take(pa.array(ids[k : k + _GATHER].view(np.int32)))
            offsets = np.frombuffer(part.buffers()[1], dtype=np.int32)[: len(part) + 1]
            body.append(part.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]] if offsets[-1] else b"")
            size.append(np.diff(offsets))
        raw, at = b"".join(body), np.cumsum(np.concatenate(size))[np.concatenate(([0], ends))]
        try:
            return _binary(raw, at).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(at.tolist(), at[1:].tolist())], pa.string())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each run, one run after the other."""
    total = int(length.sum())
    shift = begin - np.concatenate(([0], np.cumsum(length)[:-1])) if len(length) else begin
    return np.repeat(shift, length) + np.arange(total, dtype=np.int64)


def _binary(raw: bytes | pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """The parts of raw between offsets."""
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])


def _distinct(words: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of some arrays, and for each array their places."""
    # As one array: of several, Arrow would make a dictionary each.
    found = pa.concat_arrays([*words, pa.array([], pa.binary())]).dictionary_encode()
    return found.dictionary, np.split(found.indices.to_numpy(), np.cumsum([len(x) for x in words])[:-1])


def _raw(words: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of words that `take` has put one after the other, and where each begins, and the last ends."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    return memoryview(words.buffers()[2] or b""), offsets


def _pages(words: pa.Array, n_pages: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of distinct words by page and word, the same whatever order they come in, and the page of each, in that order."""
    raw, offsets = _raw(words)
    page = (byte_hashes(np.frombuffer(raw, dtype=np.uint8), offsets.astype(np.int64)) % np.uint64(n_pages)).astype(np.int64)
    order = pc.sort_indices(pa.table({"page": page, "word": words}), sort_keys=[("page", "ascending"), ("word", "ascending")]).to_numpy().astype(np.int64)
    return order, page[order]


def _pack(raw: memoryview, offsets: np.ndarray) -> tuple[bytes, bytes]:
    # Sorted words and their short lengths compress well, which is most of what a page costs.
    return zlib.compress(raw[offsets[0] : offsets[-1]], 1), _pack_numbers(np.diff(offsets))


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers as 32-bit ones, all lowest bytes first: the others are mostly zero, and vanish."""
    return zlib.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_numbers(body: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(4, -1).T.tobytes(), dtype="<u4")


def _unpack(body: bytes, lengths: bytes) -> pa.Array:
    return _binary(zlib.decompress(body), np.concatenate(([0], np.cumsum(_unpack_numbers(lengths), dtype=np.int64))))


_PAGES = "chunk long, page long, words binary, lengths binary"
_IDS = "chunk long, page long, ids binary, counts binary"


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES, decoded: bool = False) -> DataFrame:
    """Ids of every text: (key, ids binary), ids little-endian unsigned 32-bit, one row per row of docs. With `decoded`
    also the text that they decode to, as `decode` gives it, but by the task that has the ids: else a task keeps two
    Python workers, each with the vocabulary, and workers stay for what runs next.

    A null or empty text has no ids. Rows that repeat are encoded each; docs should be a table that reads alike again. path: a byte-level BPE file
    that driver and executors can read. One number (the bytes of text) goes to the driver.
    """
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.lit(0).alias("role"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    # Equal rows are dealt out as well: the row's own number is part of the hash.
    chunk = F.pmod(F.xxhash64("key", "text", F.monotonically_increasing_id()), F.lit(n))
    runs = rows.withColumn("chunk", chunk).mapInArrow(packed, DEALT.format(docs.schema[key].dataType.simpleString()))
    dealt = runs.repartition(min(n, MOST_PARTITIONS), "chunk")

    def list_words(table: pa.Table) -> pa.Table:
        # Of a run only its distinct words are kept.
        runs = [vocabulary(path).words(run)[0].unique() for _, run in unpacked(table)]
        words, _ = _distinct(runs)
        order, page = _pages(words, n)
        raw, offsets = _raw(words.take(pa.array(order)))
        begin = np.flatnonzero(np.diff(page, prepend=-1))
        packed = [_pack(raw, offsets[a : b + 1]) for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(page)])]
        return pa.table({
            "chunk": pa.array([table.column("chunk")[0].as_py()] * len(begin), pa.int64()),
            "page": pa.array(page[begin]),
            "words": pa.array([body for body, _ in packed], pa.binary()),
            "lengths": pa.array([lengths for _, lengths in packed], pa.binary()),
        })

    def encode_words(table: pa.Table) -> pa.Table:
        distinct, places = _distinct([_unpack(b, n) for b, n in zip(table.column("words").to_pylist(), table.column("lengths").to_pylist())])
        flat, count = vocabulary(path).encode(distinct.to_pylist())
        begin = np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else count
        out_ids = [_pack_numbers(flat[spread(begin[at], count[at])]) for at in places]
        out_counts = [_pack_numbers(count[at]) for at in places]
        return pa.table({"chunk": table.column("chunk"), "page": table.column("page"), "ids": pa.array(out_ids, pa.binary()), "counts": pa.array(out_counts, pa.binary())})

    def join_back(left: pa.Table, right: pa.Table) -> pa.Table:
        known = vocabulary(path)
        runs = [known.words(run) for _, run in unpacked(left)]
        words, places = _distinct([found for found, _ in runs])
        runs = [first for _, first in runs]
        right = right.sort_by("page")
        ids, counts = (np.concatenate([np.zeros(0, np.uint32), *map(_unpack_numbers, right.column(c).to_pylist())]) for c in ("ids", "counts"))
        counts = counts.astype(np.int64)
        order, _ = _pages(words, n)
        count, begin = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        count[order] = counts
        begin[order] = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
        out_ids, out_texts = [], []
        for at, first in zip(places, runs):
            of_run = ids[spread(begin[at], count[at])]
            ends = np.concatenate(([0], np.cumsum(count[at])))[first]
            out_ids.append(_binary(of_run.astype("<u4").tobytes(), 4 * ends))
            out_texts += [known.decode(of_run, ends[1:])] if decoded else []
        keys = pa.concat_arrays([run.values for run in left.column("keys")]) if left.num_rows else pa.array([], left.schema.field("keys").type.value_type)
        text = {"text": pa.chunked_array(out_texts, pa.string())} if decoded else {}
        return pa.table({key: keys, "ids": pa.chunked_array(out_ids, pa.binary()), **text})

    # Both uses of `dealt` take all its columns, so that Spark sees one shuffle and reuses it.
    pages = dealt.groupBy("chunk").applyInArrow(list_words, _PAGES)
    encoded = pages.groupBy("page").applyInArrow(encode_words, _IDS)
    text_field = [StructField("text", StringType())] if decoded else []
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("ids", BinaryType()), *text_field])
    return dealt.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(join_back, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Texts of ids as `encode` gives them: (key, ids, text). Special tokens are written out; bytes that are
    no UTF-8 become U+FFFD."""
    from pyspark.sql.types import StringType, StructField, StructType

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            ids = batch.column("ids")
            ends = np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False), dtype=np.int64) // 4
            text = words.decode(np.frombuffer(b"".join(ids.to_pylist()), dtype="<u4"), ends)
            yield pa.RecordBatch.from_arrays([batch.column(key), ids, text], names=[key, "ids", "text"])

    schema = StructType([encoded.schema[key], encoded.schema["ids"], StructField("text", StringType())])
    return encoded.select(key, "ids").mapInArrow(texts, schema)


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of ids and text; more columns may be named."""
    return decoded.select(
        "doc_id",
        *more,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
