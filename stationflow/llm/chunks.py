"""Chunks of rows that ask and answer each other through pages.

Rows are dealt into chunks of about the same bytes of text by a hash. A chunk lists what it wants to know
about (hashes of windows, say) once each, whatever number of its rows hold it, in pages by hash. All
pages of one number meet in one task, which answers each by position; the answers go back to the chunk.
So a hash that a third of all rows hold costs one entry per chunk, no task holds more than its share, and an
entry costs its own bytes rather than a row. Chunks and pages are as many as the text needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 6 << 20

PAGE = "chunk long, page long, keys binary, values binary"
ANSWER = "chunk long, page long, level int, answer binary"


def chunked(docs: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """(key, text, carried columns as c0, c1, ..., chunk) of docs, where they are, and the number of chunks. A null text is empty.

    One number, the bytes of all texts, goes to the driver.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry or [])])
    n = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // chunk_bytes))
    return rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(n))), n


def deal(docs: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES, carry: list[str] | None = None) -> tuple[DataFrame, int]:
    """As `chunked`, with each chunk in one place. The result is meant to be used more than once in one plan: Spark
    shuffles it once and reuses that."""
    rows, n = chunked(docs, key, text, chunk_bytes, carry)
    return rows.repartition(n, "chunk"), n


class Rows:
    """The distinct rows of a chunk, in the order of key (null first) and text; whatever order they came in."""

    def __init__(self, table: pa.Table):
        self.table = table
        keys, texts = table.column("key").to_pylist(), table.column("text").to_pylist()
        distinct = sorted(set(zip(keys, texts)), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        place = {x: i for i, x in enumerate(distinct)}
        #: Of each row as it came, the place of its equal among the distinct ones.
        self.inverse = [place[x] for x in zip(keys, texts)]
        self.times = np.bincount(self.inverse, minlength=len(distinct))
        self.keys = np.array([np.iinfo(np.int64).min if k is None else k for k, _ in distinct], dtype=np.int64)
        self.texts = pa.array([t for _, t in distinct], pa.large_string())

    def batches(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(self.texts))), self.texts], names=["row", "text"])

    def out(self, **columns: list) -> pa.Table:
        """A table of the keys, the carried columns and others given by distinct row."""
        carried = {c: self.table.column(c) for c in self.table.column_names if c not in ("key", "text", "chunk")}
        return pa.table({"key": self.table.column("key")} | carried | {k: pa.array(v).take(pa.array(self.inverse, pa.int64())) for k, v in columns.items()})


def paged(keys: np.ndarray, n: int) -> np.ndarray:
    """Order of distinct keys by page and key."""
    return np.lexsort((keys, keys % np.uint64(n)))


def write_pages(chunk: int, keys: np.ndarray, values: np.ndarray, n: int) -> pa.Table:
    """keys in the order of `paged`, and a value for each."""
    page = (keys % np.uint64(n)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate(([True], page[1:] != page[:-1]))) if len(page) else page
    end = np.concatenate((begin[1:], [len(page)])).astype(np.int64) if len(page) else page
    return pa.table({
        "chunk": pa.array(np.full(len(begin), chunk, dtype=np.int64)),
        "page": pa.array(page[begin]),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(begin, end)], pa.binary()),
        "values": pa.array([values[a:b].tobytes() for a, b in zip(begin, end)], pa.binary()),
    })


def answered(pages: DataFrame, level: int, value_type: type, decide: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Answers to pages: decide(chunk, key, value of each entry) gives one byte per entry."""

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, dtype=np.uint64) for x in table.column("keys").to_pylist()]
        values = [np.frombuffer(x, dtype=value_type) for x in table.column("values").to_pylist()]
        sizes = [len(k) for k in keys]
        chunk = np.repeat(table.column("chunk").to_numpy(), sizes)
        found = decide(chunk, np.concatenate(keys), np.concatenate(values)).astype(np.uint8)
        ends = np.cumsum(sizes).tolist()
        return pa.table({
            "chunk": table.column("chunk"),
            "page": table.column("page"),
            "level": pa.array(np.full(len(sizes), level, dtype=np.int32)),
            "answer": pa.array([found[a:b].tobytes() for a, b in zip([0, *ends], ends)], pa.binary()),
        })

    return pages.groupBy("page").applyInArrow(answer, ANSWER)


def read_answers(table: pa.Table, level: int) -> np.ndarray:
    """Answers of a level, for a chunk's keys in the order of `paged`."""
    rows = [(p, a) for p, lv, a in zip(*(table.column(c).to_pylist() for c in ("page", "level", "answer"))) if lv == level]
    return np.frombuffer(b"".join(a for _, a in sorted(rows)), dtype=np.uint8)
