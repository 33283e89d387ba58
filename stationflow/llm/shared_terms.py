"""Ranked lexical search of many items at once, through term sets that they share.

Items are taken in blocks. Their term sets are put into a prefix tree, the terms that most items have first: a path that several
items go along is a set that they share. What is left of the items goes through another tree, until nothing is shared.
The paths make a graph: a set is another set and some terms more, an item is some sets and the terms it has alone.

Of a document the words the block asks for are counted once. A set's sum is computed once for a document, from the set it
extends, and items add up sets. Every document is scored by every term of every item; each task keeps the best of
each item, and the best of those are the answer.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import shared_folder
from .tokens import Texts, Words, pieces

#: A term is a run of ASCII digits and letters and non-ASCII bytes, A-Z in lower case.
BETWEEN_TERMS = np.ones(256, dtype=bool)
BETWEEN_TERMS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

#: Items, and bytes of their texts, of a block. A longer text is a block alone.
BLOCK_ITEMS, BLOCK_BYTES = 1000, 4 << 20
#: Documents whose sums a task holds at a time, at 8 bytes for each shared set and item.
DOCS = 512


def terms(texts: Texts) -> Words:
    return Words(texts, lower=True, outside=BETWEEN_TERMS)


@dataclass(frozen=True)
class Plan:
    """The graph of a block. Nodes are sets, then items. Term i (hashes[i], ascending) goes into the nodes
    term_to[term_first[i] : term_first[i + 1]]; then, in this order, node a goes into node b for each (a, b) of links."""

    hashes: np.ndarray
    term_first: np.ndarray
    term_to: np.ndarray
    links: list[tuple[int, int]]
    sets: int
    items: int

    def additions(self) -> int:
        """Sums it takes for a document that has every term."""
        return len(self.term_to) + len(self.links)

    def sums(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, docs: int) -> np.ndarray:
        """[item, document]: of values at (document, term), the sum over each item's terms."""
        nodes = np.zeros((self.sets + self.items, docs), dtype=np.int64)
        times = np.diff(self.term_first)[term]
        begin = np.repeat(self.term_first[:-1][term] - (np.cumsum(times) - times), times)
        to = self.term_to[begin + np.arange(int(times.sum()))]
        np.add.at(nodes.reshape(-1), to * docs + np.repeat(doc, times), np.repeat(value, times))
        for a, b in self.links:
            nodes[b] += nodes[a]
        return nodes[self.sets :]


class _Tree:
    """A prefix tree of the paths of items."""

    def __init__(self, paths: list[list[int]]):
        self.above, self.term, self.depth, self.count = [-1], [-1], [0], [0]
        below: dict[tuple[int, int], int] = {}
        self.ways: list[list[int]] = []
        for path in paths:
            now, way = 0, []
            for t in path:
                node = below.setdefault((now, t), len(self.above))
                if node == len(self.above):
                    self.above.append(now)
                    self.term.append(t)
                    self.depth.append(self.depth[now] + 1)
                    self.count.append(0)
                self.count[node] += 1
                way.append(node)
                now = node
            self.ways.append(way)

    def deepest(self, i: int) -> int:
        """The last node of an item's path that another item reaches; 0 if that holds less than two terms."""
        shared = [n for n in self.ways[i] if self.count[n] > 1]
        return shared[-1] if len(shared) > 1 else 0


def mine(items: list[np.ndarray]) -> Plan:
    """Shared sets of items, each an array of distinct term hashes."""
    hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *items]))
    rest = [set(np.searchsorted(hashes, i).tolist()) for i in items]
    adds: list[list[int]] = []
    links: list[tuple[int, int]] = []
    parts: list[list[int]] = [[] for _ in items]
    while True:
        often = Counter(t for r in rest for t in r)
        tree = _Tree([sorted((t for t in r if often[t] > 1), key=lambda t: (-often[t], t)) for r in rest])
        ends = [tree.deepest(i) for i in range(len(items))]
        if not any(ends):
            break
        # Nodes from which paths part, or where an item's shared part ends, close a set; those between add their terms to it.
        used = {n for end in ends if end for n in _up(tree, end)}
        forks = Counter(tree.above[n] for n in used)
        closes = {n for n in used if forks[n] > 1} | {end for end in ends if end}
        set_of: dict[int, int] = {}
        for node in sorted(closes, key=lambda n: tree.depth[n]):
            own, above = [tree.term[node]], tree.above[node]
            while above and above not in closes:
                own.append(tree.term[above])
                above = tree.above[above]
            set_of[node] = len(adds)
            adds.append(own)
            if above:
                links.append((set_of[above], set_of[node]))
        for i, end in enumerate(ends):
            if end:
                parts[i].append(set_of[end])
                rest[i] -= {tree.term[n] for n in _up(tree, end)}
    sets = len(adds)
    links += [(part, sets + i) for i, of_item in enumerate(parts) for part in of_item]
    edges = sorted((t, node) for node, own in enumerate([*adds, *rest]) for t in own)
    first = np.searchsorted(np.array([t for t, _ in edges], dtype=np.int64), np.arange(len(hashes) + 1))
    return Plan(hashes, first, np.array([n for _, n in edges], dtype=np.int64), links, sets, len(items))


def _up(tree: _Tree, node: int) -> Iterator[int]:
    while node:
        yield node
        node = tree.above[node]


def postings(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """Runs of documents (id, text): ids, sizes (terms of each), found (of each, how many of the terms asked for it has),
    terms (their places in hashes) and times (how often each occurs), as arrays."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            words = terms(texts)
            at = np.minimum(np.searchsorted(hashes, words.hash), max(len(hashes) - 1, 0))
            hit = hashes[at] == words.hash if len(hashes) else np.zeros(len(at), dtype=bool)
            both, times = np.unique(words.row[hit] * max(len(hashes), 1) + at[hit], return_counts=True)
            found = np.bincount(both // max(len(hashes), 1), minlength=texts.rows)
            one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
            columns = [one(batch.column("id"), pa.int64()), one(words.count, pa.int64()), one(found, pa.int32()), one(both % max(len(hashes), 1), pa.int32()), one(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "sizes", "found", "terms", "times"])

    return docs.mapInArrow(count, "ids array<long>, sizes array<long>, found array<int>, terms array<int>, times array<long>")


@dataclass(frozen=True)
class Facts:
    """Of a corpus: documents with a term, terms of all documents, and how many documents hold each term that is asked for."""

    documents: int
    length: int
    held_by: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * n + 1))) for n in self.held_by.tolist()], dtype=np.int64)

    def worth(self, times: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of occurrences in documents of so many terms: fixed values of the ranking, all in whole numbers."""
        m = 100 - 90 + (90 * sizes * self.documents) // max(self.length, 1)
        return weight * ((1_000_000_000 * times) // (1000 * times + 8 * m))


def facts(runs: DataFrame, asked: int) -> Facts:
    """One row for each term asked for, and two numbers, go to the driver."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(asked, dtype=np.int64)
        for batch in batches:
            n += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=asked)
        term = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n[term])], names=["term", "n"])

    held_by = np.zeros(asked, dtype=np.int64)
    for term, n in runs.select("terms").mapInArrow(hold, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        held_by[term] = n
    some = F.size(F.filter("sizes", lambda n: n > 0))
    terms = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)
    documents, length = runs.agg(F.coalesce(F.sum(some), F.lit(0)), F.coalesce(F.sum(terms), F.lit(0))).first()
    return Facts(documents, length, held_by)


class Best:
    """The best documents of each item so far: of highest score, then of least id; a null id comes last."""

    def __init__(self, items: int, most: int):
        self.items, self.most = items, most
        self.item, self.score, self.id, self.null = (np.zeros(0, dtype=np.int64) for _ in range(4))
        self.least = np.ones(items, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        item, score, name, null = (np.concatenate(x) for x in ((self.item, item), (self.score, scores[item, doc]), (self.id, ids[doc]), (self.null, null[doc])))
        order = np.lexsort((name, null, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = order[place < self.most]
        self.item, self.score, self.id, self.null = item[kept], score[kept], name[kept], null[kept]
        # An item that has all it needs takes no document below its last.
        last = np.flatnonzero(place == self.most - 1)
        self.least[item[order[last]]] = score[order[last]]

    def rows(self) -> pa.RecordBatch:
        ids = pa.array(self.id, mask=self.null.astype(bool))
        return pa.RecordBatch.from_arrays([pa.array(self.item), ids, pa.array(self.score)], names=["item", "id", "score"])


def ranked(runs: DataFrame, plan: Plan, facts: Facts, most: int) -> DataFrame:
    """(item, id, score): of each item its best documents of each task."""
    weights = facts.weights()

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(plan.items, most)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, sizes, found, term, times = (batch.column(c)[i].values for c in ("ids", "sizes", "found", "terms", "times"))
                null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ids.fill_null(0).to_numpy()
                sizes, found, term, times = (x.to_numpy() for x in (sizes, found, term, times))
                first = np.concatenate(([0], np.cumsum(found, dtype=np.int64)))
                for a in range(0, len(ids), DOCS):
                    b = min(a + DOCS, len(ids))
                    part = slice(first[a], first[b])
                    doc = np.repeat(np.arange(b - a), found[a:b])
                    value = facts.worth(times[part], sizes[a:b][doc], weights[term[part]])
                    best.add(plan.sums(doc, term[part].astype(np.int64), value, b - a), ids[a:b], null[a:b])
        yield best.rows()

    return runs.mapInArrow(rank, "item long, id long, score long")


def search(docs: DataFrame, items: DataFrame, most: int = 10, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, key, score): the `most` highest-scoring documents of every row of items, of all rows of docs.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case; a null text has none. Scores are those
    of `Facts`, summed over an item's distinct terms, and above 0. Equal scores stand by ascending key, a null one last. Rows
    with a null or repeated key are documents of their own; items with a null or repeated id are items of their own, and
    equal rows of items get the same answers each. Keys are whole numbers. Terms are compared by 64-bit hashes.

    Each block of items goes over all documents once. Its items, and how many documents hold each of its terms, go to the driver.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/search-{uuid.uuid4().hex}"
    asked = items.groupBy(F.col(item).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    asked.write.parquet(f"{folder}/items")
    asked = spark.read.schema(asked.schema).parquet(f"{folder}/items")
    rows, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-rows // block_items), -(-size // block_bytes))
    of_block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    kind = items.schema[item].dataType
    answer = T.StructType([T.StructField("block", T.LongType()), T.StructField("item", T.LongType()), T.StructField("id", T.LongType()), T.StructField("score", T.LongType())])
    named = T.StructType([T.StructField("block", T.LongType()), T.StructField("item", T.LongType()), T.StructField("name", kind), T.StructField("copies", T.LongType())])
    spark.createDataFrame([], answer).write.parquet(f"{folder}/best")
    spark.createDataFrame([], named).write.parquet(f"{folder}/names")
    for block in range(blocks):
        mine_of = asked.filter(of_block == block).collect()
        if not mine_of:
            continue
        names = [(block, i, r["item"], r["copies"]) for i, r in enumerate(mine_of)]
        spark.createDataFrame(names, named).write.mode("append").parquet(f"{folder}/names")
        words = terms(Texts(pa.array([r["text"] for r in mine_of], pa.large_string())))
        plan = mine([np.unique(words.hash[a:b]) for a, b in zip(words.first[:-1], words.first[1:])])
        path = f"{folder}/postings-{block}"
        postings(texts, plan.hashes).write.parquet(path)
        runs = spark.read.parquet(path)
        best = ranked(runs, plan, facts(runs, len(plan.hashes)), most)
        best.select(F.lit(block).cast("long").alias("block"), "item", "id", "score").write.mode("append").parquet(f"{folder}/best")
    order = Window.partitionBy("block", "item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = spark.read.schema(answer).parquet(f"{folder}/best").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    out = best.join(spark.read.schema(named).parquet(f"{folder}/names"), ["block", "item"])
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(F.col("name").alias(item), F.col("rank").cast("int").alias("rank"), F.col("id").cast(docs.schema[key].dataType).alias(key), "score")
