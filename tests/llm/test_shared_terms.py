"""Ranked search against scores of all documents, one by one."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, frame

from pyspark.sql import functions as F

from stationflow.llm import shared_terms
from stationflow.llm.tokens import Texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def best(rows, items, most=10):
    """Rows (item_id, rank, doc_id, score)."""
    docs = [(d, Counter(terms(t))) for d, t in rows]
    sizes = [sum(c.values()) for _, c in docs]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    held = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for (d, c), size in zip(docs, sizes):
            m = 100 - 90 + (90 * size * n) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (*x[:2], x[2] or 0))[:most])]
    return Counter(out)


def queries(rows, seed, n=25):
    """Items made of parts of documents, of each other, and of nothing."""
    rng = random.Random(seed)
    parts = [t.split() for _, t in rows if t and len(t.split()) > 8]
    shared = [rng.choice(parts)[:k] for k in (6, 4, 8)]
    out = [(i, " ".join([*rng.choice(shared), *rng.choice(shared)[:3], *rng.sample(rng.choice(parts), 5)])) for i in range(n)]
    return [*out, (100, None), (101, ""), (102, "... !"), (103, "nowhere"), (104, out[0][1]), (105, rng.choice(parts)[0])]


def found(spark, rows, items, docs=None, **options):
    asked = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in shared_terms.search(docs if docs is not None else frame(spark, rows), asked, **options).collect())


@pytest.mark.parametrize("seed", range(2))
def test_ranks_of_all_documents(spark, seed):
    rows = corpus(seed, n=80)
    items = queries(rows, seed)
    assert found(spark, rows, items) == best(rows, items)
    assert found(spark, rows, items, most=3, block_items=7, block_bytes=900) == best(rows, items, 3)


def test_ties_nulls_and_repeats(spark):
    """Equal scores stand by id, a null one last. Rows that repeat are documents and items each."""
    rows = [(5, "a b"), (3, "a b"), (None, "a b"), (9, "a b"), (9, "a b"), (1, None), (2, ""), (-4, "c c c A"), (8, "x" * 9000 + " b")]
    items = [(1, "a"), (1, "b"), (2, "A a, a"), (2, "A a, a"), (None, "c"), (7, None)]
    assert found(spark, rows, items, most=4) == best(rows, items, 4)
    assert [r[2] for r in sorted(found(spark, rows, [(1, "b")]), key=lambda r: r[1])][-1] is None


def test_empty_tables_and_other_columns(spark):
    rows, items = corpus(4, n=10, long=False), [(1, "a ab"), (2, "ß")]
    docs = frame(spark, rows)
    assert found(spark, rows, items, docs.limit(0)) == Counter() and found(spark, rows, []) == Counter()
    more = docs.withColumns({"item_id": F.lit(3), "score": F.lit(4), "rank": F.lit(5), "id": F.lit("x")})
    asked = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, doc_id int, copies int")
    assert Counter(tuple(r) for r in shared_terms.search(more, asked).collect()) == best(rows, items)


def plan_of(texts):
    words = shared_terms.terms(Texts(pa.array(texts, pa.large_string())))
    items = [np.unique(words.hash[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
    return items, shared_terms.mine(items)


def test_shared_sets_are_summed_once():
    texts = [f"the of and to in {x}" for x in ("a", "b", "c", "d")] + ["the of and q r s", "the of", "q r s", "z"]
    items, plan = plan_of(texts)
    flat = sum(map(len, items))
    assert plan.sets >= 3 and plan.additions() < 0.75 * flat
    # A set that several others extend takes each of its terms once, and no other sums them anew.
    common = np.searchsorted(plan.hashes, shared_terms.terms(Texts(pa.array(["the of"], pa.large_string()))).hash)
    assert all(plan.term_first[t + 1] - plan.term_first[t] == 1 for t in common)
    assert all(a < plan.sets and a < b for a, b in plan.links)


@pytest.mark.parametrize("seed", range(3))
def test_sums_along_the_graph(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"t{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, size=rng.integers(0, 30), p=np.arange(60, 0, -1) / 1830)) for _ in range(40)]
    items, plan = plan_of([*texts, texts[3], ""])
    doc, term = np.nonzero(rng.random((7, len(plan.hashes))) < 0.5)
    value = rng.integers(1, 10**15, len(doc))
    got = plan.sums(doc, term, value, 7)
    for i, item in enumerate(items):
        mine = np.isin(plan.hashes[term], item)
        want = np.zeros(7, dtype=np.int64)
        np.add.at(want, doc[mine], value[mine])
        assert got[i].tolist() == want.tolist()
    assert plan.additions() < sum(map(len, items))
