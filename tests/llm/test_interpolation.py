"""The interpolated language model against one that counts with dictionaries."""

from __future__ import annotations

import math
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import WORD, corpus, frame

from pyspark.sql import functions as F

from stationflow.llm import interpolation
from stationflow.llm.tokens import window_hashes

LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


class Naive:
    """Counts of the training texts, and of those that don't learn; weights by the same rounds."""

    def __init__(self, texts, order):
        self.order, self.all, self.kept = order, Counter(), Counter()
        for role, text in texts:
            for gram in self.grams(text):
                self.all[gram] += role > 0
                self.kept[gram] += role == 1
        learn = [text for role, text in texts if role == 2]
        self.weight, self.known = defaultdict(lambda: 0.5), sum(len(g) == 1 and n > 0 for g, n in self.all.items())
        for _ in range(12):
            made, could = Counter(), Counter()
            for text in learn:
                for levels in self.steps(text, self.kept):
                    reach = 1.0
                    for k in range(order, 0, -1):
                        bucket, part, p = levels[k]
                        if bucket is not None:
                            made[k, bucket] += reach * part / p
                            could[k, bucket] += reach
                        reach -= reach * part / p
            new = {b: min(max(round((made[b] + 0.5) / (could[b] + 1), 6), 1e-6), 1 - 1e-6) for b in could}
            moved = max((abs(w - self.weight[b]) for b, w in new.items()), default=0)
            self.weight.update(new)
            if moved < 1e-3:
                break

    def grams(self, text):
        padded = ["<"] * (self.order - 1) + tokens(text)
        return [tuple(padded[i - k + 1 : i + 1]) for i in range(self.order - 1, len(padded)) for k in range(1, self.order + 1)]

    def context(self, gram, counts):
        """How often the words ahead of a gram's last are followed by any."""
        if len(gram) == 1:
            return sum(n for g, n in counts.items() if len(g) == 1)
        if all(w == "<" for w in gram[:-1]):
            return counts["\n",]
        return counts[gram[:-1]]

    def steps(self, text, counts):
        grams = self.grams(text)
        for i in range(0, len(grams), self.order):
            levels, p = [None], 1 / (self.known + 1)
            for gram in grams[i : i + self.order]:
                context = self.context(gram, counts)
                bucket = context.bit_length() - 1 if context else None
                weight = self.weight[len(gram), bucket] if context else 0
                part = weight * counts[gram] / max(context, 1)
                p = part + (1 - weight) * p
                levels.append((bucket, part, p))
            yield levels

    def score(self, text):
        return sum(math.log10(levels[-1][2]) for levels in self.steps(text, self.all))

    def base(self, text):
        n = sum(c for g, c in self.all.items() if len(g) == 1)
        return sum(math.log10((self.all[(t,)] + 0.5) / (n + 0.5 * (self.known + 1))) for t in tokens(text))


def check(spark, rows, order, training="doc_id % 5 <> 1", **options):
    docs = frame(spark, rows)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    learns = {r[0] for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("l")).collect() if r[1]}
    trains = {r[0] for r in docs.filter(training).collect()}
    texts = [((2 if d in learns else 1) if d in trains else 0, t) for d, t in rows]
    naive = Naive(texts, order)
    got = interpolation.score(docs, F.expr(training), order=order, deleted=3, **options).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in rows)
    n = sum(len(tokens(t)) for role, t in texts if role)
    by_row = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got)
    assert by_row == Counter((d, len(tokens(t)), sum(naive.all[(w,)] > 0 for w in tokens(t)), n) for d, t in rows)
    for found, want in (("base_score", naive.base), ("score", naive.score)):
        have = sorted((str(r.doc_id), r[found]) for r in got)
        expected = sorted((str(d), want(t)) for d, t in rows)
        assert [d for d, _ in have] == [d for d, _ in expected]
        np.testing.assert_allclose([x for _, x in have], [x for _, x in expected], rtol=1e-5, atol=1e-9)
    return naive, got


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_in_small_chunks(spark, order):
    rows = corpus(order, n=30, long=False)
    check(spark, rows, order, chunk_bytes=2000, page_bytes=3000)


def test_one_chunk_and_a_long_text(spark):
    check(spark, corpus(7, n=20), 3)


def test_probabilities_add_up_to_one(spark):
    naive, _ = check(spark, corpus(9, n=20, long=False), 3)
    words = [g[0] for g, n in naive.all.items() if len(g) == 1 and n]
    some = next(g for g in naive.all if len(g) == 3 and naive.all[g] > 1 and "<" not in g)
    for context in (some[:2], ("<", "<"), ("nowhere", some[1]), ("nowhere", "at all")):
        total = 0.0
        for w in [*words, "a word nobody knows"]:
            p = 1 / (naive.known + 1)
            for gram in ((w,), (context[1], w), (*context, w)):
                seen = naive.context(gram, naive.all)
                weight = naive.weight[len(gram), seen.bit_length() - 1] if seen else 0
                p = weight * naive.all[gram] / max(seen, 1) + (1 - weight) * p
            total += p
        assert total == pytest.approx(1)


def test_the_model_knows_more_than_single_words(spark):
    """Learned weights beat the start's, and the mixture beats single counts, on texts the model hasn't seen."""
    rows = [(i, " ".join(["the cat sat on the mat", "a dog ran to the house", "the cat ran to a mat"][(i + j) % 3] for j in range(4 + i % 3))) for i in range(60)]
    naive, got = check(spark, rows, 3)
    unseen = [r for r in got if r.doc_id % 5 == 1]
    assert sum(r.score for r in unseen) > 0.5 * sum(r.base_score for r in unseen)
    learned = sum(naive.score(t) for d, t in rows if d % 5 == 1)
    naive.weight = defaultdict(lambda: 0.5)
    assert learned > sum(naive.score(t) for d, t in rows if d % 5 == 1)


def test_a_gram_alone_in_its_chunk_is_not_listed():
    """Of texts that share no two words in a row with other chunks, no third order is listed; and all of it if they do."""
    texts = [f"a{i} common b{i}" for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"key": [*range(40)], "text": texts, "role": [1] * 40, "chunk": [0] * 40})
    table = pa.Table.from_batches(interpolation.packed(iter([batch])))
    grams = interpolation.Grams(table, 3)
    found = {k: grams.distinct(k) for k in (1, 2, 3)}
    found[1].alone[:] = False
    assert not interpolation._shared(grams, found, 3).any()
    found[2].alone[:] = False
    assert interpolation._shared(grams, found, 3).all()
    one = found[2].inverse[grams.first[5] + 1]  # "a5 common" is in no other chunk
    found[2].alone[one] = True
    assert (~interpolation._shared(grams, found, 3)).sum() == 2


def test_null_repeated_empty_and_extra(spark):
    rows = [(None, "a b c"), (None, "a b c"), (None, None), (4, "a b"), (4, "b a"), (4, "b a"), (6, ""), (8, "x y z " * 500), (11, "a b c"), (11, "q")]
    check(spark, rows, 3, training="doc_id is null or doc_id <> 11")
    docs = frame(spark, rows).withColumn("role", F.lit("x")).withColumn("chunk", F.lit(1)).withColumn("key", F.lit(2)).withColumn("tokens", F.lit(3))
    assert interpolation.score(docs, F.lit(True)).count() == len(rows)


def test_nothing_to_learn_from(spark):
    """No training texts: all scores are 0, of an event that is certain. A null condition trains nothing."""
    docs = frame(spark, [(1, "a b"), (2, None)])
    for condition in (F.lit(False), F.lit(None).cast("boolean")):
        got = interpolation.score(docs, condition).collect()
        assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert interpolation.score(docs.limit(0), F.lit(True)).collect() == []


def test_equal_rows_are_dealt_to_many_chunks(spark):
    """A third of all rows equal: their chunks stay small, and so do their answers' costs."""
    rows = [(None, "same words in every row")] * 400 + [(i, f"row {i}") for i in range(100)]
    blocks = interpolation.counted(frame(spark, rows), F.lit(True), chunk_bytes=500).collect()
    assert sum(len(b["keys"]) for b in blocks) == 500 and max(len(b["keys"]) for b in blocks) < 60
    ends = [interpolation.unpack(b["counts"][0]).max() for b in blocks if b.counts]
    assert set(ends) == {500}  # the end, in all rows


def test_packed_numbers():
    for numbers in ([], [0], [1, 255, 256], [2**40, 3], [2**63 - 1]):
        for raw in (False, True):
            assert interpolation.unpack(interpolation.pack(np.array(numbers, dtype=np.int64), raw)).tolist() == numbers


def test_keys_in_order_are_those_of_a_stable_sort():
    """Also of keys as wide as a word, whose lowest bits find no room beside the places, and differ in those alone."""
    rng = np.random.default_rng(3)
    top = np.uint64(2**64 - 1)
    cases = [np.zeros(0, np.uint64), np.array([7], np.uint64), np.array([top, 0, top, 5], np.uint64), np.zeros(9, np.uint64)]
    cases += [rng.integers(0, 2**bits, 5000, dtype=np.uint64) for bits in (3, 40, 51, 52, 63)]
    cases += [top - rng.integers(0, 50, 5000, dtype=np.uint64), rng.integers(0, 4, 5000, dtype=np.uint64) << np.uint64(62) | rng.integers(0, 3000, 5000, dtype=np.uint64)]
    for keys in cases:
        found, order = interpolation.ascending(keys)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist() and found.tolist() == keys[order].tolist()
        names, inverse, order, begin = interpolation.grouped(keys)
        expected, expected_inverse = np.unique(keys, return_inverse=True)
        assert names.tolist() == expected.tolist() and inverse.tolist() == expected_inverse.tolist()
        assert keys[order][begin].tolist() == names.tolist()
        assert interpolation.sums_from(order, begin).tolist() == np.bincount(inverse, weights=np.arange(len(keys)), minlength=len(names)).tolist()


def test_a_chunk_hashes_the_orders_it_lists_as_windows_of_words():
    values = interpolation.mixed(np.arange(50, dtype=np.uint64))
    for k in (1, 2, 3, 5, 50, 51):
        assert interpolation.short_hashes(values, k).tolist() == window_hashes(values, k).tolist()
    batch = pa.RecordBatch.from_pydict({"key": [1, 2], "text": ["a b c d", ""], "role": [1, 0], "chunk": [0, 0]})
    table = pa.Table.from_batches(interpolation.packed(iter([batch])))
    some, every = interpolation.Grams(table, 3, orders=[2, 3]), interpolation.Grams(table, 3)
    assert [len(g) for g in some.gram[1:]] == [0, 6, 6] and [len(g) for g in every.gram[1:]] == [6, 6, 6]
    assert [g.tolist() for g in some.gram[2:]] == [g.tolist() for g in every.gram[2:]]


def test_grams_of_a_chunk_are_told_apart_sooner_than_by_sorting_places():
    """Most of the query's time was np.unique with its inverse, which sorts places."""
    grams = interpolation.Grams.__new__(interpolation.Grams)
    grams.gram = [interpolation.mixed(np.random.default_rng(5).integers(0, 300_000, 1_000_000, dtype=np.uint64)) >> np.uint64(8)]
    grams.role = np.ones(1_000_000, dtype=np.int8)

    def least_seconds(work):
        spent = []
        for _ in range(5):
            begin = time.process_time()
            work()
            spent.append(time.process_time() - begin)
        return min(spent)

    assert least_seconds(lambda: grams.distinct(0)) < 0.75 * least_seconds(lambda: np.unique(grams.gram[0], return_inverse=True))
