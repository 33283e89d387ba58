"""The joins and removals of duplicates against brute force, at several chunk sizes and list limits."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from cases import SCHEMA, bytes_left, corpus, frame, jaccard_components, words_left
from pyspark.sql import functions as F

from stationflow.llm import components, level_windows, repeat_bytes, set_join
from stationflow.llm.shared import BATCH
from stationflow.llm.tokens import anchors, least, window_hashes


@pytest.mark.parametrize(("length", "first", "chunk_bytes"), [(20, 10, 1 << 22), (20, 10, 3000), (20, 5, 3000), (8, 2, 5000)])
def test_word_windows(spark, length, first, chunk_bytes):
    rows = corpus(1)
    got = level_windows.remove_repeats(frame(spark, rows), length=length, first=first, chunk_bytes=chunk_bytes).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in got} == words_left(rows, length)
    assert len(got) == len(rows)


def test_word_windows_of_no_power(spark):
    with pytest.raises(ValueError):
        level_windows.remove_repeats(frame(spark, corpus(1, 3)), length=20, first=7)


@pytest.mark.parametrize(("most", "chunk_bytes"), [(4096, 1 << 22), (4096, 3000), (1, 3000), (3, 3000)])
def test_bytes(spark, most, chunk_bytes):
    rows = corpus(2)
    got = repeat_bytes.remove_repeats(frame(spark, rows), length=200, most=most, chunk_bytes=chunk_bytes).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["starts"]), bytes(r["kept"])) for r in got} == bytes_left(rows, 200)


def test_bytes_with_a_short_gram(spark):
    rows = corpus(3, 30, long=False)
    got = repeat_bytes.remove_repeats(frame(spark, rows), length=40, gram=9, chunk_bytes=4000).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["starts"]), bytes(r["kept"])) for r in got} == bytes_left(rows, 40)


def test_bytes_as_text_drop_cut_characters(spark):
    rows = [(1, "é" * 150 + "tail"), (2, "xé" + "é" * 150), (3, "clean")]
    got = {r["doc_id"]: r for r in repeat_bytes.remove_repeats(frame(spark, rows), length=201, as_text=True, carry=["source"]).collect()}
    assert got[3]["kept"] == "clean" and got[3]["source"] == "s0"
    assert "�" not in got[1]["kept"] + got[2]["kept"]


def test_bytes_of_a_repeated_row(spark):
    got = repeat_bytes.remove_repeats(frame(spark, [(1, "q" * 10 + "ab" * 200), (1, "q" * 10 + "ab" * 200)]), length=200).collect()
    assert [(r["n_removed"], bytes(r["kept"])) for r in got] == [(410, b"")] * 2


def test_intervals_are_all_shared_prefixes():
    suffixes = sorted(["aab", "aabc", "ab", "b", "ba", "ba", "cab"])
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    lcp = [0, *(shared(a, b) for a, b in zip(suffixes, suffixes[1:]))]
    want = set()
    for i in range(len(suffixes)):
        for j in range(i + 1, len(suffixes)):
            low = min(lcp[i + 1 : j + 1])
            if low and (i == 0 or lcp[i] < low) and (j + 1 == len(suffixes) or lcp[j + 1] < low):
                want.add((low, i, j))
    assert set(repeat_bytes.intervals(lcp, 1)) == want


def test_equal_windows_choose_equal_anchors():
    rng = np.random.default_rng(5)
    units = rng.integers(0, 3, 4000).astype(np.uint64)
    row = np.repeat(np.arange(8), 500)
    hashes = window_hashes(units, 4)
    chosen, low, high = anchors(hashes, row, 9, 12)
    at = {s: c - s for c, a, b in zip(chosen, low, high) for s in range(a, b + 1)}
    by_window = {}
    for s, place in at.items():
        by_window.setdefault(tuple(units[s : s + 12]), set()).add(int(place))
    assert all(len(p) == 1 for p in by_window.values())
    assert len(at) == 8 * (500 - 11)
    assert (least(hashes, 9) == [hashes[i : i + 9].min() for i in range(len(hashes) - 8)]).all()


@pytest.mark.parametrize(("shingle", "percent", "most", "chunk_bytes"), [(3, 90, 256, 1 << 22), (3, 90, 256, 3000), (3, 90, 1, 3000), (2, 60, 2, 3000), (5, 80, 1, 1 << 22)])
def test_jaccard(spark, shingle, percent, most, chunk_bytes):
    rows = corpus(4, 80)
    got = set_join.join_sets(frame(spark, rows), shingle=shingle, percent=percent, most=most, chunk_bytes=chunk_bytes).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_components(rows, shingle, percent)


def test_jaccard_of_a_large_group_of_near_copies(spark):
    """Chains of edits: many aren't linked to the least document, but to others."""
    import random

    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows, parts = [], list(base)
    for d in range(60):
        rows.append((d, " ".join(parts)))
        parts = list(parts) if d % 7 else list(base)
        parts[rng.randrange(120)] = f"n{d}"
    rows += [(1000 + i, " ".join(base[:40]) + f" z{i} " + " ".join(f"y{i}_{j}" for j in range(30))) for i in range(20)]
    for most in (2, 8, 256):
        got = set_join.join_sets(frame(spark, rows), most=most, chunk_bytes=9000).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_components(rows, 3, 90)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (102, 101)]
    links += [(b, a) for a, b in links]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_edges_of_tables(spark):
    """Empty tables, null ids, repeated rows, and columns that bear the operators' inner names."""
    empty = spark.createDataFrame([], SCHEMA)
    assert level_windows.remove_repeats(empty).count() == repeat_bytes.remove_repeats(empty).count() == set_join.join_sets(empty).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (None, text), (2, None)]
    odd = spark.createDataFrame([(d, t, 7, "k", "c", 3) for d, t in rows], "doc_id long, text string, chunk int, key string, n_removed string, page int")
    left = sorted(level_windows.remove_repeats(odd).select("doc_id", "n_removed").collect(), key=str)
    assert left == sorted([(1, 40), (1, 40), (None, 0), (2, 0)], key=str)
    joined = sorted(set_join.join_sets(odd).collect(), key=str)
    assert joined == sorted([(1, 38, 1), (1, 38, 1), (None, 38, None), (2, 0, 2)], key=str)
    assert sorted(r["n_removed"] for r in repeat_bytes.remove_repeats(odd, length=20, gram=8).collect()) == [0, *[len(text)] * 3]


def _letters(seed):
    import random

    return random.Random(seed).sample([f"w{i}" for i in range(900)], 80)


def _changed(parts, at):
    return " ".join([*parts[:at], "other", *parts[at + 1 :]])


def test_jaccard_under_repeated_and_null_ids(spark):
    """Rows of one id are one document, reached by any of its texts; rows without an id connect others."""
    a, b, c = _letters(1), _letters(2), _letters(3)
    rows = [(5, " ".join(a)), (5, " ".join(b)), (9, _changed(a, 79)), (12, _changed(b, 79)), (1, _changed(b, 0))]
    rows += [(None, _changed(a, 0)), (None, " ".join(c)), (None, _changed(c, 79)), (20, "alone " * 3), (20, ""), (None, None)]
    got = sorted(map(tuple, set_join.join_sets(frame(spark, rows), chunk_bytes=700).collect()), key=str)
    want = [(5, 78, 1), (5, 78, 1), (9, 78, 1), (12, 78, 1), (1, 78, 1), (None, 78, None), (None, 78, None), (None, 78, None), (20, 1, 20), (20, 0, 20), (None, 0, None)]
    assert got == sorted(want, key=str)

    kept = sorted(map(tuple, set_join.first_of_each(frame(spark, rows), shingle=3, percent=90, chunk_bytes=700).select("doc_id", "text").collect()), key=str)
    assert [r for r in kept if r[0] is not None] == sorted([(5, " ".join(a)), (1, _changed(b, 0)), (20, "alone " * 3), (20, "")], key=str)
    assert len(kept) == 6 and sum(d is None and t is not None for d, t in kept) == 1


def test_jaccard_where_a_third_of_all_rows_are_equal(spark):
    """However many equal rows without an id, a chunk gets one a task, and no row is lost."""
    a = _letters(4)
    rows = [(None, " ".join(a))] * 300 + [(i, f"{i} " + " ".join(_letters(100 + i))) for i in range(60)] + [(77, _changed(a, 79))]
    got = set_join.join_sets(frame(spark, rows), chunk_bytes=3000).collect()
    assert len(got) == 361 and sorted(r["component_id"] for r in got if r["doc_id"] is not None) == [*range(60), 77]
    odd = frame(spark, rows).withColumnRenamed("lang", "chunk").withColumnRenamed("source", "name")
    kept = set_join.first_of_each(odd, shingle=3, percent=90, chunk_bytes=3000)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [*range(60), 77]
    sent = list(set_join._once(iter([pa.RecordBatch.from_pydict({"chunk": [1, 1, 2], "name": [7, 7, 7]})] * 2), "chunk", "name"))
    assert [b.num_rows for b in sent] == [2, 0]


@pytest.mark.parametrize("room", [1, 4000])
def test_jaccard_in_small_rooms(spark, monkeypatch, room):
    monkeypatch.setattr(set_join, "ROOM_BYTES", room)
    rows = corpus(6, 80)
    got = set_join.join_sets(frame(spark, rows), shingle=2, percent=60, chunk_bytes=9000).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_components(rows, 2, 60)


def test_jaccard_where_sets_and_texts_meet_by_hash(spark, monkeypatch):
    monkeypatch.setattr(set_join, "FEW_KEYS", 0)
    rows = corpus(7, 60)
    got = set_join.join_sets(frame(spark, rows), shingle=5, percent=80, chunk_bytes=9000).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_components(rows, 5, 80)


def test_jaccard_rows_grow_with_sets_and_not_with_pairs(spark, monkeypatch):
    """Sets of a group that are candidates of each other, many of them not linked: no step has a row for each pair, nor a set for each chunk."""
    import random

    def steps(size):
        rng, rows = random.Random(3), []
        for d in range(size):
            parts = [f"w{i}" for i in range(120)]
            for at in rng.sample(range(120), 1 + d % 9):
                parts[at] = f"n{d}_{at}"
            rows.append((d, " ".join(parts)))
        counts = []

        def counted(df, saved=set_join.saved):
            out = saved(df)
            if "list" not in out.columns:
                counts.append(out.count())
            return out

        with monkeypatch.context() as m:
            m.setattr(set_join, "saved", counted)
            got = set_join.join_sets(frame(spark, rows), shingle=3, percent=80, chunk_bytes=9000).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == jaccard_components(rows, 3, 80)
        return max(counts)

    assert steps(60) <= 3 * 60 and steps(120) <= 3 * 120


def test_jaccard_hands_texts_to_python_in_small_batches(spark, monkeypatch):
    spark.conf.unset(BATCH)
    sizes, save = [], set_join.saved

    def watched(df):
        rows = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 4000) AS text")
        sizes.append(rows.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").agg(F.max("n")).first()[0])
        return save(df)

    monkeypatch.setattr(set_join, "saved", watched)
    out = set_join.first_of_each(frame(spark, corpus(12, 30)))
    assert sizes and max(sizes) < 3 << 20
    assert spark.conf.get(BATCH, None) is None
    out.count()


def test_components_of_a_chain_are_planned_in_bounded_time(spark):
    """Sizes that the planner works with stay those of the tables, however many rounds there were."""
    found = components.components(spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long"))
    assert found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64 and found.filter("component <> 0").isEmpty()
