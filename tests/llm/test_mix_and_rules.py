"""Mixing, quality rules and the pipeline's stages against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import SCHEMA, bytes_left, corpus, frame, jaccard_components, words

import corpus_pipeline
from stationflow.llm import curriculum, decision_list
from stationflow.llm.queries import SCHEDULES
from stationflow.llm.shared import saved


def filled(sizes, weights, cap=3.0):
    """Targets by weight; what is above the cap is shared anew until nothing is."""
    left, full = float(sum(sizes)), {}
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        if not open_:
            return [full[i] for i in range(len(sizes))]
        rest = left - sum(full.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > cap * sizes[i]]
        if not over:
            return [full.get(i, share.get(i)) for i in range(len(sizes))]
        full |= {i: cap * sizes[i] for i in over}


def mix_rows():
    rng = random.Random(4)
    rows = []
    for source, n in (("b", 200), ("a", 40), ("Z", 3), (None, 30), ("é", 9), ("zero", 2)):
        for _ in range(n):
            k = 0 if source == "zero" else rng.randint(0, 80)
            rows.append((len(rows), " ".join(["w"] * k) if k or rng.random() < 0.5 else None, "en", source, 1))
    return rows


def test_mix_meets_targets(spark):
    rows = mix_rows()
    got = curriculum.mix(spark.createDataFrame(rows, SCHEMA), SCHEDULES, slices=4).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for d, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    want = dict(zip(order, filled([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))])))
    taken, longest = Counter(), Counter()
    for r in got:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in {k * r["size"] for k in range(4)}
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in order:
        assert abs(taken[s] - want[s]) <= longest[s]
    again = curriculum.mix(spark.createDataFrame(rows, SCHEMA).repartition(5), SCHEDULES, slices=64).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
    positions = [r["position"] for r in got if r["position"] is not None]
    assert positions == sorted(positions) and 0 <= positions[0] <= positions[-1] <= 1


@pytest.mark.parametrize("schedule", [*SCHEDULES, [(0, 0), (0.5, 2), (1, 0)], [(0, 0), (0.3, 0), (1, 5)], [(0, 3), (0.4, 0), (0.6, 0), (1, 1)]])
def test_time_inverts_the_integral(spark, schedule):
    parts = [i / 50 for i in range(51)]
    rows = spark.createDataFrame([(p,) for p in parts], "p double")
    times = [r[0] for r in rows.select(curriculum.time_of(rows["p"], schedule)).collect()]
    grid = np.linspace(0, 1, 20001)
    density = np.interp(grid, [t for t, _ in schedule], [w for _, w in schedule])
    area = np.concatenate(([0], np.cumsum((density[1:] + density[:-1]) / 2)))
    for p, t in zip(parts, times):
        assert np.interp(t, grid, area / area[-1]) == pytest.approx(p, abs=1e-3)
    assert times == sorted(times)


def test_takes_spread_by_schedule(spark):
    rows = [(i, "w " * 10, "en", s, 1) for i, s in enumerate(["a", "b", "c"] * 60)]
    mixed = saved(curriculum.mix(spark.createDataFrame(rows, SCHEMA), SCHEDULES))
    takes = curriculum.takes(mixed, SCHEDULES).collect()
    assert Counter(r["doc_id"] for r in takes) == {r["doc_id"]: r["repeats"] for r in mixed.collect() if r["repeats"]}
    early = Counter(r["source"] for r in takes if r["position"] < 0.5)
    late = Counter(r["source"] for r in takes if r["position"] >= 0.5)
    assert early["a"] > late["a"] and abs(early["b"] - late["b"]) <= 3 and early["c"] < late["c"]


def test_mixed_rows_keep_their_own_repeats(spark, tmp_path):
    """Rows of a null id and of a repeated id, in several sources: each source meets its target, each text has repeats of its own."""
    rng = random.Random(6)
    rows = [(d, f"t{i} " + "w " * rng.randint(0, 30), "en", s, i) for i, (d, s) in enumerate([*[(None, s) for s in "abc"] * 40, *[(7, s) for s in "abc"] * 30, *[(100 + i, s) for i, s in enumerate("abc" * 10)]])]
    sizes = {s: sum(len(words(r[1])) for r in rows if r[3] == s) for s in "abc"}
    want = dict(zip("abc", filled([sizes[s] for s in "abc"], [1, 2, 3])))
    got = corpus_pipeline.mixed_sources(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert {tuple(r) for r in got} <= set(rows)
    copies, taken = Counter(r["n_chars"] for r in got), Counter()
    for r in got:
        taken[r["source"]] += len(words(r["text"]))
    for s in "abc":
        assert abs(taken[s] - want[s]) <= 31
        rounds = int(want[s] // sizes[s])
        assert {copies[r[4]] for r in rows if r[3] == s} <= {rounds, rounds + 1}
    again = corpus_pipeline.mixed_sources(spark, spark.createDataFrame(rows[::-1], SCHEMA).repartition(5), str(tmp_path)).collect()
    assert Counter(r["n_chars"] for r in again) == copies


def test_mix_of_nothing_and_of_bad_schedules(spark):
    assert curriculum.mix(spark.createDataFrame([], SCHEMA), SCHEDULES).count() == 0
    for bad in ([(0, 1)], [(0, 1), (0.5, 1)], [(0, 0), (1, 0)], [(0, -1), (1, 2)]):
        with pytest.raises(ValueError):
            curriculum.mix(spark.createDataFrame([], SCHEMA), [bad])


def counts_of(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))


def test_statistics_by_brute_force(spark):
    rows = [*corpus(6), (999, "a#b <x> | $5 %\n\n same line\n same line\nsame line\r\n"), (998, "\n" * 50 + "x")]
    got = decision_list.statistics(frame(spark, rows).withColumnRenamed("n_chars", "n_words")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r["doc_id"]: tuple(r[c] for c in names) for r in got} == {d: counts_of(t) for d, t in rows}


def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for d in range(400):
        bad = d % 4 == 0
        w = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(30, 90))]
        docs.append((d, " ".join(x + ("%%%" if bad and rng.random() < 0.7 else "") for x in w)))
        labels.append((d, 0 if bad else 1, 0))
    return frame(spark, docs), spark.createDataFrame([*labels, (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")


def test_rules_are_learned_and_applied(spark):
    docs, labels = labelled(spark)
    rules = decision_list.fit(docs, labels)
    assert 1 <= len(rules.rules) <= 3
    got = {r["doc_id"]: r for r in decision_list.judge(docs, rules).collect()}
    assert sum(got[d]["kept"] == (d % 4 != 0) for d in got) >= 395
    assert str(decision_list.fit(docs.repartition(7), labels)) == str(rules)
    few = decision_list.fit(docs, labels, max_rows=60)
    assert isinstance(few.rules, list)
    assert all(not r["kept"] for r in got.values() if r["base_failed"])


def test_rules_without_labels_keep_what_the_base_rule_keeps(spark):
    rows = [(1, "w " * 19), (2, " ".join(f"w{i}" for i in range(20))), (3, None), (4, "a b c d e f g h " * 5)]
    rules = decision_list.fit(frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int"))
    assert rules.rules == []
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in decision_list.judge(frame(spark, rows), rules).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (True, False), 4: (True, False)}


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage on what the one before it has kept, against brute force."""
    rows = corpus(11, 90)
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(d, 1, 0) for d, _ in rows[:30]], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    at = str(tmp_path)
    stage = dict(corpus_pipeline.STAGES)

    def run(name, df):
        out = stage[name](spark, df, at)
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    kept = run("quality rules", docs)
    good = {d for d, t in rows if len(words(t)) >= 20 and 100 * counts_of(t)[4] <= 30 * len(words(t))}
    assert {r["doc_id"] for r in kept.collect()} == good and kept.columns == corpus_pipeline.COLUMNS
    left = [(d, t) for d, t in rows if d in good]

    unique = run("near duplicates", kept)
    groups = jaccard_components(left, 5, 80)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(d for d in groups if groups[d][1] == d)
    left = [(d, t) for d, t in left if groups[d][1] == d]

    cut = run("repeated bytes", unique)
    want = {d: v[3].decode("utf-8", "ignore") for d, v in bytes_left(left, 200).items()}
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    whole = {d for d, v in bytes_left(left, 200).items() if v[1] == 0}
    assert {d: got[d] for d in whole} == {d: dict(left)[d] for d in whole}
    assert {d for d in got} == {d for d, t in want.items() if words(t)}
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    mixed = run("mixed sources", cut)
    taken = Counter(r["doc_id"] for r in mixed.collect())
    expected = {r["doc_id"]: r["repeats"] for r in curriculum.mix(cut, SCHEDULES).collect() if r["repeats"]}
    assert taken == expected and mixed.columns == corpus_pipeline.COLUMNS

    tokens = run("bpe", mixed).collect()
    assert Counter(r["doc_id"] for r in tokens) == taken
    import hashlib

    assert all(r["decoded_sha256"] == hashlib.sha256(got[r["doc_id"]].encode()).hexdigest() for r in tokens)


def test_stages_of_nothing_and_of_repeated_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = spark.createDataFrame([], SCHEMA)
    text = " ".join(f"w{i}" for i in range(60))
    again = frame(spark, [(1, text), (1, text), (2, text), (None, text), (3, "q" + text)])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
        out = stage(spark, again, str(tmp_path)).collect()
        if name == "near duplicates":
            assert sorted(str(r["doc_id"]) for r in out) == ["1", "None"]
