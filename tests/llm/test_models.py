"""Tokens, fingerprints and the trained models."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from cases import SCHEMA, corpus, frame
from pyspark.sql import functions as F

from stationflow.llm import bpe_table, licence_text, simhash, url_model, weak_toxicity
from stationflow.llm.queries import RULES, TOKENIZERS
from stationflow.llm.tokens import Texts

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.mark.parametrize("chunk_bytes", [1 << 22, 2500])
def test_bpe_equals_the_library(spark, chunk_bytes):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    odd = ["<|endoftext|>", "a <|endoftext|>b", "don't  I'LL\n\n 12٣４ é\u00a0x\u0085", "\x00\ufeff", "日本 🙂🙂", "  lead", "x" * 3000]
    rows = [*corpus(12, 30), *[(5000 + i, t) for i, t in enumerate(odd)], (5000, odd[0])]
    encoded = bpe_table.encode(frame(spark, rows), PATH, chunk_bytes=chunk_bytes)
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe_table.digests(bpe_table.decode(encoded, PATH)).collect()}
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert got[d] == want
    assert bpe_table.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_ids_are_decoded_by_the_task_that_has_them(spark):
    docs = frame(spark, [*corpus(12, 30), (5000, "日本 🙂🙂"), (5001, None), (5002, "a <|endoftext|>b"), (5002, "")])
    both = bpe_table.encode(docs, PATH, chunk_bytes=2500, decoded=True)
    rows = lambda df: sorted((r["doc_id"], bytes(r["ids"]), r["text"]) for r in df.collect())
    assert rows(both) == rows(bpe_table.decode(bpe_table.encode(docs, PATH, chunk_bytes=2500), PATH))
    # A second Python step in the stage would take a second worker a task.
    plan = bpe_table.digests(both)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan[: plan.index("FlatMapCoGroupsInArrow")]


def test_words_of_a_run_are_those_of_the_pattern():
    known, find = bpe_table.vocabulary(PATH), regex.compile(bpe_table.SPLIT).findall
    marks = ["'", "s", "re", "e", "ll", "d", " ", "\n", "\t", "\x1c", "\x85", "\u00a0", "\u2028", "a", "É", "日", "一", "🙂", "1", "٣", "²", "-", "\u0301", "\x00"]
    rng = random.Random(3)
    for some in (marks, [m for m in marks if m.isascii()]):
        texts = ["".join(rng.choices(some, k=rng.randrange(12))) for _ in range(20_000)]
        column = Texts(pa.array(texts))
        words, first = known.words(column)
        assert words.to_pylist() == [w.encode() for t in texts for w in find(t)]
        assert np.diff(first).tolist() == [len(find(t)) for t in texts]
    texts = ["a<|endoftext|>'s  <|endoftext|>", "<|endof", "text|> <|endoftext|>", ""]
    words, first = known.words(Texts(pa.array(texts)))
    assert [w.decode() for w in words.to_pylist()] == ["a", "<|endoftext|>", "'s", "  ", "<|endoftext|>", *find("<|endof"), *find("text|> "), "<|endoftext|>"]


def test_splitting_a_run_takes_less_than_matching_the_pattern():
    texts = [f"It's text {i}, of 20 words or so: they'll be split as one run, and not one by one." for i in range(20_000)]
    known, column, find = bpe_table.vocabulary(PATH), Texts(pa.array(texts)), regex.compile(bpe_table.SPLIT).findall
    known.words(column)
    times = []
    for step in (lambda: known.words(column), lambda: [find(t) for t in texts]):
        began = time.process_time()
        step()
        times.append(time.process_time() - began)
    assert times[0] < times[1] / 2


def edited(rows):
    rows = sorted(rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        t, following = t or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        out[d] = (len(t), hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest())
    return out


def test_edits_and_fingerprints(spark):
    rows = corpus(13, 40)
    got = {r["doc_id"]: r for r in simhash.compare_with_edits(frame(spark, rows)).collect()}
    assert {d: (r["n_chars"], r["edited_sha256"]) for d, r in got.items()} == edited(rows)
    by_text = {}
    for d, t in rows:
        by_text.setdefault(t or "", set()).add(got[d]["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    assert by_text[""] == {"0" * 32}
    long = [r for r in got.values() if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.9
    like = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
    assert all(r["near_edited"] == pytest.approx(like(r["fingerprint"], r["edited_fingerprint"])) for r in got.values())


def test_fingerprints_of_null_ids_and_repeated_rows(spark):
    """Every row is there, and equal rows of full blocks overflow nothing. A clashing column and no rows at all are fine."""
    long = " ".join(["aaaaaaaaaaaa"] * 3000)
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "other words"), (None, "x y"), (None, None), (3, long), (3, long), (3, long), (3, long)]
    df = frame(spark, rows).withColumn("id", F.lit("clash")).withColumn("name", F.lit(1)).withColumn("fingerprint", F.lit(0))
    got = simhash.compare_with_edits(df).collect()
    size = lambda t: len(t or "")
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == sorted((d or 0, size(t)) for d, t in rows)
    alone = {t: simhash.fingerprints(frame(spark, [(1, t)]), ["doc_id"]).first()["fingerprint"] for t in {t for _, t in rows}}
    want = sorted((d or 0, size(t), alone[t]) for d, t in rows)
    assert sorted((r["doc_id"] or 0, r["n_chars"], r["fingerprint"]) for r in got) == want
    assert simhash.compare_with_edits(df.limit(0)).count() == 0


def test_fingerprint_counts_every_word_of_a_long_text(spark):
    """More words than a block has, by adding up votes in Python."""
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "be", "gammagammagammagamma", "d"]) for _ in range(9000))
    df = frame(spark, [(1, text)])
    hashes = {r["w"]: (r["a"], r["b"]) for r in df.select(F.explode(F.array_distinct(F.split("text", " "))).alias("w")).select("w", F.xxhash64("w").alias("a"), F.xxhash64("w", F.lit(1)).alias("b")).collect()}
    votes = np.zeros(128)
    for w in text.split(" "):
        for half, h in enumerate(hashes[w]):
            for i in range(64):
                votes[64 * half + i] += min(len(w), 12) * (1 if h >> i & 1 else -1)
    want = "".join(f"{sum(1 << i for i in range(64) if votes[64 * half + i] > 0):016x}" for half in (0, 1))
    assert simhash.fingerprints(df, ["doc_id"]).first()["fingerprint"] == want


def test_fingerprint_of_one_long_word_many_times(spark):
    """Every vote of a block goes to the same bits: the fingerprint is the word's hash. Several words, as some fill each lane."""
    rows = [(i, " ".join([w] * 10_000)) for i, w in enumerate(("aaaaaaaaaaaa", "0x0000000000", "spamspamspamspam", "bbbbbbbbbbbb", "cccccccccccc"))]
    df = frame(spark, rows)
    hashes = df.select("doc_id", F.split("text", " ")[0].alias("w")).select("doc_id", F.xxhash64("w").alias("a"), F.xxhash64("w", F.lit(1)).alias("b")).collect()
    want = {r["doc_id"]: f"{r['a'] % 2**64:016x}{r['b'] % 2**64:016x}" for r in hashes}
    assert {r["doc_id"]: r["fingerprint"] for r in simhash.fingerprints(df, ["doc_id"]).collect()} == want


@pytest.mark.parametrize(("radius", "blocks"), [(0, 1), (3, 5), (6, 8)])
def test_all_neighbours_are_found(spark, radius, blocks):
    rng = random.Random(2)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(128)
        prints += [base, *[base ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 9))) for _ in range(5)]]
    texts = [f"{p:032x}" for p in prints]
    df = spark.createDataFrame([(t,) for t in texts], "fingerprint string")
    got = {(r[0], r[1]): r[2] for r in simhash.within_radius(df.limit(100), df, radius, blocks).collect()}
    ask = {r[0] for r in df.limit(100).collect()}
    far = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    assert got == {(a, b): far(a, b) for a in ask for b in set(texts) if far(a, b) <= radius}


def test_following_ids(spark):
    rng = random.Random(3)
    ids = sorted({-(2**63), 2**63 - 1, 0, -1, *(rng.randrange(-(2**62), 2**62) for _ in range(50)), *range(70000, 70040), *range(65530, 65540)})
    got = {r["id"]: r["next"] for r in simhash.following(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    assert got == dict(zip(ids, [*ids[1:], ids[0]]))


def toxic_rows(rng, n=700):
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for d in range(n):
        w = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = d % 6 == 0
        if toxic and d % 12:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["Nasty!", "vile,", "rotten"])
        elif toxic:
            for _ in range(4):
                w[rng.randrange(len(w))] = "zorkk" + rng.choice(vocabulary)
        elif d % 7 == 0:
            w[0] = "zorkk" + rng.choice(vocabulary)
        rows.append((d, " ".join(w)))
        labels.append((d, 1, int(toxic)))
    return rows, labels


def test_toxicity_is_learned_without_held_out_labels(spark):
    rows, labels = toxic_rows(random.Random(5))
    docs = frame(spark, [*rows, (10_000, None), (10_001, "")])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = weak_toxicity.fit(docs, table)
    got = {r["doc_id"]: r for r in weak_toxicity.score(docs, model).collect()}
    held = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert {d for d, r in got.items() if r["held_out"] and d < 10_000} == set(held)
    truth = {d: t for d, _, t in labels}
    assert np.mean([got[d]["predicted"] == truth[d] for d in held]) > 0.95
    assert got[10_000]["score"] == got[10_001]["score"] < 0.5
    flipped = table.withColumn("toxic", F.when(weak_toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = weak_toxicity.fit(docs, flipped)
    assert again.features == model.features and np.allclose(again.weights, model.weights)


def test_toxicity_without_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model = weak_toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r["predicted"] for r in weak_toxicity.score(docs, model).collect()] == [0, 0]
    assert weak_toxicity.score(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_label_model_discounts_voters_that_repeat_each_other():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    vote = lambda accuracy: np.where(rng.random(4000) < accuracy, truth, ~truth) * 2 - 1
    weak = vote(0.6)
    votes = np.column_stack([weak, weak, weak, weak, vote(0.9), vote(0.85)]).astype(np.int8)
    votes[:, 4][rng.random(4000) < 0.3] = 0
    start = np.where(votes[:, 5] == 1, 0.85, 0.15)
    model = weak_toxicity.LabelModel.fit(votes, start, {5: 0.85})
    assert model.rates[4, 1, 2] / model.rates[4, 0, 2] > 4
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.88


URLS = [
    ("https://WWW.Example.com/en/x?q=1", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://a.example.com/de/", "a.example.com", "/de/", "com/", "allow"),
    ("http://x.net/es/1#f", "x.net", "/es/1", "net/es/", "block"),
    ("http://notcom", "notcom", "", None, None),
    ("http://com?x=/", "com", "", None, None),
    ("nothing", "", "", None, None),
    (None, "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("://\nÄB.COM/", "\nÄb.com", "/", "com/", "allow"),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = url_model.judge(df, RULES).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(got, URLS):
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or rule is None and r["verdict"] in ("allow", "block")
    assert url_model.judge(df.limit(0), RULES).count() == 0


def test_url_model_tells_apart_what_rules_do_not_cover(spark):
    rng = random.Random(6)
    name = lambda letters: "".join(rng.choices(letters, k=8))
    urls = [f"http://{name('abcd')}.com/{name('abcd')}" for _ in range(400)] + [f"http://{name('wxyz')}.net/es/{name('wxyz')}" for _ in range(400)]
    urls += [f"http://{name('abcd')}.org/{name('abcd')}" for _ in range(50)] + [f"http://{name('wxyz')}.org/{name('wxyz')}" for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_model.judge(df, RULES).collect()}
    assert sum(got[i] == "allow" for i in range(800, 850)) >= 46 and sum(got[i] == "block" for i in range(850, 900)) >= 46


def test_markov_sums_to_one():
    rng = np.random.default_rng(1)
    codes = rng.choice(url_model.SYMBOLS ** 4, 500, replace=False)
    model = url_model.Markov(codes, rng.integers(1, 9, 500))
    assert np.allclose(np.exp(model.log.astype(float)).reshape(-1, url_model.SYMBOLS).sum(axis=1), 1, atol=1e-4)


def test_licences(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)] + ["the", "of", "under", "version", "license"]
    prose = lambda: " ".join(rng.choices(vocabulary, k=12))
    notices = [(f, n) for f, listed in licence_text.NOTICES.items() for n in listed]
    rows = [(i, "\n".join(prose() for _ in range(4))) for i in range(60)]
    rows += [(100 + i, prose() + "\n" + n.upper() + "\n" + prose()) for i, (_, n) in enumerate(notices)]
    rows += [(500, None), (501, ""), (502, prose() + " the license version 2 of prose"), (100, None)]
    df = frame(spark, rows)
    got = {}
    for r in licence_text.of_documents(df, licence_text.scan(df, licence_text.fit(df))).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], []) + r["families"]
    assert all(got[i] == [] for i in [*range(60), 500, 501])
    assert sum(f in got[100 + i] for i, (f, _) in enumerate(notices)) >= len(notices) - 1


def test_licences_of_other_versions_and_variants_are_unknown(spark):
    """Nearly the words of a notice, but of another version or variant; and the same notices with other numbers about."""
    prose = corpus(8, 60)
    others = [
        "This work is licensed under the GNU General Public License, version 2.",
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution 3.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Released under the BSD 2-Clause License.",
        "Licensed under the Apache License, Version 1.1.",
    ]
    same = {"Release 2 of this work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Version 2 is released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    rows = [(10**6 + i, t) for i, (_, t) in enumerate(prose)] + list(enumerate([*others, *same]))
    df = frame(spark, rows)
    got = {r["doc_id"]: r["families"] for r in licence_text.of_documents(df, licence_text.scan(df, licence_text.fit(df))).collect()}
    assert [got[i] for i in range(len(others))] == [["unknown"]] * len(others)
    assert [got[len(others) + i] for i in range(len(same))] == [[f] for f in same.values()]


def test_licences_learn_from_every_text(spark):
    """A phrase that half of 1,200 texts have is learned the better, the more texts have it; no text is too many."""
    prose = [(i, "plain words of no licence\nmore of them") for i in range(600)]
    phrase = "we met under the mit building yesterday and spoke of many other things then"
    model = lambda n: licence_text.fit(frame(spark, [*prose, *[(10_000 + i, phrase) for i in range(n)]]))
    few, many = (dict(map(tuple, model(n)[0].select("gram", F.col("weights")[0]).collect())) for n in (30, 600))
    assert many["under the"] > few["under the"]
    df = frame(spark, [*prose, *[(10_000 + i, phrase) for i in range(600)]])
    assert licence_text.matches(df).count() == 600


def test_licences_of_null_and_repeated_ids(spark):
    """A row's result is that of its own text."""
    gpl, mit = licence_text.NOTICES["GPL-3.0"][0], licence_text.NOTICES["MIT"][0]
    rows = [(10**6 + i, t) for i, (_, t) in enumerate(corpus(8, 60))]
    odd = [(None, gpl), (None, None), (None, mit), (7, gpl), (7, None), (7, "plain words only"), (8, mit + "\n" + mit), (8, mit + "\n" + mit), (8, mit + "\n" + mit)]
    df = frame(spark, [*rows, *odd]).withColumn("at", F.lit(1)).withColumn("family", F.lit("x"))
    model = licence_text.fit(df)
    got = licence_text.of_documents(df, licence_text.scan(df, model)).collect()
    assert len(got) == len(rows) + len(odd)
    found = [(r["doc_id"], r["families"], r["n_notices"]) for r in got if r["doc_id"] in (None, 7, 8)]
    # One row of the corpus has the id None by no chance: ids there are moved by 10**6.
    want = [(None, ["GPL-3.0"], 1), (None, ["MIT"], 1), (None, [], 0), (7, ["GPL-3.0"], 1), (7, [], 0), (7, [], 0), *[(8, ["MIT"], 2)] * 3]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert licence_text.of_documents(df.limit(0), licence_text.scan(df.limit(0), model)).count() == 0


@pytest.mark.parametrize("line", ["gnu lesser general public license version 2", "cc by sa 4", "affero general", "no derivatives", "share alike 3", "a clause 3 clause", "lgpl v3", "plain words", "", "by nc nd", "non commercial noderivs"])
def test_cheap_tests_of_lines_lose_no_version_or_variant(spark, line):
    df = spark.createDataFrame([(line,)], "line string")
    plain = F.concat(F.regexp_extract_all("line", F.lit(licence_text.VERSION), F.lit(1)), F.regexp_extract_all("line", F.lit(licence_text.CLAUSES), F.lit(1)))
    r = df.select(plain.alias("a"), licence_text.versions_of(F.col("line")).alias("b"), F.regexp_extract_all("line", F.lit(licence_text.VARIANT), F.lit(1)).alias("c"), licence_text.variants_of(F.col("line")).alias("d")).first()
    assert r["a"] == r["b"] and r["c"] == r["d"]


def test_labels_only_mine_and_set_the_prior():
    """The label model is given votes and a share, nothing else: rows of equal votes get equal posteriors."""
    rng = np.random.default_rng(3)
    truth = rng.random(2000) < 0.2
    votes = np.column_stack([np.where(truth & (rng.random(2000) < a), 1, 0) for a in (0.6, 0.7, 0.5)] + [np.where(rng.random(2000) < 0.1, -1, 0)]).astype(np.int8)
    spoken = votes[:, :3].any(axis=1)
    votes = np.column_stack([votes, np.where(spoken, 0, -1)]).astype(np.int8)
    model = weak_toxicity.LabelModel.fit(votes, np.where(spoken, 0.9, 0.02), prior=0.2)
    p = model.posterior(votes)
    by_votes = {}
    for v, x in zip(map(tuple, votes.tolist()), p.tolist()):
        by_votes.setdefault(v, set()).add(round(x, 9))
    assert all(len(x) == 1 for x in by_votes.values())
    assert ((p > 0.5) == truth).mean() > 0.9
