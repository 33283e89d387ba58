"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from cases import prefix_nodes, rebuilt_conversations

from stationflow.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed, n=120):
    """Rows with shared beginnings, whole copies, sequences that begin others, and a long conversation."""
    rng = random.Random(seed)
    texts = ["", "yes", "a b", "tell me more\tplease", "no", "x " * 50, "é ñ", None]
    out, made = [], []
    for c in rng.sample(range(0, 3 * n), n):
        turns = [(rng.choice(["user", "tool", None]), rng.choice(texts)) for _ in range(rng.randint(1, 6))]
        if made and rng.random() < 0.6:
            like = rng.choice(made)
            turns = like[: rng.randint(1, len(like))] + (turns if rng.random() < 0.5 else [])
        made.append(turns)
        places = rng.sample(range(-9, 40), len(turns))
        out += [(c, t, *turn) for t, turn in zip(sorted(places), turns)]
    out += [(7000, t, "user", rng.choice(texts)) for t in range(150)]
    out += [(7020, t if t else None, "user", "yes") for t in range(40)]
    rng.shuffle(out)
    return out


def found(spark, rows, every=20, most=4, schema=SCHEMA):
    turns = prefix_trie.numbered(spark.createDataFrame(rows, schema).repartition(5))
    rebuilt, ids = prefix_trie.with_shared_heads(turns, every, most)
    trie = prefix_trie.trie(rebuilt, ids)
    out = trie.nodes.join(trie.end_digests(), prefix_trie.NAME, "left").fillna(hashlib.sha256().hexdigest(), ["ends_sha256"])
    return sorted((tuple(r) for r in out.select(*COLUMNS, "ends_sha256").collect()), key=lambda r: r[:2])


def expected(rows, every=20, most=4):
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return [(*r[:7], digest(r[7])) for r in prefix_nodes(rebuilt_conversations(rows, every, most))]


@pytest.mark.parametrize("seed", range(2))
def test_nodes_of_rebuilt_conversations(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE", 3)
    monkeypatch.setattr(prefix_trie, "END_BITS", 4)
    rows = [r for r in conversations(seed) if r[0] != 7000 or r[1] < 20]
    assert found(spark, rows) == expected(rows)


def test_conversations_as_they_are(spark):
    rows = conversations(5, 40)
    assert found(spark, rows, every=1, most=1) == expected(rows, 1, 1)


def test_one_sequence_of_very_many(spark):
    rows = [(c, 0, "user", "hello there") for c in range(2000)] + [(c, 1, "bot", f"{c % 7}") for c in range(2000)]
    got = found(spark, rows, 1, 1)
    assert got == expected(rows, 1, 1) and len(got) == 9


def test_turnless_null_and_empty(spark):
    """Conversation 25 has less turns than it takes from 20, which isn't there: it ends at the root. Rows without an id don't count."""
    rows = [(25, 1, "u", "a"), (None, 1, "u", "b"), (23, None, None, None), (23, 4, "u", "")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, [(5, 1, "u", "x")], every=20, most=1) == expected([(5, 1, "u", "x")], 20, 1)
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "b")]) == []


def test_ties_repeats_and_clashing_columns(spark):
    """Turns of one number keep an order of their own whatever order they come in; equal rows are turns each."""
    rows = [(1, 5, "u", t) for t in ("b", "a", "c", "a")] + [(2, 5, "u", t) for t in ("a", "c", "a", "b")]
    got = found(spark, rows, 1, 1)
    assert got == found(spark, rows[::-1], 1, 1)
    assert [r[3] for r in got] == [2] * 5 and got[-1][1] == 4
    more = [(*r, 0, "z", 1) for r in rows]
    assert found(spark, more, 1, 1, SCHEMA + ", place long, a string, _piece long") == got


def test_prefixes_are_no_leaves(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "c")]
    assert found(spark, rows, 1, 1) == expected(rows, 1, 1)
    assert [(r[1], r[5]) for r in found(spark, rows, 1, 1)] == [(0, 2), (1, 2), (2, 1), (2, 1)]
