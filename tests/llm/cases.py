"""Small corpora with what the operators have to cope with, and brute-force versions of them."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def corpus(seed=0, n=60, long=True):
    """Rows (doc_id, text): copies, near copies, shared passages, repeats inside a text, edge cases."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéßñ", k=rng.randint(1, 7))) for _ in range(300)]
    prose = lambda k: " ".join(rng.choices(vocabulary, k=k))
    passage, common = prose(60), prose(45)
    texts = []
    for i in range(n):
        kind = i % 10
        text = prose(rng.randint(5, 150))
        if kind == 1:
            text = text[: len(text) // 2] + " " + passage + "\n" + text[len(text) // 2 :]
        elif kind == 2 and texts:
            text = rng.choice(texts)
        elif kind == 3 and texts:
            parts = rng.choice(texts).split(" ")
            for _ in range(max(1, len(parts) // 60)):
                parts[rng.randrange(len(parts))] = rng.choice(vocabulary)
            text = " ".join(parts)
        elif kind == 4:
            text = common + " " + text
        elif kind == 5:
            line = prose(12)
            text = "\n".join([line] * rng.randint(2, 9) + [text])
        elif kind == 6:
            text = text + "\t" + common + " 漢字 \x0b" + "ab " * 30
        texts.append(text)
    texts += ["", "one", "Two words", "x" * 700, "a b " * 200, passage, common, common[:150], "\n\n \t"]
    if long:
        texts.append(prose(4000) + " " + passage + " " + passage)
    ids = rng.sample(range(-50, 5 * len(texts)), len(texts))
    return [*zip(ids, texts), (10**12, None)]


def frame(spark, rows, parts=3):
    full = [(d, t, "en", f"s{(d or 0) % 3}", len(t) if t is not None else None) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def jaccard_components(rows, shingle, percent, lower=True):
    """{doc_id: (set size, component)} by comparing all pairs."""
    table = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    sets = {}
    for d, t in rows:
        w = words((t or "").translate(table) if lower else t)
        grams = {tuple(w[i : i + shingle]) for i in range(len(w) - shingle + 1)}
        sets[d] = grams or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def bytes_left(rows, length):
    """{doc_id: (bytes, removed, runs, left)}: every byte under a string that also starts elsewhere goes."""
    bodies = {d: (t or "").encode() for d, t in rows}
    seen = {}
    for b in bodies.values():
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = {}
    for d, b in bodies.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out


def words_left(rows, length):
    """{doc_id: (words, removed, left)}: every word under a window that also starts earlier goes."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            window = tuple(w[i : i + length])
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def rebuilt_conversations(rows, every=20, most=4):
    """{conv_id: [(role, text), ...]} of rows (conv_id, turn, role, text) with distinct turns, begun as others begin."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        out[c] = own.get(c - c % every, [])[:h] + own[c][h:]
    return out


def prefix_nodes(sequences):
    """Rows (conv_id, depth, parent's, members, children, leaves, saved tokens, ids that end there) of {conv_id: [turn, ...]}."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(p[:-1] for p in members if p)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        out.append((
            min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p],
            sum(not children[q] for q in below),
            sum((len(members[q]) - 1) * len(words(q[-1][1])) for q in below if q),
            sorted(c for c in convs if len(sequences[c]) == len(p)),
        ))
    return sorted(out, key=lambda r: r[:2])
