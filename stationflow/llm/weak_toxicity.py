"""Toxicity by weak supervision.

Many voters look at a text: each entry of a lexicon of words and stems mined from labelled rows, and fixed patterns. A voter says toxic,
clean or nothing. A generative label model takes the true class as hidden and estimates, by expectation
maximisation, how often each voter says what for each class; it measures how voters go together within
a class and weighs those that repeat others less. Given labels
mine the lexicon and say how many texts are toxic; they don't vote. The model's posterior labels train a
linear classifier over words and stems of a text, which is what scores the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved
from .tokens import Texts, Words, pieces

#: A term is a run of ASCII letters and non-ASCII bytes, A-Z in lower case.
BETWEEN_TERMS = np.ones(256, dtype=bool)
BETWEEN_TERMS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False

# Second persons, and negations and insults' usual company, in four languages.
SECOND_PERSON = ["you", "your", "yours", "du", "dich", "dir", "dein", "deine", "ihr", "tu", "te", "toi", "vous", "votre", "tus", "usted", "ustedes"]

#: Letters of a stem. Of a feature of a text it counts whether it occurs once, twice, three times or more.
STEMS = (4, 5, 6, 7)
LEVELS = 3

PATTERNS = ["shouts", "exclaims", "masks_letters", "addresses", "long_terms", "symbols"]


def terms(texts: Texts) -> Words:
    return Words(texts, lower=True, outside=BETWEEN_TERMS)


def term_hashes(words: list[str]) -> np.ndarray:
    return terms(Texts(pa.array(words, pa.large_string()))).hash if words else np.zeros(0, np.uint64)


def counted_features(text: str) -> Counter[str]:
    """How often each term of a text and each stem of one occurs; a stem is the first letters of a longer term, and a star."""
    out: Counter[str] = Counter()
    for term, n in Counter(re.findall(rb"[a-z\x80-\xff]+", text.encode().lower())).items():
        word = term.decode("utf-8", "replace")
        out[word] += n
        for size in STEMS:
            if len(word) > size:
                out[word[:size] + "*"] += n
    return out


def patterns(texts: Texts) -> np.ndarray:
    """Votes of the PATTERNS: 1 toxic, -1 clean, 0 nothing."""
    data, n = texts.data, texts.rows

    def share(marks: np.ndarray, below: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return (sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]) / np.maximum(below, 1)

    found = terms(texts)
    size = np.diff(texts.offsets)
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    letters = share(upper | lower, np.ones(n))
    masked = np.zeros(len(data), dtype=bool)
    masked[1:-1] = (data[1:-1] == ord("*")) & lower[:-2] & (lower[2:] | (data[2:] == ord("*"))) if len(data) > 2 else False
    addressed = np.bincount(found.row[np.isin(found.hash, term_hashes(SECOND_PERSON))], minlength=n) / np.maximum(found.count, 1)
    mean = np.bincount(found.row, weights=found.end - found.start, minlength=n) / np.maximum(found.count, 1)
    symbols = share((data == ord("#")) | (data == ord("%")) | (data == ord("$")) | (data == ord("&")), size)
    votes = np.zeros((n, len(PATTERNS)), dtype=np.int8)
    votes[:, 0] = np.where(share(upper, letters) > 0.3, 1, 0)
    votes[:, 1] = np.where(share(data == ord("!"), size) > 0.01, 1, 0)
    votes[:, 2] = np.where(share(masked, size) > 0.002, 1, 0)
    votes[:, 3] = np.where(addressed > 0.03, 1, 0)
    votes[:, 4] = np.where(mean > 9, -1, 0)
    votes[:, 5] = np.where(symbols > 0.05, -1, 0)
    return votes


@dataclass
class LabelModel:
    """rates[j, y, v]: how often voter j says v - 1 where the class is y. weight[j]: 1 for a voter unlike the others,
    less the more it goes with them within a class."""

    prior: float
    rates: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(self.rates[:, 1] / self.rates[:, 0]) * self.weight[:, None]
        odds = np.log(self.prior / (1 - self.prior)) + sum(log[j][votes[:, j] + 1] for j in range(votes.shape[1]))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    @classmethod
    def fit(cls, votes: np.ndarray, start: np.ndarray, trusted: dict[int, float] | None = None, rounds: int = 25, prior: float | None = None) -> LabelModel:
        """start: first guess of each row's probability to be toxic. trusted: voters whose accuracy is given, not estimated (`fit`
        names none). prior: the share of toxic rows, estimated as well if not given.

        How voters go together is measured around the first guess: around later ones, voters that
        repeat each other would explain themselves by the hidden class.
        """
        trusted = trusted or {}
        said = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)

        def estimate(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            by_class = np.stack([1 - p, p])
            rates = (np.einsum("yn,njv->jyv", by_class, said) + 0.1) / (by_class.sum(axis=1)[None, :, None] + 0.3)
            for j, accuracy in trusted.items():
                rates[j] = [[accuracy, 1e-6, 1 - accuracy], [1 - accuracy, 1e-6, accuracy]]
            return by_class, rates

        by_class, rates = estimate(start)
        # A voter's signal is that it speaks, or, if it always does, what it says.
        always = (votes != 0).all(axis=0)
        signal = np.where(always, votes > 0, votes != 0)
        rest = signal - np.einsum("yn,jy->nj", by_class, np.where(always[:, None], rates[:, :, 2], 1 - rates[:, :, 1]))
        spread = np.sqrt((rest**2).mean(axis=0) + 1e-6)
        together = np.clip(rest.T @ rest / len(votes) / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(together, 0)
        together[list(trusted)] = 0
        weight = 1 / (1 + np.where(together > 0.05, together, 0).sum(axis=1))
        model, p = cls(0.5, rates, weight), start
        for _ in range(rounds):
            model = cls(float(np.clip(p.mean() if prior is None else prior, 1e-3, 1 - 1e-3)), estimate(p)[1], weight)
            p = model.posterior(votes)
        return model


@dataclass
class Classifier:
    """A linear classifier over features: weights[f, k] is added where feature f occurs more than k times."""

    features: list[str]
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        #: By the bytes of a stem (0: whole terms), sorted hashes and the features they stand for.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        sizes = [len(f.encode()) - 1 if f.endswith("*") else 0 for f in self.features]
        hashes = term_hashes([f.removesuffix("*") for f in self.features])
        for size in sorted(set(sizes)):
            mine = np.flatnonzero(np.array(sizes) == size)
            mine = mine[np.argsort(hashes[mine])]
            self.tables[size] = hashes[mine], mine

    def hits(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, feature and count of the features in each text."""
        found = terms(texts)
        rows, features = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, (hashes, mine) in self.tables.items():
            row, h = (found.row, found.hash) if not size else found.prefixes(size)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            rows.append(row[hit])
            features.append(mine[at[hit]])
        both, count = np.unique(np.concatenate(rows) * max(len(self.features), 1) + np.concatenate(features), return_counts=True)
        return both // max(len(self.features), 1), both % max(len(self.features), 1), count

    def score(self, texts: Texts) -> np.ndarray:
        row, feature, count = self.hits(texts)
        value = np.cumsum(self.weights, axis=1)[feature, np.minimum(count, LEVELS) - 1] if len(row) else np.zeros(0)
        odds = np.bincount(row, weights=value, minlength=texts.rows) + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(features: list[str], row: np.ndarray, feature: np.ndarray, count: np.ndarray, target: np.ndarray, steps: int = 300) -> Classifier:
    """Logistic regression on soft labels, by gradient steps.

    A feature and count has as its value how strongly it speaks for its class, so few steps suffice.
    """
    n, toxic = len(target), float(target.sum())
    if n == 0 or not 0 < toxic < n:
        return Classifier([], np.zeros((0, LEVELS)), -5.0)
    r = np.concatenate([row[count > k] for k in range(LEVELS)])
    f = np.concatenate([feature[count > k] * LEVELS + k for k in range(LEVELS)])
    size = len(features) * LEVELS
    pos, every = np.bincount(f, weights=target[r], minlength=size), np.bincount(f, minlength=size)
    strength = np.log((pos + 0.5) / (toxic + 1)) - np.log((every - pos + 0.5) / (n - toxic + 1))
    strength = np.where(every >= 3, strength, 0.0)
    w, b = np.zeros(size), np.log(toxic / (n - toxic))
    speed_w, speed_b = np.full(size, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(r, weights=(w * strength)[f], minlength=n) + b, -30, 30)))
        gap = p - target
        g = np.bincount(f, weights=gap[r], minlength=size) * strength / n + 1e-5 * w
        gb = gap.mean()
        speed_w, speed_b = speed_w + g * g, speed_b + gb * gb
        w, b = w - 0.3 * g / np.sqrt(speed_w), b - 0.3 * gb / np.sqrt(speed_b)
    return Classifier(features, (w * strength).reshape(-1, LEVELS), float(b))


def mine(sample: DataFrame, size: int, least_chi: float = 20.0) -> list[tuple[str, int, bool]]:
    """The features, with a count, that tell the labels of a sample (label, text) apart most, and whether they speak for 1.

    A top-k by the chi-squared statistic, over counts of all the sample.
    """

    def list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                found = [(f, k) for f, n in counted_features(text).items() for k in range(min(n, LEVELS))]
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(found), pa.int64()), pa.array([f for f, _ in found], pa.string()), pa.array([k for _, k in found], pa.int32())], names=["label", "feature", "above"])

    counts = sample.select("label", "text").mapInArrow(list_features, "label long, feature string, above int")
    counts = counts.groupBy("feature", "above").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("texts")).filter("texts >= 3")
    toxic, every = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < toxic < every:
        return []
    expected = F.col("texts") * (toxic / every)
    chi = F.pow(F.col("toxic") - expected, 2) / F.greatest(expected * (1 - toxic / every) * (1 - F.col("texts") / every), F.lit(1e-9))
    top = counts.select("feature", "above", chi.alias("chi"), (F.col("toxic") > expected).alias("for")).filter(F.col("chi") >= least_chi)
    return [(r["feature"], r["above"], r["for"]) for r in top.orderBy(F.desc("chi"), "feature", "above").limit(size).collect()]


def lexicon_of(mined: list[tuple[str, int, bool]], size: int) -> dict[str, int]:
    """The first mined features that speak for 1, each with the count that tells most. One that a feature ahead of it
    covers, or that covers such a one, as stems do, would only repeat its vote."""
    out: dict[str, int] = {}
    covers = lambda a, b: a.endswith("*") and b.startswith(a[:-1])
    for f, above, speaks_for in mined:
        if len(out) < size and speaks_for and not any(covers(f, g) or covers(g, f) for g in out):
            out[f] = above
    return out


def held_out(key: str = "doc_id"):
    """Every fifth document, by checksum of its id: labels of these are never used."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 8_000, max_features: int = 2_000, lexicon: int = 96) -> Classifier:
    """Learn from labelled documents that aren't held out; at most max_rows of them, those of the smallest key hashes.

    The lexicon's voters are at most `lexicon` mined features (see lexicon_of); the label model starts from
    whether any of them speaks, and learns of the given labels only their mean. What reaches the driver are at most
    max_features features, and votes and hits of those rows. Labels other than 0 and 1 are ignored; without
    labels of both kinds the classifier scores every text low.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    usable = usable.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("long").alias("label")).orderBy(F.xxhash64("key"), "key").limit(max_rows)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = saved(texts.join(F.broadcast(usable), "key").groupBy("key").agg(F.max("label").alias("label"), F.min("text").alias("text")))
    mined = mine(sample, max_features)
    features = list(dict.fromkeys(f for f, _, _ in mined))
    finder = Classifier(features, np.zeros((len(features), LEVELS)), 0.0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in pieces(batches):
            row, feature, count = finder.hits(run)
            cuts = np.searchsorted(row, np.arange(run.rows + 1)).tolist()
            columns = [pa.array([v.tobytes() for v in patterns(run)], pa.binary())]
            columns += [pa.array([x[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for x in (feature, count)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), *columns], names=["key", "label", "votes", "features", "counts"])

    table = sample.mapInArrow(look, f"key {docs.schema[key].dataType.simpleString()}, label long, votes binary, features binary, counts binary").toArrow().sort_by("key")
    gold = table.column("label").to_numpy()
    lists = [np.frombuffer(x, dtype=np.int32) for x in table.column("features").to_pylist()]
    counts = [np.frombuffer(x, dtype=np.int32) for x in table.column("counts").to_pylist()]
    if not features:
        return Classifier([], np.zeros((0, LEVELS)), -5.0)
    row, feature, count = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists), np.concatenate(counts)
    place = {f: i for i, f in enumerate(features)}
    voters = [(place[f], above) for f, above in lexicon_of(mined, lexicon).items()]
    votes = np.zeros((len(lists), len(voters) + 1 + len(PATTERNS)), dtype=np.int8)
    for j, (f, above) in enumerate(voters):
        votes[row[(feature == f) & (count > above)], j] = 1
    spoken = votes[:, : len(voters)].any(axis=1)
    votes[:, len(voters)] = np.where(spoken, 0, -1)
    votes[:, len(voters) + 1 :] = np.stack([np.frombuffer(v, dtype=np.int8) for v in table.column("votes").to_pylist()])
    model = LabelModel.fit(votes, np.where(spoken, 0.9, 0.02), prior=float(gold.mean()))
    return train(features, row, feature, count, model.posterior(votes))


def score(docs: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row; a null text counts as empty and has the score of no words at all."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, run in pieces(batches):
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(run))], names=["key", "score"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = rows.mapInArrow(scored, f"key {docs.schema[key].dataType.simpleString()}, score double")
    return out.select(F.col("key").alias(key), held_out("key").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
