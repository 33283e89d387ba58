"""Quality rules learned as a decision list.

Statistics of each text are counted in one pass. From the statistics of labelled rows, sequential covering
grows conjunctions of thresholds by information gain on two thirds of the rows, prunes them on the
other third, and keeps those that are precise enough there. The list is applied as one Spark expression:
CASE WHEN rule 1 THEN 1 WHEN rule 2 THEN 2 ... END.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import SPACE, Texts, Words, cover, mixed, pieces

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_BLANK = b" \t\n\x0b\x0c\r"

REPEAT_WINDOW = 8
#: Base rule: fewer words, or a larger percentage of words in repeated windows, is rejected outright.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_digits", "n_upper", "n_symbol_words"]
FEATURES = ["mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "distinct_share", "digit_share", "upper_share", "symbol_word_share", "words_per_line", "n_words"]


def _lines(data: bytes, offsets: list[int]) -> tuple[list[int], list[int]]:
    """Of each text: lines with a word, and those among them that equal an earlier line."""
    worded, dup = [], []
    for a, b in zip(offsets, offsets[1:]):
        lines = [x for x in data[a:b].split(b"\n") if x.strip(_BLANK)]
        worded.append(len(lines))
        dup.append(len(lines) - len(set(lines)))
    return worded, dup


def count_text(texts: Texts) -> dict[str, np.ndarray]:
    """The COUNTS of each text, one array each."""
    words, data, n = Words(texts), texts.data, texts.rows

    def by_row(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[texts.offsets[1:]] - sums[texts.offsets[:-1]]

    def words_by_row(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
        return sums[words.first[1:]] - sums[words.first[:-1]]

    def seen_before(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order that brings equals of a row together, and where an element equals the one before it."""
        key = mixed(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key)
        key = key[order]
        return order, np.concatenate(([False], key[1:] == key[:-1])) if len(key) else np.zeros(0, bool)

    order, same = seen_before(words.row, words.hash)
    distinct = np.bincount(words.row[order[~same]], minlength=n) if len(order) else np.zeros(n, np.int64)
    at, hashes = words.windows(REPEAT_WINDOW)
    order, same = seen_before(words.row[at], hashes)
    twice = same.copy()
    twice[:-1] |= same[1:]
    repeated = at[order[twice]]
    symbols = SYMBOLS[data]
    symbol_sums = np.concatenate(([0], np.cumsum(symbols, dtype=np.int64)))
    worded, dup = _lines(data.tobytes(), texts.offsets.tolist())
    return {
        "n_words": words.count,
        "word_chars": by_row(~SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": by_row(symbols),
        "n_lines": np.array(worded, dtype=np.int64),
        "n_dup_lines": np.array(dup, dtype=np.int64),
        "n_repeat_words": words_by_row(cover(len(words.start), repeated, repeated + REPEAT_WINDOW)),
        "n_distinct_words": distinct,
        "n_digits": by_row((data >= 48) & (data <= 57)),
        "n_upper": by_row((data >= 65) & (data <= 90)),
        "n_symbol_words": words_by_row(symbol_sums[words.end] > symbol_sums[words.start]),
    }


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the COUNTS of `text` as further long columns. A null text counts as empty.

    Columns of docs that bear such a name are replaced.
    """
    keep = [c for c in docs.columns if c not in COUNTS]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text):
            found = count_text(texts)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(found[c], pa.int64()) for c in COUNTS], names=keep + COUNTS)

    base = docs.select(*[f"`{c}`" for c in keep])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields] + [f"{c} long" for c in COUNTS])
    return base.mapInArrow(count, schema)


def feature_columns() -> dict[str, Column]:
    """The FEATURES as expressions over the COUNTS, safe for texts without words."""

    def share(top: str, below: str) -> Column:
        return F.col(top) / F.greatest(F.col(below), F.lit(1))

    return {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct_words", "n_words"),
        "digit_share": share("n_digits", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "symbol_word_share": share("n_symbol_words", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "n_words": F.col("n_words").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.threshold if self.above else x[self.feature] <= self.threshold

    def column(self) -> Column:
        value = feature_columns()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a text that meets one is rejected by the first it meets, any other is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule(self) -> Column:
        """Number of the first rule a row of `statistics` meets, from 1; null if it meets none."""
        out = F.lit(None).cast("int")
        for i in reversed(range(len(self.rules))):
            met = F.lit(True)
            for condition in self.rules[i]:
                met = met & condition.column()
            out = F.when(met, F.lit(i + 1)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"{i}: " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1)) or "no rules"


def _best(x: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray]) -> tuple[float, Condition | None]:
    """The condition of the highest information gain over the rows given."""
    p, n = int(bad.sum()), len(bad)
    best, chosen = 1e-9, None
    before = np.log2(p / n)
    for name, cuts in thresholds.items():
        order = np.argsort(x[name], kind="stable")
        value, hits = x[name][order], np.concatenate(([0], np.cumsum(bad[order])))
        at = np.searchsorted(value, cuts, side="right")
        for above, rows, pos in ((False, at, hits[at]), (True, n - at, p - hits[at])):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((pos > 0) & (rows < n), pos * (np.log2(pos / np.maximum(rows, 1)) - before), -1.0)
            if len(gain) and gain.max() > best:
                best, chosen = float(gain.max()), Condition(name, above, float(cuts[int(gain.argmax())]))
    return best, chosen


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int = 4, max_rules: int = 12, precision: float = 0.95, min_rows: int = 5, cuts: int = 256) -> DecisionList:
    """Learn a list from the features of labelled rows. bad: True where a row is to be rejected.

    Rows are dealt by turns: every third prunes and judges rules, the others grow them. Learning ends
    when a rule's share of bad rows among the judging rows it meets is under `precision`, or when it
    meets fewer than `min_rows` bad ones in all. Without rows of both kinds the list is empty.
    """
    bad = np.asarray(bad, dtype=bool)
    thresholds = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1), method="lower")) for k, v in x.items()} if len(bad) else {}
    left, judge = np.ones(len(bad), dtype=bool), np.arange(len(bad)) % 3 == 2
    out = DecisionList()
    while len(out.rules) < max_rules:
        inside = left & ~judge
        rule: list[Condition] = []
        while len(rule) < max_conditions and 0 < bad[inside].sum() < inside.sum():
            _, condition = _best({k: v[inside] for k, v in x.items()}, bad[inside], thresholds)
            if condition is None:
                break
            rule.append(condition)
            inside = inside & condition.holds(x)
        if not rule:
            break

        def worth(conditions: list[Condition]) -> tuple[float, int]:
            met = left & judge
            for c in conditions:
                met = met & c.holds(x)
            pos = int(bad[met].sum())
            return (pos - (int(met.sum()) - pos) * precision / (1 - precision) * 0.1, -len(conditions))

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)
        met = left.copy()
        for c in rule:
            met &= c.holds(x)
        judged = met & judge
        if bad[met].sum() < min_rows or bad[judged].sum() < precision * max(judged.sum(), 1):
            break
        out.rules.append(rule)
        left &= ~met
    return out


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000, **options) -> DecisionList:
    """Learn from labelled rows: label 0 is to be rejected, 1 kept, any other value ignored.

    At most `max_rows` labelled keys are used, those of the smallest key hashes; only their
    statistics reach the driver. Rows that fail the base rule are left out, as it judges them.
    """
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key").limit(max_rows)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key")
    counted = statistics(rows).filter(~base_failed())
    # A key may repeat in docs; take each once, so that the bound holds.
    features = [F.first(c).alias(k) for k, c in feature_columns().items()]
    table = counted.groupBy("_key").agg(F.first("_label").alias("_label"), *features).toArrow()
    order = np.argsort(table.column("_key").to_numpy())
    x = {k: table.column(k).to_numpy()[order] for k in FEATURES}
    return learn(x, table.column("_label").to_numpy()[order] == 0, **options)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """docs with COUNTS, base_failed, rule (number of the first rule met, or null) and kept."""
    out = statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("rule", rules.rule())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
