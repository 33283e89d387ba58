"""URL filters: rules by host and path, and a character language model for what no rule covers.

Two variable-order Markov models, of URLs that rules accept and of those they reject, give each character a
probability from the characters ahead of it. Each order is mixed with the shorter one by how varied what followed was
(Witten-Bell), down to a uniform one. A URL's score is the difference of its log-likelihoods per character; the
threshold is calibrated on URLs that neither model has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokens import Texts, pieces

#: Symbols: 0 the start, 1 any other byte, a-z in either case, 0 for each digit, and these.
MARKS = "./:-_?=&#%~+"
SYMBOLS = 2 + 26 + 1 + len(MARKS)
ORDER = 3

_SYMBOL = np.ones(256, dtype=np.int64)
for _i in range(26):
    _SYMBOL[97 + _i] = _SYMBOL[65 + _i] = 2 + _i
_SYMBOL[48:58] = 28
for _i, _c in enumerate(MARKS):
    _SYMBOL[ord(_c)] = 29 + _i


@dataclass(frozen=True)
class Rule:
    """Fits its host and all hosts below it, where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null or without `://`."""
    host, path = (F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", i), F.lit("")) for i in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matched(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does. Rules are configuration: few."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, F.lit(str(r))).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of each character with the ORDER ahead of it; ahead of a text stand start symbols."""
    row = texts.row_of_byte()
    symbol = _SYMBOL[texts.data]
    place = np.arange(len(symbol)) - texts.offsets[:-1][row] if len(symbol) else np.zeros(0, np.int64)
    code = symbol.copy()
    for back in range(1, ORDER + 1):
        earlier = np.zeros(len(symbol), dtype=np.int64)
        earlier[back:] = symbol[:-back]
        code += np.where(place >= back, earlier, 0) * SYMBOLS**back
    return row, code


class Markov:
    """Log-probabilities of a symbol after ORDER others, by code; as many as there are codes, whatever was counted."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        full = np.zeros(SYMBOLS ** (ORDER + 1))
        full[codes] = counts
        p = np.full(SYMBOLS, 1 / SYMBOLS)
        for order in range(ORDER + 1):
            # Counts of the last `order` symbols with the next; the shorter model has no first of them.
            seen = full.reshape(-1, SYMBOLS**order, SYMBOLS).sum(axis=0)
            total, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
            lower = np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS if order else 1, 1))
            p = np.where(total > 0, (seen + kinds * lower) / np.maximum(total + kinds, 1), lower)
        self.log = np.log(p.reshape(-1)).astype(np.float32)


@dataclass
class UrlModel:
    accepted: Markov
    rejected: Markov
    threshold: float

    def difference(self) -> np.ndarray:
        return self.accepted.log - self.rejected.log


def count_grams(urls: DataFrame) -> DataFrame:
    """(verdict, code, n) over all rows of (verdict, url). There are SYMBOLS ^ (ORDER + 1) codes at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "url"):
            _, code = grams(texts)
            blocked = np.array([v == "block" for v in batch.column("verdict").to_pylist()])
            both, n = np.unique(code * 2 + np.repeat(blocked, np.diff(texts.offsets)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both % 2 == 1), pa.array(both // 2), pa.array(n)], names=["blocked", "code", "n"])

    return urls.mapInArrow(count, "blocked boolean, code long, n long").groupBy("blocked", "code").agg(F.sum("n").alias("n"))


def scores(urls: DataFrame, difference: np.ndarray) -> DataFrame:
    """urls with `score`: the difference of log-likelihoods per character, 0 for an empty or null url."""
    keep = [c for c in urls.columns if c != "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "url"):
            row, code = grams(texts)
            total = np.bincount(row, weights=difference[code], minlength=texts.rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(total / np.maximum(np.diff(texts.offsets), 1))], names=[*keep, "score"])

    base = urls.select(*keep)
    return base.mapInArrow(score, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema) + ", score double")


def fit(ruled: DataFrame, wrongly_blocked: float = 0.01) -> UrlModel | None:
    """Learn from (url, verdict), all rows. Every fifth, by hash, calibrates: the threshold lets so many of the accepted
    ones fall below it, but is never above 0. None unless there are rows of both verdicts to learn from."""
    ruled = ruled.select("url", "verdict").withColumn("judge", F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    table = count_grams(ruled.filter("NOT judge").select("url", "verdict")).toArrow()
    blocked, code, n = (table.column(c).to_numpy() for c in ("blocked", "code", "n"))
    blocked = blocked.astype(bool)
    if not blocked.any() or blocked.all():
        return None
    model = UrlModel(Markov(code[~blocked], n[~blocked]), Markov(code[blocked], n[blocked]), 0.0)
    judged = scores(ruled.filter("judge AND verdict = 'allow'").select("url"), model.difference())
    at = judged.agg(F.percentile_approx("score", wrongly_blocked, 10_000)).first()[0]
    model.threshold = min(at, 0.0) if at is not None else 0.0
    return model


def judge(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url", **options) -> DataFrame:
    """(key, host, path, rule, verdict, score) of every row: the rule's verdict, else block where the model's score is below its
    threshold, else allow. Without both kinds of ruled URLs to learn from, what no rule covers is allowed."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    host, path = host_and_path(F.col("url"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn("rule", rule).withColumn("verdict", verdict)
    model = fit(rows.filter("verdict IS NOT NULL"), **options)
    scored = scores(rows, model.difference()) if model else rows.withColumn("score", F.lit(0.0))
    found = F.coalesce("verdict", F.when(F.col("score") < (model.threshold if model else 0.0), "block").otherwise("allow"))
    return scored.select(F.col("key").alias(key), "host", "path", "rule", found.alias("verdict"), "score")
