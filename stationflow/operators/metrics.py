"""Row counts of a batch, taken on the way past rather than by a second evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stationflow.functions.parse import is_usable


def _counts() -> list[Column]:
    return [
        F.count("*").alias("total"),
        F.count_if(is_usable()).alias("parsed"),
        F.count_if(~is_usable()).alias("malformed"),
    ]


def observe_batch(snapshots: DataFrame, observation: Observation) -> DataFrame:
    """Attach the counts to ``snapshots``; the first action over the result fills them."""
    return snapshots.observe(observation, *_counts())


def batch_metrics(snapshots: DataFrame) -> DataFrame:
    """The counts as a one-row frame, malformed rows included in ``total``."""
    return snapshots.agg(*_counts())
