"""Parquet laid out by the hour in which a result's window ends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The folders results are published in, and their path parts, given as
# position and length in "yyyy-MM-dd HH:mm:ss".
HOURLY_SUMMARY = "hourly_summary"
TOTAL_HOURLY_STATS = "total_hourly_stats"
BUCKET = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2)}


def with_bucket(df: DataFrame, end: str = "end") -> DataFrame:
    """Add ``year, month, day, hour`` as zero-padded text, each row from its own window.

    They are cut from the time's text, which is wall-clock text with and without a zone.
    """
    text = F.col(end).cast("string")
    return df.withColumns({name: F.substring(text, at, n) for name, (at, n) in BUCKET.items()})


def write_bucketed(df: DataFrame, root: str, end: str = "end") -> None:
    """Replace, under ``root``, exactly the buckets that ``df`` has rows for.

    The rebalance gives a small bucket one file and lets adaptive execution spread a
    large one over several tasks; no bucket passes through a single task by force.
    """
    (
        with_bucket(df, end)
        .hint("rebalance", *[F.col(c) for c in BUCKET])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BUCKET)
        .parquet(root)
    )
