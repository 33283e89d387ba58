"""The folder that all executors share, and steps written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: How much Spark hands to Python at once, and the bytes of it that steps over whole texts ask for.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def ask_small_batches(spark: SparkSession) -> bool:
    """Ask for small batches from now on; false if the session has a limit of its own, which stays."""
    if spark.conf.get(BATCH, None) is not None:
        return False
    spark.conf.set(BATCH, str(BATCH_BYTES))
    return True


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of 2 MB, unless the session says otherwise.

    Spark's own limit is 10,000 rows. Of texts that is tens of MB, which a task holds several times: as it grows, as it
    is sent, in Python, and as it comes back.
    """
    mine = ask_small_batches(spark)
    try:
        yield
    finally:
        if mine:
            spark.conf.unset(BATCH)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where the session names none, a local master gets one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """df, computed once and read from the shared folder from now on, so a lost executor costs nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there. Its size is known then. A saved one keeps the estimate of its
    plan, a product over all joins: over rounds of joins that becomes a number of millions of digits, which the driver multiplies."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
