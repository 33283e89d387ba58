"""Where queries that write tables on their way do so, and with which settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """Under the shared folder the session names. A local master that names none has one of its own, gone at exit."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="stationflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def writing_session(spark: SparkSession) -> SparkSession:
    """A session of the same cluster for writing many small buckets, in UTC.

    A bucket costs a file however few its rows are, so tasks may hold little data
    before adaptive execution merges them. Large tasks are unaffected.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k")
    return session
