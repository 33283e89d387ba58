"""Where envelopes come from: a message log, or files for tests and back-fill."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.schema import APPENDED

# The feed's topic, and that a new query reads all that is retained.
TOPICS = ("bike-station-info",)
STARTING_OFFSETS = "earliest"

ENVELOPE = T.StructType([T.StructField("value", T.StringType())])
LOG_POSITION = ("topic", "partition", "offset")
POSITIONED = T.StructType(
    [*ENVELOPE, T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)


def kafka_options(
    servers: Sequence[str], topics: Sequence[str] = TOPICS, max_offsets_per_trigger: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": ",".join(topics),
        "startingOffsets": STARTING_OFFSETS,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_envelopes(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    streaming: bool = True,
    position: bool = False,
    options: dict[str, str] | None = None,
    appended: bool = False,
) -> DataFrame:
    """``value STRING`` from ``kafka``, ``text`` or ``parquet``, streaming or batch.

    ``position`` keeps a log's topic, partition and offset, which order repeats of one
    snapshot; a parquet archive of a log has them as columns. ``appended`` keeps the time at which the log took an
    envelope in, as ``append_time``; in an archive it has that name. Paths are any Hadoop URI; endpoints and credentials belong to the cluster.
    Bound a back-fill's micro-batches with ``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger`` in ``options``.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**(options or {}))
    if fmt == "parquet":
        schema = POSITIONED if position else ENVELOPE
        reader = reader.schema(T.StructType([*schema, T.StructField(APPENDED, T.TimestampType())]) if appended else schema)
    rows = reader.load(path) if path is not None else reader.load()
    if appended and "timestamp" in rows.columns:
        rows = rows.withColumnRenamed("timestamp", APPENDED)
    kept = [c for c in LOG_POSITION if position and c in rows.columns] + [APPENDED] * appended
    return rows.selectExpr("CAST(value AS STRING) AS value", *kept)


def next_offsets(envelopes: DataFrame) -> str:
    """Where a log goes on after these envelopes, as the text that the option ``startingOffsets`` takes.

    One row per topic and partition goes to the driver. A partition that gave none isn't named: name it at the start if the log has one.
    """
    ends = envelopes.dropna(subset=list(LOG_POSITION)).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
    found: dict[str, dict[str, int]] = {}
    for topic, partition, following in ends.orderBy("topic", "partition").collect():
        found.setdefault(topic, {})[str(partition)] = following
    return json.dumps(found)


def once_per_position(envelopes: DataFrame, within: str = "1 hour", appended: str = APPENDED) -> DataFrame:
    """A stream without what the source delivers again: one row for each topic, partition and offset.

    The positions of rows that the log took in up to ``within`` before the newest one are kept as state, and forgotten then;
    what is delivered again later than that passes. Rows without a position or a log time aren't told apart by
    this and must not be given to it.
    """
    return envelopes.withWatermark(appended, within).dropDuplicatesWithinWatermark(list(LOG_POSITION))
