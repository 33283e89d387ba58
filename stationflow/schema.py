"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

STATION = "stationId"
COUNT = "parkingBikeTotCnt"
TIME = "event_time"
PREVIOUS = "previous_parkingBikeTotCnt"
#: When the log took an envelope in.
APPENDED = "append_time"

# The feed's field names and types, and its timestamp text format.
SNAPSHOT = T.StructType(
    [
        T.StructField("rackTotCnt", T.StringType()),
        T.StructField("stationName", T.StringType()),
        T.StructField("parkingBikeTotCnt", T.IntegerType()),
        T.StructField("shared", T.StringType()),
        T.StructField("stationLatitude", T.StringType()),
        T.StructField("stationLongitude", T.StringType()),
        T.StructField("stationId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def state_schema(time_type: T.DataType | None = None) -> T.StructType:
    """One row per station: its latest count and when that count was seen."""
    return T.StructType(
        [
            T.StructField(STATION, T.StringType()),
            T.StructField(PREVIOUS, T.IntegerType()),
            T.StructField(TIME, time_type or T.TimestampType()),
        ]
    )
