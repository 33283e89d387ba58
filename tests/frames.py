"""Small literal frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

#: The smallest of the given tables.
SF = "/root/testdata/sf0.001"

SNAPSHOTS = "stationId string, event_time timestamp_ntz, parkingBikeTotCnt int, offset bigint"


def at(text: str) -> datetime:
    """``10:05`` on the first of July, or a full timestamp."""
    return datetime.fromisoformat(text if "-" in text else f"2024-07-01 {text}")


def snapshots(spark: SparkSession, *rows: tuple) -> DataFrame:
    """Rows of (station, time, count); the offset is the position."""
    data = [(s, at(t) if t else None, n, i) for i, (s, t, n) in enumerate(rows)]
    return spark.createDataFrame(data, SNAPSHOTS).coalesce(1)


def state(spark: SparkSession, *rows: tuple) -> DataFrame:
    data = [(s, n, at(t)) for s, n, t in rows]
    return spark.createDataFrame(
        data, "stationId string, previous_parkingBikeTotCnt int, event_time timestamp_ntz"
    )


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
