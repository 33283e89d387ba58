"""The driver's ``events`` table in the role of station snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.schema import COUNT, STATION, TIME, TIMESTAMP_FORMAT

PROPS = T.StructType([T.StructField("k", T.IntegerType())])

#: Orders events of one user and instant.
TIES = ["event_id"]


def as_snapshots(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias(STATION),
        F.from_json("props", PROPS).getField("k").alias(COUNT),
        F.col("ts").alias(TIME),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_snapshots(spark.read.parquet(f"{sf_dir}/events.parquet"))


def redelivered(rows: DataFrame) -> DataFrame:
    """A feed that sends some rows again: of even events a corrected copy with a higher id, of every third
    event an outdated one with a lower id."""
    again = rows.filter("event_id % 2 = 0").withColumns({"event_id": F.col("event_id") + 10_000_000, COUNT: F.col(COUNT) + 1})
    old = rows.filter("event_id % 3 = 0").withColumns({"event_id": F.col("event_id") - 10_000_000, COUNT: F.col(COUNT) + 2})
    return rows.unionByName(again).unionByName(old)


def polluted(rows: DataFrame) -> DataFrame:
    """A feed with everything that goes wrong: rows sent again, and rows without station, count or time."""
    broken = {
        STATION: F.when(F.col("event_id") % 11 != 0, F.col(STATION)),
        COUNT: F.when(F.col("event_id") % 7 != 0, F.col(COUNT)),
        TIME: F.when(F.col("event_id") % 13 != 0, F.col(TIME)),
    }
    return redelivered(rows).withColumns(broken)


def crowded(rows: DataFrame) -> DataFrame:
    """Two rows of three belong to one station."""
    return rows.withColumn(STATION, F.when(F.col("event_id") % 3 != 0, F.lit("hot")).otherwise(F.col(STATION)))


def broken_envelopes(events: DataFrame) -> DataFrame:
    """Envelopes of which some have a count or a time that can't be read."""
    rows = as_envelopes(events)
    no_count = F.regexp_replace("value", '"parkingBikeTotCnt":[0-9]+', '"parkingBikeTotCnt":"many"')
    rows = rows.withColumn("value", F.when(F.col("offset") % 5 == 0, no_count).otherwise(F.col("value")))
    no_time = F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"yesterday"')
    return rows.withColumn("value", F.when(F.col("offset") % 7 == 0, no_time).otherwise(F.col("value")))


def as_envelopes(events: DataFrame, *keep: str) -> DataFrame:
    """Events as the JSON text a station feed would send, with a log offset and the columns to keep."""
    bikes = F.from_json("props", PROPS).getField("k")
    document = F.to_json(
        F.struct(
            (bikes + 10).cast("string").alias("rackTotCnt"),
            F.concat(F.lit("Stop "), "user_id").alias("stationName"),
            bikes.alias(COUNT),
            F.col("event_type").alias("shared"),
            F.concat(F.lit("37."), "user_id").alias("stationLatitude"),
            F.concat(F.lit("127."), "user_id").alias("stationLongitude"),
            F.col("user_id").cast("string").alias(STATION),
            F.date_format("ts", TIMESTAMP_FORMAT).alias("timestamp"),
        )
    )
    return events.select(F.col("event_id").alias("offset"), document.alias("value"), *keep)
