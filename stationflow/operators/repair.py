"""Rows that come after newer ones of their station, put where they belong.

A late row splits the step between its two neighbours: it has a flow of its own, from its predecessor, and changes that of
its successor. Nothing else changes, so the repair is those rows. The successor knows its predecessor's count, so
only successors are looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stationflow.functions.flow import flow_columns
from stationflow.schema import COUNT, STATION, TIME

#: Which of several rows of one station and instant counts: the one of the highest.
TIE = "tie"


def repairs(late: DataFrame, kept: DataFrame) -> DataFrame:
    """What late rows make of the kept ones: the rows whose count or predecessor is another now, with their new flow.

    ``late`` has station, time, count and ``tie``; ``kept`` also ``prev_count``, and one row per station and time. Of the
    kept rows those of the late rows' stations matter, and of these the ones at and next after each late row. A late row at
    a kept one's time takes its place if its tie, or at equal ties its count, is higher. A late row that no kept one
    follows can't be placed and is left out.

    Returns station, time, count, tie, prev_count, diff, rental, return, and the flow that each row had before,
    rental_before and return_before: 0 for rows that are new.
    """
    old = F.struct(F.col("prev_count"), F.col(COUNT).alias("count"))
    rank = F.struct(F.col(TIE), F.col(COUNT).alias("count"))
    rows = kept.select(STATION, TIME, rank.alias("rank"), old.alias("old"))
    rows = rows.unionByName(late.select(STATION, TIME, rank.alias("rank")), allowMissingColumns=True)
    rows = rows.groupBy(STATION, TIME).agg(F.max("rank").alias("rank"), F.max("old").alias("old"))
    rows = rows.select(STATION, TIME, F.col("rank.count").alias(COUNT), F.col(f"rank.{TIE}").alias(TIE), "old")
    rows = rows.withColumn("moved", F.col("old").isNull() | (F.col("old.count") != F.col(COUNT)))

    in_time = Window.partitionBy(STATION).orderBy(TIME)
    backwards = Window.partitionBy(STATION).orderBy(F.col(TIME).desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "after_moved": F.coalesce(F.lag("moved").over(in_time), F.lit(False)),
            "before": F.lag(COUNT).over(in_time),
            "follower": F.last("old", ignorenulls=True).over(backwards),
        }
    )
    rows = rows.filter(F.col("old").isNotNull() | F.col("follower").isNotNull()).filter("moved OR after_moved")
    prev = F.when(F.col("after_moved"), F.col("before")).otherwise(F.coalesce("old", "follower")["prev_count"])
    flow_before = flow_columns(F.col("old.count") - F.col("old.prev_count"))
    return (
        rows.withColumn("prev_count", prev)
        .withColumns({f"{name}_before": flow for name, flow in flow_before.items()})
        .withColumn("diff", F.col(COUNT) - F.col("prev_count"))
        .withColumns(flow_columns(F.col("diff")))
        .select(STATION, TIME, COUNT, TIE, "prev_count", "diff", "rental", "return", "rental_before", "return_before")
    )
