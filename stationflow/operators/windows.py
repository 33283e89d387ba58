"""Event-time totals. Each works on batch and on streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.hour import hour_start, is_zoned
from stationflow.operators.current import hour_of
from stationflow.schema import STATION, TIME

# The windows the results are defined over.
HOUR = "1 hour"
SLIDE = "5 minutes"
TWO_HOURS = "2 hours"


def _sums(rental: str, return_: str) -> list[Column]:
    return [F.sum("rental").alias(rental), F.sum("return").alias(return_)]


def hourly_tumbling(flows: DataFrame) -> DataFrame:
    """Rentals and returns per station and hour; ``hh:00:00`` opens its own hour."""
    return (
        flows.groupBy(F.window(TIME, HOUR).alias("w"), STATION)
        .agg(*_sums("total_rental", "total_return"))
        .select("w.start", "w.end", STATION, "total_rental", "total_return")
    )


def hourly_truncated(flows: DataFrame) -> DataFrame:
    """The same totals keyed by the truncated time, for zones of whole-hour offset."""
    hour = hour_start(F.col(TIME), is_zoned(flows))
    return (
        flows.filter(F.col(TIME).isNotNull())
        .groupBy(hour.alias("start"), STATION)
        .agg(*_sums("total_rental", "total_return"))
        .select(
            "start",
            (F.col("start") + F.expr("INTERVAL 1 HOUR")).alias("end"),
            STATION,
            "total_rental",
            "total_return",
        )
    )


def current_hour(flows: DataFrame, as_of: Column) -> DataFrame:
    """``hourly_tumbling`` of the hour holding ``as_of``, which is never the wall clock.

    The range filter comes first and on the plain column, so it can reach the scan.
    """
    start, end = hour_of(flows, as_of)
    return hourly_tumbling(flows.filter((F.col(TIME) >= start) & (F.col(TIME) < end)))


def sliding_station(flows: DataFrame) -> DataFrame:
    """Per station, each hour that starts on a 5-minute mark: a row counts in twelve.

    Rows are folded into the panes of their station first. What is shuffled then are panes, each to the two hours in which
    its windows start; there they are sorted, and each gives the windows that it is the first pane of. So no task holds windows,
    which are up to twelve times the panes. A stream knows no order of rows: its windows are added up one by one.
    """
    panes = flows.groupBy(F.window(TIME, SLIDE).alias("pane"), STATION).agg(*_sums("rental", "return"))
    if flows.isStreaming:
        return (
            panes.groupBy(F.window("pane", HOUR, SLIDE).alias("w"), STATION)
            .agg(*_sums("hourly_rental", "hourly_return"))
            .select("w.start", "w.end", STATION, "hourly_rental", "hourly_return")
        )
    # Windows that start in an hour end within it and the next one.
    near = panes.select(F.window("pane", TWO_HOURS, HOUR)["start"].alias("hour"), STATION, F.col("pane.start").alias("at"), "rental", "return")
    in_time = f"PARTITION BY hour, {STATION} ORDER BY at"
    first = near.select(
        "hour",
        STATION,
        "at",
        F.expr(f"lag(at) OVER ({in_time})").alias("before"),
        F.expr(f"collect_list(struct(at, rental, return)) OVER ({in_time} RANGE BETWEEN CURRENT ROW AND INTERVAL '55' MINUTE FOLLOWING)").alias("panes"),
    )
    # From 55 minutes before the pane, or the mark after the pane before it, up to the pane itself; all within the hour.
    low = F.greatest("hour", F.expr("at - INTERVAL '55' MINUTE"), F.expr("before + INTERVAL '5' MINUTE"))
    high = F.least("at", F.expr("hour + INTERVAL '55' MINUTE"))
    starts = first.withColumns({"low": low, "high": high}).filter("low <= high")
    starts = starts.select(STATION, "panes", F.explode(F.sequence("low", "high", F.expr(f"INTERVAL {SLIDE}"))).alias("start"))
    ended = starts.withColumn("end", F.expr(f"start + INTERVAL {HOUR}"))
    inside = ended.select("start", "end", STATION, F.filter("panes", lambda p: p["at"] < F.col("end")).alias("panes"))
    # As in a sum, a null is passed over, and only nulls give null.
    add = lambda a, b: F.coalesce(a + b, a, b)
    total = lambda name: F.aggregate(F.col("panes")[name], F.lit(None).cast(panes.schema[name].dataType), add)
    return inside.select("start", "end", STATION, total("rental").alias("hourly_rental"), total("return").alias("hourly_return"))


def total_by_window(stations: DataFrame) -> DataFrame:
    """Second level: city-wide totals of per-station sliding sums."""
    return stations.groupBy("start", "end").agg(
        F.sum("hourly_rental").alias("total_hourly_rental"),
        F.sum("hourly_return").alias("total_hourly_return"),
    )


def pane_totals(flows: DataFrame) -> DataFrame:
    """City-wide flow per 5-minute pane, the unit all sliding windows are made of."""
    return flows.groupBy(F.window(TIME, SLIDE).alias("pane")).agg(*_sums("rental", "return"))


def totals_from_panes(panes: DataFrame, pane: str = "pane") -> DataFrame:
    """City-wide sliding totals from (possibly several partial) pane totals."""
    return (
        panes.groupBy(F.window(pane, HOUR, SLIDE).alias("w"))
        .agg(*_sums("total_hourly_rental", "total_hourly_return"))
        .select("w.start", "w.end", "total_hourly_rental", "total_hourly_return")
    )


def sliding_total(flows: DataFrame) -> DataFrame:
    """City-wide sliding totals, equal to ``total_by_window(sliding_station(flows))``.

    A sum over stations of sums is a sum, so stations need not be told apart, and the
    slide divides the window, so rows are first folded into panes: every task shuffles
    one row per pane at most, and the twelvefold expansion works on panes, not on rows.
    """
    return totals_from_panes(pane_totals(flows))
