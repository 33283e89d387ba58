"""A batch against the per-station state that was known before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.flow import flow_columns
from stationflow.schema import COUNT, PREVIOUS, STATION, TIME


def delta_vs_state(
    snapshots: DataFrame, state: DataFrame, zero_prev_is_unknown: bool = True
) -> DataFrame:
    """Flow of every snapshot against the state, not against its neighbour in the batch.

    ``state`` has one row per station. An unseen station has no flow. With
    ``zero_prev_is_unknown`` neither has a station last seen empty; turn it off to count
    the refill of an empty station.

    The join carries no hint: Spark broadcasts the state when its measured size is below
    the session's threshold, and otherwise shuffles it, splitting a hot station.
    """
    known = F.col(PREVIOUS).isNotNull()
    if zero_prev_is_unknown:
        known &= F.col(PREVIOUS) != 0
    return (
        snapshots.join(state.select(STATION, PREVIOUS), STATION, "left")
        .withColumns(
            {
                "change": F.when(known, F.col(COUNT) - F.col(PREVIOUS)).otherwise(0),
                PREVIOUS: F.coalesce(PREVIOUS, F.lit(0)),
            }
        )
        .withColumns(flow_columns(F.col("change")))
    )


def late_snapshots(snapshots: DataFrame, state: DataFrame) -> DataFrame:
    """Rows not newer than what is already known of their station."""
    known = state.select(STATION, F.col(TIME).alias("known_at"))
    return snapshots.join(known, STATION).filter(F.col(TIME) <= F.col("known_at"))
