"""Flow rows of one hour without lagging the history before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.hour import hour_start, is_zoned
from stationflow.operators.lag import delta_lag
from stationflow.operators.latest import next_state
from stationflow.schema import TIME


def hour_of(snapshots: DataFrame, as_of: Column) -> tuple[Column, Column]:
    """Start and end of the hour that holds ``as_of``, which has the event time's type."""
    start = hour_start(as_of, is_zoned(snapshots))
    return start, start + F.expr("INTERVAL 1 HOUR")


def flows_of_hour(
    snapshots: DataFrame, as_of: Column, ties: Sequence[str] = (), state: DataFrame | None = None
) -> DataFrame:
    """``delta_lag`` restricted to the hour of ``as_of``.

    Of everything earlier only the last count per station matters. ``state``, one row per station as of
    the start of the hour, says it, and then only the hour itself is read. Without it the
    rows before the hour are reduced to one, by an aggregate that combines before it shuffles.
    """
    start, end = hour_of(snapshots, as_of)
    time = F.col(TIME)
    before = state if state is not None else next_state(None, snapshots.filter(time < start), ties)
    return delta_lag(snapshots.filter((time >= start) & (time < end)), ties, baseline=before)
