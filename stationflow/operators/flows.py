"""From parsed snapshots to flow rows, the same way in a stream and in a back-fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stationflow.functions.parse import split_malformed
from stationflow.operators.lag import SLICE_SECONDS, delta_lag
from stationflow.operators.latest import dedupe_snapshots


def usable_once(snapshots: DataFrame, ties: Sequence[str] = (), keep_tie: str | None = None) -> DataFrame:
    """Usable rows only (station, time and count are known), one per station and instant."""
    return dedupe_snapshots(split_malformed(snapshots)[0], ties, keep_tie)


def station_flows(
    snapshots: DataFrame,
    ties: Sequence[str] = (),
    baseline: DataFrame | None = None,
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Flow rows of a feed as it comes: malformed rows set aside, copies dropped, the rest lagged.

    This is what the hourly job makes of its batches, so a back-fill over the same rows
    gives the same totals.
    """
    return delta_lag(usable_once(snapshots, ties), baseline=baseline, slice_seconds=slice_seconds)
