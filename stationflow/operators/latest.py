"""Reductions to one row per key. All combine before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.schema import COUNT, PREVIOUS, STATION, TIME


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of highest ``order`` for each key.

    The remaining columns break ties, so the winner never depends on arrival order.
    Rows with a NULL key belong to no key and are left out.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    keyed = df.dropna(subset=list(keys))
    best = keyed.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*[c if c in keys else f"_best.{c}" for c in df.columns])


def upsert_latest(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The table after the batch: the newer of its row and the batch's, key by key."""
    return latest_by(current.unionByName(batch), keys, order)


def dedupe_snapshots(snapshots: DataFrame, ties: Sequence[str] = (), keep_tie: str | None = None) -> DataFrame:
    """One (station, time, count) per station and instant: the one of highest ``ties``.

    Without ``ties`` the highest count is kept, which is arbitrary but reproducible.
    Copies are combined in the task that reads them, so a flood of them stays cheap.
    ``keep_tie`` names a column for the highest tie-breaker, null where there is none.
    """
    kept = [] if keep_tie is None else [(F.max(_rank(ties)) if ties else F.lit(None).cast("long")).alias(keep_tie)]
    return snapshots.groupBy(STATION, TIME).agg(_of_highest(COUNT, ties).alias(COUNT), *kept)


def _rank(ties: Sequence[str]) -> Column:
    return F.col(ties[0]) if len(ties) == 1 else F.when(_any_known(ties), F.struct(*ties))


def _of_highest(count: str, ties: Sequence[str]) -> Column:
    """The count at the highest tie-breaker, or the highest count where none says which.

    Tie-breakers tell repeats apart, as a log's offsets do. With one of fixed width this stays a
    hash aggregate; several, or texts, are compared as a struct, which is sorted.
    """
    if not ties:
        return F.max(count)
    return F.coalesce(F.max_by(count, _rank(ties)), F.max(count))


def _any_known(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNotNull() for c in columns])


def next_state(
    state: DataFrame | None,
    snapshots: DataFrame,
    ties: Sequence[str] = (),
    distinct_times: bool = False,
) -> DataFrame:
    """State after a batch: the newest snapshot of every station seen so far.

    Of repeats of one instant the highest tie-breaker wins, and a snapshot wins over the
    state. ``distinct_times`` promises that the batch has no two rows of one station and time,
    and none at the state's own time; then one aggregate is enough, else repeats go first.
    """
    rows = snapshots.select(STATION, F.col(COUNT).alias(PREVIOUS), TIME, *ties)
    if state is not None:
        unranked = [F.lit(None).cast(snapshots.schema[t].dataType).alias(t) for t in ties]
        rows = rows.unionByName(state.select(STATION, PREVIOUS, TIME, *unranked)).filter(F.col(STATION).isNotNull())
    if not distinct_times:
        rows = rows.groupBy(STATION, TIME).agg(_of_highest(PREVIOUS, ties).alias(PREVIOUS))
    newest = [F.coalesce(F.max_by(PREVIOUS, TIME), F.max(PREVIOUS)).alias(PREVIOUS), F.max(TIME).alias(TIME)]
    return rows.groupBy(STATION).agg(*newest)
