"""The hourly job with the state of each station in Spark's own state store, rather than in a table.

A batch touches the state of its stations only. The store needs RocksDB (``ROCKSDB``), set on the session before the query starts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stationflow.functions.flow import flow_columns
from stationflow.functions.hour import is_zoned
from stationflow.functions.parse import is_usable
from stationflow.operators.windows import HOUR
from stationflow.schema import COUNT, STATION, TIME
from stationflow.streaming.jobs import _start, _update_hours, _update_totals, _write_flows
from stationflow.streaming.tables import JobTables

if TYPE_CHECKING:
    import pandas as pd

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

#: Names that begin with an underscore don't reach the processor.
_AT = "at_micros"
_STEP = Row(STATION, _AT, COUNT, "late", "prev_count")


def _micros(rows: DataFrame) -> Column:
    """The time as a whole number, whatever zone the session is in."""
    if is_zoned(rows):
        return F.unix_micros(TIME)
    seconds = F.datediff(F.to_date(TIME), F.lit("1970-01-01")).cast("long") * 86400 + F.hour(TIME) * 3600 + F.minute(TIME) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), TIME) * 1_000_000).cast("long")


def _time_of(micros: str, zoned: bool) -> Column:
    if zoned:
        return F.timestamp_micros(micros)
    return F.expr(f"timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, CAST(CAST({micros} AS DECIMAL(20, 0)) / 1000000 AS DECIMAL(18, 6)))")


class StationRows(StatefulProcessor):
    """Keeps the last time and count of a station, and gives each newer row the count before it.

    Of rows of one instant the one of highest ties, and then of highest count, stands. A row not newer than the state is late, and
    passes without a predecessor. A station that no row names for ``expiry_ms`` of processing time is forgotten.
    A station has few rows in a batch, so they are plain rows: making frames of them costs many times their work.
    """

    def __init__(self, ties: Sequence[str], expiry_ms: int | None):
        self.ties, self.expiry_ms = list(ties), expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, bikes int")

    def steps(self, rows: Iterable[tuple], timers) -> Iterator[tuple]:
        """(at, count, late, count before) of rows (at, ties, count), in the order of time."""
        known = self.last.get()
        best = {row[0]: row for row in sorted(rows, key=_rank)}
        at, bikes = known if known else (None, None)
        newest = at
        for row in best.values():
            late = known is not None and row[0] <= at
            yield row[0], row[-1], late, None if late else bikes
            if not late:
                newest, bikes = row[0], row[-1]
        if newest != at:
            self.last.update((newest, bikes))
        if self.expiry_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.expiry_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        columns = [_AT, *self.ties, COUNT]
        for step in self.steps((tuple(row[c] for c in columns) for row in rows), timers):
            yield _STEP(key[0], *step)

    def handleExpiredTimer(self, key: tuple, timers, expired) -> Iterator[Row]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


class StationSteps(StationRows):
    """The same over frames, for ``transformWithStateInPandas``."""

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        import pandas as pd

        columns = [_AT, *self.ties, COUNT]
        steps = list(self.steps((row for frame in rows for row in zip(*(frame[c].tolist() for c in columns))), timers))
        out = pd.DataFrame([(key[0], *step) for step in steps], columns=list(_STEP))
        yield out.astype({"prev_count": "Int32"})


def _rank(row: tuple) -> list[tuple]:
    """Orders rows (at, ties, count) with what is missing first."""
    return [(True, x) if x is not None and x == x else (False, 0) for x in row]


def keyed_flows(snapshots: DataFrame, ties: Sequence[str] = (), expiry_ms: int | None = None) -> DataFrame:
    """Flow rows of a stream of snapshots, and its late rows (``late`` is true; they have no flow).

    Malformed rows have no station to be kept by: they are left out here, and ``split_malformed`` of the same stream has them.
    The rows that one station has in one micro-batch are held in memory together, so bound the batch. ``ties`` must be numbers.
    """
    usable = snapshots.filter(is_usable())
    rows = usable.select(STATION, COUNT, *ties, _micros(usable).alias(_AT))
    schema = f"{STATION} string, {_AT} long, {COUNT} int, late boolean, prev_count int"
    mode = "none" if expiry_ms is None else "processingTime"
    steps = rows.groupBy(STATION).transformWithState(StationRows(ties, expiry_ms), schema, "append", mode)
    steps = steps.select(STATION, _time_of(_AT, is_zoned(snapshots)).alias(TIME), COUNT, "late", "prev_count")
    return steps.withColumn("diff", F.col(COUNT) - F.col("prev_count")).withColumns(flow_columns(F.col("diff")))


def start_keyed_hourly_job(snapshots: DataFrame, root: str, ties: Sequence[str] = (), trigger: dict | None = None, expiry_ms: int | None = None) -> StreamingQuery:
    """Keep ``hourly_summary`` and ``total_hourly_stats`` under ``root`` up to date, with no state table of its own.

    Late rows are in ``flows`` with ``late`` set, and don't count. An epoch that is handled again writes what it wrote before.
    The state is in the query's checkpoint: a checkpoint that is lost begins anew, and so must the tables. ``expiry_ms`` needs a
    trigger that goes on: with timers of processing time Spark always sees one more batch to run, so ``availableNow`` would never end.
    """
    if expiry_ms is not None and trigger and "availableNow" in trigger:
        raise ValueError("a state that expires by processing time needs a trigger that goes on")
    tables = JobTables(snapshots.sparkSession, root)

    def handle(batch: DataFrame, epoch: int) -> None:
        flows = _write_flows(batch, JobTables(batch.sparkSession, root), epoch).filter("NOT late")
        days = [r[0] for r in flows.select(F.to_date(F.window(TIME, HOUR)["start"])).distinct().collect()]
        if days:
            for table in (_update_hours(flows, tables, epoch, days), _update_totals(flows, tables, epoch, days)):
                table.fold(epoch, days)

    return _start(keyed_flows(snapshots, ties, expiry_ms), handle, tables, "flows", trigger)
