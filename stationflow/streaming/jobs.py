"""Streaming jobs. The caller owns the returned query: it waits, stops and handles errors.

Nothing in a handler swallows an exception. A failed write fails the batch, its offsets
are not committed, and the epoch is handled again after a restart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions.parse import set_aside_ahead, split_malformed
from stationflow.operators.flows import usable_once
from stationflow.operators.lag import SLICE_SECONDS, delta_lag
from stationflow.operators.latest import next_state, upsert_latest
from stationflow.operators.metrics import observe_batch
from stationflow.operators.repair import TIE, repairs
from stationflow.operators.windows import HOUR, hourly_tumbling, pane_totals, totals_from_panes
from stationflow.schema import APPENDED, COUNT, PREVIOUS, STATION, TIME, state_schema
from stationflow.sinks.bucketed import (
    BUCKET,
    HOURLY_SUMMARY,
    TOTAL_HOURLY_STATS,
    with_bucket,
    write_bucketed,
)
from stationflow.streaming.parts import FOLD_AFTER, DayParts
from stationflow.streaming.tables import KEEP_VERSIONS, SEEDED, BucketedTable, JobTables, VersionedTable

# Fixed value: how late a flow row may be for the watermarked totals.
LATENESS = "10 minutes"


def _start(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    tables: JobTables,
    state: str,
    trigger: dict | None,
) -> StreamingQuery:
    tables.require_consistent(state)
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", tables.checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()


@dataclass(frozen=True)
class HourlyOptions:
    """How the hourly job works.

    ``ties`` orders repeats of a station and instant. ``keep_states`` versions of the state stay. ``repair`` puts late rows
    where they belong; without it they are only set aside. ``ahead``: a snapshot's time may be so far after ``append_time``,
    the time at which the log took it in, where the rows have one; others are malformed. With ``state_buckets`` the state
    is kept in so many buckets of stations, and a batch reads and writes those of its stations only. A day with
    more than ``fold_after`` parts is folded.
    """

    ties: Sequence[str] = ()
    slice_seconds: int = SLICE_SECONDS
    keep_states: int = KEEP_VERSIONS
    repair: bool = False
    ahead: str | None = None
    state_buckets: int | None = None
    fold_after: int = FOLD_AFTER


def start_hourly_job(
    snapshots: DataFrame,
    root: str,
    ties: Sequence[str] = (),
    slice_seconds: int = SLICE_SECONDS,
    trigger: dict | None = None,
    keep_states: int = KEEP_VERSIONS,
    **more,
) -> StreamingQuery:
    """Keep ``hourly_summary`` and ``total_hourly_stats`` under ``root`` up to date.

    ``snapshots`` is a parsed stream; the other arguments are those of ``HourlyOptions``. A snapshot that arrives after a newer one
    of its station was already handled is late: it is set aside in ``arrivals/epoch=<id>/outcome=late``. With ``repair``
    it also counts. Cut into any number of batches, the results are then those of one batch run; without ``repair``
    they are as long as no row is late.
    """
    tables = JobTables(snapshots.sparkSession, root)
    options = HourlyOptions(ties, slice_seconds, keep_states, **more)

    def handle(batch: DataFrame, epoch: int) -> None:
        _handle_hourly(batch, epoch, root, options)

    return _start(snapshots, handle, tables, "state", trigger)


def handle_hourly_batch(
    batch: DataFrame,
    epoch: int,
    root: str,
    ties: Sequence[str] = (),
    slice_seconds: int = SLICE_SECONDS,
    keep_states: int = KEEP_VERSIONS,
    **more,
) -> None:
    """One micro-batch. Handling an epoch again leaves every table as it was."""
    _handle_hourly(batch, epoch, root, HourlyOptions(ties, slice_seconds, keep_states, **more))


def state_of(tables: JobTables, time_type: T.DataType, options: HourlyOptions) -> VersionedTable | BucketedTable:
    schema = state_schema(time_type)
    if options.state_buckets:
        return BucketedTable(tables.root.spark, tables.path("state"), schema, [STATION], options.state_buckets)
    return VersionedTable(tables.root.spark, tables.path("state"), schema)


def _handle_hourly(batch: DataFrame, epoch: int, root: str, options: HourlyOptions) -> None:
    spark = batch.sparkSession
    tables = JobTables(spark, root)
    state = state_of(tables, batch.schema[TIME].dataType, options)
    if batch.isEmpty():
        if not state.versions():
            state.save(state.load(), epoch)
        return

    # Parsed once: which buckets the batch touches, what is malformed and what arrived are told by the same kept rows.
    counts = Observation("batch")
    rows = _kept(batch, options, counts)
    try:
        known = state.load(before=epoch, of=rows.select(STATION).filter(F.col(STATION).isNotNull()))
        arrivals = _write_arrivals(rows, known, tables, epoch, options, counts)
    finally:
        rows.unpersist()
    fresh = arrivals.filter(F.col("outcome") == "fresh").drop("outcome")
    repaired = _write_repairs(arrivals, known, tables, epoch) if options.repair else None
    if repaired is not None:
        # A late row that took the place of a station's newest one is what the station is known by now.
        newest = repaired.select(STATION, TIME, F.col(COUNT).alias("_count"))
        known = known.join(newest, [STATION, TIME], "left").withColumn(PREVIOUS, F.coalesce("_count", PREVIOUS)).drop("_count")
    flows = _write_flows(delta_lag(fresh, baseline=known, slice_seconds=options.slice_seconds), tables, epoch)
    state.save(next_state(known, flows, distinct_times=True), epoch, options.keep_states)

    moved = flows.select(STATION, TIME, "rental", "return")
    if options.repair:
        kept = kept_rows(tables, flows.schema)
        rows = flows if repaired is None else flows.unionByName(repaired.select(*flows.columns))
        kept.write(rows, epoch, TIME)
        if repaired is not None:
            more = [(F.col(c) - F.col(f"{c}_before")).alias(c) for c in ("rental", "return")]
            moved = moved.unionByName(repaired.select(STATION, TIME, *more))

    # The days in which this epoch's hours start: all that may have changed, and no others.
    days = [r[0] for r in moved.select(F.to_date(F.window(TIME, HOUR)["start"])).distinct().collect()]
    if days:
        tables_written = [_update_hours(moved, tables, epoch, days), _update_totals(moved, tables, epoch, days)]
        for table in tables_written:
            table.fold(epoch, days, options.fold_after)
        if options.repair:
            kept.fold(epoch, _days_of(moved), options.fold_after)


#: The epoch of what a back-fill leaves to a stream: below all of the stream's own.
BACKFILL = -1


def seed_hourly_job(snapshots: DataFrame, root: str, ties: Sequence[str] = (), slice_seconds: int = SLICE_SECONDS, **more) -> None:
    """Write, from a batch of snapshots, all tables that the hourly job would have left had it handled them.

    A job started on this root afterwards goes on from there: give its stream what the batch didn't have
    (``next_offsets`` says from where). The options must be the job's. A back-fill that fails half way can be run again;
    one that is done, or a root with a checkpoint, is refused.
    """
    spark = snapshots.sparkSession
    tables, options = JobTables(spark, root), HourlyOptions(ties, slice_seconds, **more)
    if tables.root.exists(SEEDED) or tables.root.exists("checkpoint"):
        raise ValueError(f"{root} has been seeded or started")
    state = state_of(tables, snapshots.schema[TIME].dataType, options)
    counts = Observation("batch")
    rows = _kept(snapshots, options, counts)
    try:
        arrivals = _write_arrivals(rows, state.load(before=BACKFILL), tables, BACKFILL, options, counts)
    finally:
        rows.unpersist()
    flows = _write_flows(delta_lag(arrivals.drop("outcome"), slice_seconds=slice_seconds), tables, BACKFILL)
    state.save(next_state(None, flows, distinct_times=True), BACKFILL, options.keep_states)
    if options.repair:
        kept_rows(tables, flows.schema).write(flows, BACKFILL, TIME)
    days = [r[0] for r in flows.select(F.to_date(F.window(TIME, HOUR)["start"])).distinct().collect()]
    if days:
        _update_hours(flows, tables, BACKFILL, days)
        _update_totals(flows, tables, BACKFILL, days)
    tables.root.make(SEEDED)


def _days_of(rows: DataFrame) -> list[date]:
    return [r[0] for r in rows.select(F.to_date(TIME)).distinct().collect()]


def _kept(batch: DataFrame, options: HourlyOptions, counts: Observation) -> DataFrame:
    """The rows of a batch, counted and kept for the steps that read them."""
    if options.ahead is not None and APPENDED in batch.columns:
        batch = set_aside_ahead(batch, options.ahead)
    return observe_batch(batch, counts).persist(StorageLevel.MEMORY_AND_DISK)


def _write_arrivals(rows: DataFrame, known: DataFrame, tables: JobTables, epoch: int, options: HourlyOptions, counts: Observation) -> DataFrame:
    """Sort the batch into malformed, late and fresh rows, and return the late and the fresh ones.

    What follows reads the written rows: the source is not evaluated again, and a lost
    executor costs a re-read, not a recomputation.
    """
    _, malformed = split_malformed(rows)
    malformed.write.mode("overwrite").parquet(f"{tables.path('malformed')}/epoch={epoch}")

    known_at = known.select(STATION, F.col(TIME).alias("_known_at"))
    outcome = F.when(F.col(TIME) <= F.col("_known_at"), "late").otherwise("fresh")
    arrivals = (
        usable_once(rows, options.ties, TIE if options.repair else None)
        .join(known_at, STATION, "left")
        .withColumn("outcome", outcome)
        .drop("_known_at")
    )
    path = f"{tables.path('arrivals')}/epoch={epoch}"
    arrivals.write.mode("overwrite").partitionBy("outcome").parquet(path)
    _write_metrics(tables, epoch, counts)
    return rows.sparkSession.read.schema(arrivals.schema).parquet(path)


def kept_rows(tables: JobTables, flows: T.StructType) -> DayParts:
    """All rows that count, with their flow, by day: of a station and time the one of the newest epoch."""
    rest = [f.name for f in flows if f.name not in (STATION, TIME)]

    def newest(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(STATION, TIME).agg(F.max_by(F.struct(*rest), "epoch").alias("best"))
        return best.select(STATION, TIME, "best.*")

    return DayParts(tables, "kept", flows, newest)


def _write_repairs(arrivals: DataFrame, known: DataFrame, tables: JobTables, epoch: int) -> DataFrame | None:
    """What the late rows of an epoch change, written as ``repairs/epoch=<id>``; None if none is late.

    Kept rows are read of the late rows' days and the days after them, and only of their stations. Where a station was
    silent so long that its next row is later still, all days after that are read for it.
    """
    late = arrivals.filter(F.col("outcome") == "late").drop("outcome")
    days = _days_of(late)
    if not days:
        return None
    flow = T.StructType([*late.schema, T.StructField("prev_count", T.IntegerType()), T.StructField("diff", T.IntegerType()), T.StructField("rental", T.IntegerType()), T.StructField("return", T.IntegerType())])
    kept = kept_rows(tables, flow)
    near = _kept_of(kept, epoch, late, {d + timedelta(days=i) for d in days for i in (0, 1)})
    # Answered is a late row whose own day, or the next one, has a kept row of its station at or after it.
    day = F.to_date(TIME)
    last = near.groupBy(STATION, day.alias("day")).agg(F.max(TIME).alias("last"))
    asked = late.select(STATION, TIME, F.explode(F.array(day, F.date_add(day, 1))).alias("day"))
    seen = asked.join(last, [STATION, "day"], "left").groupBy(STATION, TIME).agg(F.max("last").alias("last"))
    silent = seen.filter(F.col("last").isNull() | (F.col("last") < F.col(TIME)))
    since = silent.agg(F.min(day)).first()[0]
    if since is not None:
        later = [d for d in kept.days() if d > since]
        near = near.unionByName(_kept_of(kept, epoch, silent, set(later))).dropDuplicates([STATION, TIME])
    path = f"{tables.path('repairs')}/epoch={epoch}"
    repaired = repairs(late, near)
    repaired.write.mode("overwrite").parquet(path)
    return tables.root.spark.read.schema(repaired.schema).parquet(path)


def _kept_of(kept: DayParts, epoch: int, rows: DataFrame, days: set[date]) -> DataFrame:
    """Kept rows of these days and of the stations of ``rows``, as they were before an epoch."""
    found = kept.read(epoch - 1, sorted(days)).join(rows.select(STATION).distinct(), STATION, "left_semi")
    return kept.fold_rows(found)


def _write_flows(flows: DataFrame, tables: JobTables, epoch: int) -> DataFrame:
    path = f"{tables.path('flows')}/epoch={epoch}"
    flows.write.mode("overwrite").parquet(path)
    return tables.root.spark.read.schema(flows.schema).parquet(path)


def _update_hours(flows: DataFrame, tables: JobTables, epoch: int, days: list[date]) -> Partials:
    partials = Partials(tables, "hour_partials", hourly_tumbling(flows))
    partials.write_sums(epoch)
    so_far = partials.read(epoch, days)
    so_far = _in_buckets_of(so_far, so_far.filter(F.col("epoch") == epoch))
    sums = [F.sum(c).alias(c) for c in ("total_rental", "total_return")]
    write_bucketed(so_far.groupBy("start", "end", STATION).agg(*sums), tables.path(HOURLY_SUMMARY))
    return partials


def _update_totals(flows: DataFrame, tables: JobTables, epoch: int, days: list[date]) -> Partials:
    panes = pane_totals(flows).select("pane.start", "rental", "return")
    partials = Partials(tables, "pane_partials", panes)
    partials.write_sums(epoch)
    # A window reaches into the neighbouring hour, which may be in the neighbouring day.
    so_far = partials.read(epoch, [d + timedelta(days=i) for d in days for i in (-1, 0, 1)])
    touched = totals_from_panes(so_far.filter(F.col("epoch") == epoch), "start")
    totals = _in_buckets_of(totals_from_panes(so_far, "start"), touched)
    write_bucketed(totals, tables.path(TOTAL_HOURLY_STATS))
    return partials


def _in_buckets_of(rows: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows whose bucket ``touched`` has a row in: a bucket is replaced as a whole."""
    buckets = with_bucket(touched.select("end").distinct()).select(*BUCKET).distinct()
    return with_bucket(rows).join(buckets, list(BUCKET), "left_semi").drop(*BUCKET)


class Partials(DayParts):
    """Sums per epoch, by the day they start in, to be added up over epochs when read."""

    def __init__(self, tables: JobTables, name: str, sums: DataFrame):
        self.rows = sums
        numbers = [f.name for f in sums.schema if isinstance(f.dataType, T.LongType)]
        keys = [c for c in sums.columns if c not in numbers]

        def add_up(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])

        super().__init__(tables, name, sums.schema, add_up)

    def write_sums(self, epoch: int) -> None:
        self.write(self.rows, epoch, "start")


def start_latest_job(
    snapshots: DataFrame,
    root: str,
    keys: Sequence[str] = (STATION,),
    order: Sequence[str] = (TIME,),
    trigger: dict | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
    keep: int = KEEP_VERSIONS,
    buckets: int | None = None,
) -> StreamingQuery:
    """Keep the newest snapshot of every key in the versioned table ``<root>/latest``.

    ``sink(rows, epoch)`` gets, after each batch, the newest row of every key the batch has, for instance to
    ``put_rows`` them into a key-value store. A repeated epoch gives it the same rows again.
    ``keep`` versions of the table stay: a reader may hold one that long. With ``buckets`` the table is kept in so many
    buckets of keys, and a batch reads and writes those of its keys only.
    """
    tables = JobTables(snapshots.sparkSession, root)

    def handle(batch: DataFrame, epoch: int) -> None:
        handle_latest_batch(batch, epoch, root, keys, order, sink, keep, buckets)

    return _start(snapshots, handle, tables, "latest", trigger)


def latest_table(tables: JobTables, schema: T.StructType, keys: Sequence[str] = (STATION,), buckets: int | None = None) -> VersionedTable | BucketedTable:
    spark, path = tables.root.spark, tables.path("latest")
    return BucketedTable(spark, path, schema, keys, buckets) if buckets else VersionedTable(spark, path, schema)


def handle_latest_batch(
    batch: DataFrame,
    epoch: int,
    root: str,
    keys: Sequence[str] = (STATION,),
    order: Sequence[str] = (TIME,),
    sink: Callable[[DataFrame, int], None] | None = None,
    keep: int = KEEP_VERSIONS,
    buckets: int | None = None,
) -> None:
    """One micro-batch, counted and merged in one pass over it, then handed to the sink."""
    tables = JobTables(batch.sparkSession, root)
    latest = latest_table(tables, batch.schema, keys, buckets)
    if batch.isEmpty():
        if not latest.versions():
            latest.save(latest.load(), epoch)
        return
    touched = batch.select(*keys).dropna()
    counts = Observation("batch")
    counted = observe_batch(batch, counts)
    latest.save(upsert_latest(latest.load(before=epoch, of=touched), counted, keys, order), epoch, keep)
    _write_metrics(tables, epoch, counts)
    if sink is not None:
        sink(latest.load(of=touched).join(touched.distinct(), list(keys), "left_semi"), epoch)


def _write_metrics(tables: JobTables, epoch: int, counts: Observation) -> None:
    row = [F.lit(n).cast("bigint").alias(name) for name, n in counts.get.items()]
    out = tables.root.spark.range(1).select(*row).write.mode("overwrite")
    out.parquet(f"{tables.path('metrics')}/epoch={epoch}")


def stream_sliding_total(flows: DataFrame) -> DataFrame:
    """City-wide sliding totals of an append-only stream of flow rows.

    Rows more than 10 minutes behind are dropped, and a window is final once the newest
    row is 10 minutes past its end, so the result is for append mode. The kept state is a
    row per open pane and window, however many stations there are.
    """
    return totals_from_panes(pane_totals(flows.withWatermark(TIME, LATENESS)))


def start_sliding_total_job(flows: DataFrame, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Append final sliding totals to ``<root>/total_hourly_stats``, bucketed by window end."""
    tables = JobTables(flows.sparkSession, root)
    tables.require_consistent(TOTAL_HOURLY_STATS)
    writer = (
        with_bucket(stream_sliding_total(flows))
        .repartition(*BUCKET)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*BUCKET)
        .option("checkpointLocation", tables.checkpoint)
        .option("path", tables.path(TOTAL_HOURLY_STATS))
    )
    return writer.trigger(**trigger).start() if trigger else writer.start()
