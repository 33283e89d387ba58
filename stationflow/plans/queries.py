"""Every operator as a query over the driver's tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.functions import parse_snapshots, split_malformed
from stationflow.operators import (
    batch_metrics,
    current_hour,
    dedupe_snapshots,
    delta_lag,
    delta_vs_state,
    flows_of_hour,
    hourly_truncated,
    hourly_tumbling,
    late_snapshots,
    latest_by,
    next_state,
    ordered_preview,
    sliding_station,
    sliding_total,
    station_flows,
    total_by_window,
    upsert_latest,
)
from stationflow.plans.scratch import scratch_folder, writing_session
from stationflow.plans.snapshots import TIES, as_envelopes, broken_envelopes, crowded, polluted, redelivered, snapshots
from stationflow.schema import COUNT, STATION, TIME, state_schema
from stationflow.sinks import BUCKET, HOURLY_SUMMARY, TOTAL_HOURLY_STATS, write_bucketed
from stationflow.sources import read_envelopes
from stationflow.streaming import (
    ROCKSDB,
    JobTables,
    VersionedTable,
    seed_hourly_job,
    start_hourly_job,
    start_keyed_hourly_job,
    start_latest_job,
    start_sliding_total_job,
)
from stationflow.streaming.jobs import latest_table

#: Snapshots before this instant stand for what earlier batches left behind.
CUT = "2024-01-16 00:00:00"

#: "Now" of the current-hour report.
AS_OF = "2024-01-15 10:30:00"

ONCE = {"availableNow": True}

#: Where the feed of the streaming queries is cut into parts, one a micro-batch.
PARTS = ["2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-23 00:00:00"]
LATE_BEFORE = "2024-01-03 00:00:00"


def _instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _around_cut(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(state left by everything before the cut, the batch after it)"""
    rows = snapshots(spark, sf_dir)
    is_before = F.col(TIME) < _instant(CUT)
    return next_state(None, rows.filter(is_before), TIES), rows.filter(~is_before)


def _old_of_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of even stations the rows after the cut, of odd ones those of the first days once more."""
    rows, even = snapshots(spark, sf_dir), F.col(STATION).cast("long") % 2 == 0
    return rows.filter((even & (F.col(TIME) >= _instant(CUT))) | (~even & (F.col(TIME) < _instant(LATE_BEFORE))))


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lag(snapshots(spark, sf_dir), TIES)


def _parts(rows: DataFrame, time: str) -> list[DataFrame]:
    """Rows cut at the instants of PARTS; those without a time come first."""
    edges = [None, *PARTS, None]
    out = []
    for low, high in zip(edges, edges[1:]):
        after = F.col(time).isNull() if low is None else F.lit(False)
        inside = F.lit(True) if low is None else F.col(time) >= _instant(low)
        out.append(rows.filter(after | (inside if high is None else inside & (F.col(time) < _instant(high)))))
    return out


def _deliver(parts: list[DataFrame], folder: str, start: Callable[[], StreamingQuery]) -> None:
    """Add the parts to the feed one after the other, each as the files that Spark makes of it, and let the job handle each: a
    micro-batch a part, and a restart between them."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        start().awaitTermination()


def _late(rows: DataFrame) -> Column:
    """The first days of every tenth station."""
    return F.coalesce((F.col("user_id") % 10 == 0) & (F.col("ts") < _instant(LATE_BEFORE)), F.lit(False))


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a log's archive would have them, with their own time and station besides."""
    rows = as_envelopes(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts", "user_id")
    return rows.select("value", F.lit("events").alias("topic"), F.lit(0).alias("partition"), "offset", "ts", "user_id")


def _feed(spark: SparkSession, sf_dir: str, again: bool = False, late: bool = False) -> list[DataFrame]:
    """The parts of the feed. With `again`, the last one also has the first days of every tenth station once more; with
    `late`, it has them instead of the first."""
    rows = _envelopes(spark, sf_dir)
    parts = _parts(rows.filter(~_late(rows)) if late else rows, "ts")
    if again or late:
        parts[-1] = parts[-1].unionByName(rows.filter(_late(rows)))
    return parts


def _snapshots_of(spark: SparkSession, folder: str, streaming: bool = True) -> DataFrame:
    parsed = parse_snapshots(read_envelopes(spark, "parquet", folder, streaming, position=True))
    return parsed.select("offset", STATION, COUNT, F.col(TIME).cast("timestamp_ntz").alias(TIME))


def _mixed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed polluted with prose: every event as JSON, and every document as it is."""
    events = as_envelopes(spark.read.parquet(f"{sf_dir}/events.parquet"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prose = documents.select(F.col("doc_id").alias("offset"), F.col("text").alias("value"))
    return events.withColumn("topic", F.lit("events")).unionByName(
        prose.withColumn("topic", F.lit("documents"))
    )


def q_parse_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_snapshots(as_envelopes(spark.read.parquet(f"{sf_dir}/events.parquet")))
    return parsed.withColumn(TIME, F.col(TIME).cast("timestamp_ntz"))


def q_parse_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_parse_snapshots(spark, sf_dir).select("offset", STATION, COUNT, TIME)


def q_split_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose among the documents, and events whose count or time can't be read, with what each lacks."""
    events = broken_envelopes(spark.read.parquet(f"{sf_dir}/events.parquet")).withColumn("topic", F.lit("events"))
    mixed = events.unionByName(_mixed_envelopes(spark, sf_dir).filter("topic = 'documents'"))
    _, malformed = split_malformed(parse_snapshots(mixed, evidence=True))
    return malformed.select("topic", "offset", "reason", F.octet_length("value").cast("long").alias("n_bytes"))


def q_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_metrics(parse_snapshots(_mixed_envelopes(spark, sf_dir)))


def q_dedupe_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_snapshots(redelivered(snapshots(spark, sf_dir)), TIES).select(STATION, TIME, COUNT)


def q_delta_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flows(spark, sf_dir)


def q_delta_lag_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag where one station has two rows of three."""
    return delta_lag(crowded(snapshots(spark, sf_dir)), TIES)


def q_backfill_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of a feed with copies and broken rows, as the hourly job would make them."""
    return hourly_tumbling(station_flows(polluted(snapshots(spark, sf_dir)), TIES))


def q_delta_state_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, batch = _around_cut(spark, sf_dir)
    return delta_vs_state(batch, state)


def q_delta_state_join_known_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, batch = _around_cut(spark, sf_dir)
    return delta_vs_state(batch, state, zero_prev_is_unknown=False)


def q_next_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which odd stations only have old rows, so that their state wins."""
    state, _ = _around_cut(spark, sf_dir)
    return next_state(state, _old_of_odd(spark, sf_dir), TIES)


def q_state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written as a version, read back by the next epoch, and moved on."""
    state, batch = _around_cut(spark, sf_dir)
    schema = state_schema(batch.schema[TIME].dataType)
    table = VersionedTable(spark, scratch_folder(spark, "state"), schema)
    table.save(state, 0)
    table.save(next_state(table.load(before=1), batch, TIES), 1)
    return table.load()


def q_late_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table arriving again once the state at the cut is known."""
    state, _ = _around_cut(spark, sf_dir)
    return late_snapshots(snapshots(spark, sf_dir), state)


def q_latest_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(snapshots(spark, sf_dir), [STATION], [TIME, *TIES])


def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir)
    order = [TIME, *TIES]
    current = latest_by(rows.filter(F.col(TIME) < _instant(CUT)), [STATION], order)
    return upsert_latest(current, _old_of_odd(spark, sf_dir), [STATION], order)


def q_hourly_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_tumbling(_flows(spark, sf_dir))


def q_hourly_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_truncated(_flows(spark, sf_dir))


def q_hourly_vs_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, batch = _around_cut(spark, sf_dir)
    return hourly_tumbling(delta_vs_state(batch, state))


def q_current_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = flows_of_hour(snapshots(spark, sf_dir), _instant(AS_OF), TIES)
    return current_hour(flows, _instant(AS_OF))


def q_sliding_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_station(_flows(spark, sf_dir))


def q_sliding_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_total(_flows(spark, sf_dir))


def q_sliding_total_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_by_window(sliding_station(_flows(spark, sf_dir)))


def q_ordered_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered_preview(q_hourly_tumbling(spark, sf_dir), ["start", STATION])


def _read_bucketed(spark: SparkSession, root: str, schema) -> DataFrame:
    for part in BUCKET:
        schema = schema.add(part, "string")
    return spark.read.schema(schema).parquet(root)


def q_partitioned_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = writing_session(spark)
    hourly = q_hourly_tumbling(spark, sf_dir)
    root = scratch_folder(spark, HOURLY_SUMMARY)
    write_bucketed(hourly, root)
    return _read_bucketed(spark, root, hourly.schema)


def q_partitioned_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = writing_session(spark)
    totals = q_sliding_total(spark, sf_dir)
    root = scratch_folder(spark, TOTAL_HOURLY_STATS)
    write_bucketed(totals, root)
    return _read_bucketed(spark, root, totals.schema)


def _run_hourly_job(spark: SparkSession, sf_dir: str, again: bool = False, late: bool = False, **options) -> JobTables:
    root = scratch_folder(spark, "hourly-job")
    tables = JobTables(spark, f"{root}/job")

    def start() -> StreamingQuery:
        return start_hourly_job(_snapshots_of(spark, f"{root}/feed"), tables.root.path, ["offset"], trigger=ONCE, **options)

    _deliver(_feed(spark, sf_dir, again, late), f"{root}/feed", start)
    return tables


def _published_hours(spark: SparkSession, sf_dir: str, tables: JobTables) -> DataFrame:
    schema = hourly_tumbling(_flows(spark, sf_dir)).schema
    return _read_bucketed(spark, tables.path(HOURLY_SUMMARY), schema).drop(*BUCKET)


def q_stream_hourly_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = writing_session(spark)
    return _published_hours(spark, sf_dir, _run_hourly_job(spark, sf_dir))


def q_stream_hourly_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = writing_session(spark)
    tables = _run_hourly_job(spark, sf_dir)
    schema = sliding_total(_flows(spark, sf_dir)).schema
    return _read_bucketed(spark, tables.path(TOTAL_HOURLY_STATS), schema).drop(*BUCKET)


def q_stream_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of a feed whose last part brings the first days of some stations, which are put where they belong."""
    spark = writing_session(spark)
    return _published_hours(spark, sf_dir, _run_hourly_job(spark, sf_dir, late=True, repair=True, state_buckets=16, fold_after=2))


def q_stream_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals with the state of each station in Spark's own store."""
    spark = writing_session(spark)
    for name, value in ROCKSDB.items():
        spark.conf.set(name, value)
    root = scratch_folder(spark, "keyed-job")
    tables = JobTables(spark, f"{root}/job")
    start = lambda: start_keyed_hourly_job(_snapshots_of(spark, f"{root}/feed"), tables.root.path, ["offset"], ONCE)
    _deliver(_feed(spark, sf_dir), f"{root}/feed", start)
    return _published_hours(spark, sf_dir, tables)


def q_stream_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of a back-fill of the first half of the feed and a stream of the rest."""
    spark = writing_session(spark)
    root = scratch_folder(spark, "handover")
    tables = JobTables(spark, f"{root}/job")
    parts = _feed(spark, sf_dir)
    for part in parts[:2]:
        part.write.mode("append").parquet(f"{root}/archive")
    seed_hourly_job(_snapshots_of(spark, f"{root}/archive", streaming=False), tables.root.path, ["offset"])
    start = lambda: start_hourly_job(_snapshots_of(spark, f"{root}/feed"), tables.root.path, ["offset"], trigger=ONCE)
    _deliver(parts[2:], f"{root}/feed", start)
    return _published_hours(spark, sf_dir, tables)


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the hourly job sets aside of a feed whose last part repeats the first days of some stations."""
    spark = writing_session(spark)
    tables = _run_hourly_job(spark, sf_dir, again=True)
    schema = f"{STATION} string, {TIME} timestamp_ntz, {COUNT} int, outcome string, epoch long"
    arrivals = spark.read.schema(schema).parquet(tables.path("arrivals"))
    return arrivals.filter("outcome = 'late'").select("epoch", STATION, TIME, COUNT)


def q_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = writing_session(spark)
    root = scratch_folder(spark, "latest-job")
    stream = lambda: _snapshots_of(spark, f"{root}/feed")
    start = lambda: start_latest_job(stream(), f"{root}/job", order=[TIME, "offset"], trigger=ONCE, buckets=8)
    _deliver(_feed(spark, sf_dir, again=True), f"{root}/feed", start)
    return latest_table(JobTables(spark, f"{root}/job"), stream().schema, buckets=8).load()


def q_stream_sliding_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermarked totals over an append-only table of flow rows, in several micro-batches."""
    # A watermark needs zoned time; read as UTC, the windows fall on the same hours.
    spark = writing_session(spark)
    root = scratch_folder(spark, "sliding-job")
    flows = _flows(spark, sf_dir).select(TIME, "rental", "return")
    zoned = [F.col(TIME).cast("timestamp").alias(TIME), "rental", "return"]

    def start() -> StreamingQuery:
        stream = spark.readStream.schema(flows.schema).parquet(f"{root}/flows")
        return start_sliding_total_job(stream.select(*zoned), f"{root}/job", trigger=ONCE)

    _deliver(_parts(flows, TIME), f"{root}/flows", start)
    totals = _read_bucketed(spark, f"{root}/job/{TOTAL_HOURLY_STATS}", sliding_total(flows.select(*zoned)).schema)
    zoneless = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")]
    return totals.select(*zoneless, "total_hourly_rental", "total_hourly_return")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name.removeprefix("q_"): query for name, query in list(globals().items()) if name.startswith("q_")
}
