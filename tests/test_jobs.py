"""Streaming jobs: equal to batch, safe to repeat, and free of the usual defects."""

from __future__ import annotations

import json
import os

import pytest
from frames import at, rows, snapshots

from stationflow.functions import parse_snapshots
from stationflow.operators import delta_lag, hourly_tumbling, latest_by, sliding_total, station_flows
from stationflow.sources import read_envelopes
from stationflow.streaming import (
    JobTables,
    VersionedTable,
    start_hourly_job,
    start_latest_job,
    start_sliding_total_job,
)
from stationflow.streaming.jobs import Partials, handle_hourly_batch, handle_latest_batch
from pyspark.sql import functions as F

ONCE = {"availableNow": True}
HOURLY = ("start", "end", "stationId", "total_rental", "total_return")
TOTALS = ("start", "end", "total_hourly_rental", "total_hourly_return")

DAY = [
    ("A", "09:50", 5), ("B", "09:55", 8), ("A", "10:10", 2), ("B", "10:20", 8), ("C", "10:30", 0),
    ("A", "10:40", 6), ("C", "10:50", 3), ("A", "11:00", 6), ("B", "11:10", 1), ("C", "23:59", 9),
    ("A", "2024-07-02 00:04", 0), ("C", "2024-07-02 00:10", 2), ("A", "2024-07-02 00:30", 5),
]


def result(spark, root, name, columns):
    df = spark.read.parquet(f"{root}/{name}")
    return rows(df, *columns)


def expected(spark, data):
    flows = delta_lag(snapshots(spark, *data))
    return rows(hourly_tumbling(flows), *HOURLY), rows(sliding_total(flows), *TOTALS)


def published(spark, root):
    return (result(spark, root, "hourly_summary", HOURLY),
            result(spark, root, "total_hourly_stats", TOTALS))


def everything(spark, root):
    """All tables of a job, to compare before and after a repeat."""
    tables = ["hourly_summary", "total_hourly_stats", "hour_partials", "pane_partials", "arrivals", "flows", "metrics"]
    found = {t: rows(spark.read.parquet(f"{root}/{t}"), "*") for t in tables}
    return found | {"state": rows(spark.read.parquet(f"{root}/state"), "*")}


def run_batches(spark, root, batches):
    for epoch, batch in enumerate(batches):
        handle_hourly_batch(snapshots(spark, *batch), epoch, root, ["offset"])


def test_batches_equal_one_batch_run_and_a_repeat_changes_nothing(spark, root):
    batches = [DAY[:5], DAY[5:9], DAY[9:]]  # hour 10 is split over two of them
    run_batches(spark, root, batches)
    assert published(spark, root) == expected(spark, DAY)
    before = everything(spark, root)
    handle_hourly_batch(snapshots(spark, *batches[-1]), 2, root, ["offset"])
    assert everything(spark, root) == before


def test_repeat_after_a_crash_between_tables(spark, root, monkeypatch):
    from stationflow.streaming import jobs

    run_batches(spark, root, [DAY[:5]])
    with monkeypatch.context() as patch:
        def fail(*_):
            raise OSError("disk")
        patch.setattr(jobs, "_update_hours", fail)
        with pytest.raises(OSError):  # not swallowed
            handle_hourly_batch(snapshots(spark, *DAY[5:]), 1, root, ["offset"])
    handle_hourly_batch(snapshots(spark, *DAY[5:]), 1, root, ["offset"])
    assert published(spark, root) == expected(spark, DAY)


def test_absent_station_stays_and_empty_station_counts(spark, root):
    run_batches(spark, root, [[("A", "10:00", 0), ("B", "10:00", 4), ("C", "10:00", 1)],
                              [("B", "10:10", 4), ("A", "10:20", 7)]])
    table = VersionedTable(spark, f"{root}/state", spark.read.parquet(f"{root}/state/epoch=1").schema)
    assert rows(table.load(), "stationId", "previous_parkingBikeTotCnt") == [("A", 7), ("B", 4), ("C", 1)]
    assert (at("10:00"), at("11:00"), "A", 0, 7) in result(spark, root, "hourly_summary", HOURLY)


def test_late_malformed_and_copied_rows(spark, root):
    run_batches(spark, root, [
        [("A", "10:00", 5), ("A", "10:30", 11), ("A", "10:30", 9), ("A", "10:30", 9)],
        [("A", "10:10", 1), ("A", "10:30", 2), ("A", "10:40", 8), (None, "10:41", 3), ("A", None, 3),
         ("A", "10:42", None)],
    ])
    late = spark.read.parquet(f"{root}/arrivals/epoch=1/outcome=late")
    assert rows(late, "event_time", "parkingBikeTotCnt") == [(at("10:10"), 1), (at("10:30"), 2)]
    flows = spark.read.parquet(f"{root}/flows/epoch=1")
    assert rows(flows, "event_time", "prev_count", "rental") == [(at("10:40"), 9, 1)]
    assert rows(spark.read.parquet(f"{root}/malformed/epoch=1"), "offset") == [(3,), (4,), (5,)]
    assert result(spark, root, "hourly_summary", HOURLY) == [(at("10:00"), at("11:00"), "A", 1, 4)]
    metrics = spark.read.parquet(f"{root}/metrics/epoch=1").first().asDict()
    assert metrics == {"total": 6, "parsed": 3, "malformed": 3}


def test_batches_without_flow_rows_change_nothing(spark, root):
    empty, malformed = snapshots(spark), snapshots(spark, (None, "10:00", 5))
    for epoch, batch in enumerate([empty, malformed]):
        handle_hourly_batch(batch, epoch, root)
    assert os.path.exists(f"{root}/state/epoch=0") and not os.path.exists(f"{root}/hourly_summary")
    handle_hourly_batch(snapshots(spark, ("A", "10:00", 5)), 2, root)
    handle_hourly_batch(empty, 3, root)
    handle_hourly_batch(snapshots(spark, ("A", "10:10", 3)), 4, root)
    assert result(spark, root, "hourly_summary", HOURLY) == [(at("10:00"), at("11:00"), "A", 2, 0)]


def write_feed(folder, batches):
    """One text file of JSON documents per batch, older files first."""
    os.makedirs(folder, exist_ok=True)
    for i, batch in enumerate(batches):
        path = f"{folder}/{i}.txt"
        with open(path, "w") as f:
            for station, time, count in batch:
                doc = {"stationId": station, "parkingBikeTotCnt": count, "stationName": "x",
                       "timestamp": at(time).strftime("%Y-%m-%d %H:%M:%S")}
                f.write(json.dumps(doc) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def feed(spark, folder):
    return parse_snapshots(read_envelopes(spark, "text", folder, options={"maxFilesPerTrigger": "1"}))


def zoneless(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def test_hourly_job_end_to_end_with_a_restart(spark, root):
    write_feed(f"{root}/feed", [DAY[:4], DAY[4:8]])
    job = f"{root}/job"
    start_hourly_job(feed(spark, f"{root}/feed"), job, trigger=ONCE).awaitTermination()
    write_feed(f"{root}/feed", [DAY[:4], DAY[4:8], DAY[8:]])
    start_hourly_job(feed(spark, f"{root}/feed"), job, trigger=ONCE).awaitTermination()
    hourly, totals = expected(spark, DAY)
    assert rows(zoneless(spark.read.parquet(f"{job}/hourly_summary")), *HOURLY) == hourly
    assert rows(zoneless(spark.read.parquet(f"{job}/total_hourly_stats")), *TOTALS) == totals


def test_job_refuses_tables_without_their_checkpoint(spark, root):
    write_feed(f"{root}/feed", [DAY[:4]])
    os.makedirs(f"{root}/job/state/epoch=0")
    with pytest.raises(ValueError, match="no checkpoint"):
        start_hourly_job(feed(spark, f"{root}/feed"), f"{root}/job", trigger=ONCE)


def test_job_refuses_a_checkpoint_without_its_tables(spark, root):
    os.makedirs(f"{root}/job/checkpoint/commits")
    with open(f"{root}/job/checkpoint/commits/0", "w"):
        pass
    with pytest.raises(ValueError, match="no state"):
        JobTables(spark, f"{root}/job").require_consistent()


def test_latest_job_end_to_end(spark, root):
    batches = [DAY[:6], DAY[6:]]
    write_feed(f"{root}/feed", batches)
    stream = feed(spark, f"{root}/feed")
    start_latest_job(stream, f"{root}/job", trigger=ONCE).awaitTermination()
    table = VersionedTable(spark, f"{root}/job/latest", stream.schema)
    assert table.load().columns == stream.columns
    want = latest_by(snapshots(spark, *DAY), ["stationId"], ["event_time"])
    assert rows(table.load(), "stationId", "parkingBikeTotCnt") == rows(want, "stationId", "parkingBikeTotCnt")
    metrics = spark.read.parquet(f"{root}/job/metrics")
    assert metrics.agg(F.sum("total")).first()[0] == len(DAY)


def test_latest_batch_twice_and_out_of_order(spark, root):
    batches = [[("A", "10:00", 5), ("A", "10:30", 9), (None, "11:00", 1)], [("A", "10:10", 1), ("B", "10:00", 2)], []]
    for epoch, batch in enumerate(batches):
        for _ in range(2):
            handle_latest_batch(snapshots(spark, *batch), epoch, root)
    table = VersionedTable(spark, f"{root}/latest", snapshots(spark).schema)
    assert rows(table.load(), "stationId", "parkingBikeTotCnt") == [("A", 9), ("B", 2)]


def test_versioned_table(spark, root):
    table = VersionedTable(spark, f"{root}/t", spark.range(1).schema)
    assert table.load().collect() == []
    for epoch in (0, 3, 4, 7):
        table.save(spark.range(epoch, epoch + 1), epoch)
    assert table.versions() == [3, 4, 7]  # the oldest is gone
    assert [r.id for r in table.load(before=7).collect()] == [4]
    os.remove(f"{root}/t/epoch=7/_SUCCESS")  # an unfinished write does not count
    assert [r.id for r in table.load().collect()] == [4]


def test_damaged_state_raises_instead_of_reading_as_empty(spark, root):
    table = VersionedTable(spark, f"{root}/t", spark.range(1).schema)
    table.save(spark.range(5).coalesce(1), 0)
    part = next(f for f in os.listdir(f"{root}/t/epoch=0") if f.startswith("part-"))
    with open(f"{root}/t/epoch=0/{part}", "w") as f:
        f.write("junk")
    os.remove(f"{root}/t/epoch=0/.{part}.crc")
    with pytest.raises(Exception):
        table.load().collect()


def flow_rows(spark, *data):
    data = [(at(t), rental, ret) for t, rental, ret in data]
    df = spark.createDataFrame(data, "event_time timestamp_ntz, rental int, `return` int")
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_watermarked_totals_drop_late_rows_and_hold_back_open_windows(spark, root):
    # Rows are held against the watermark of the batch before the last.
    feeds = [[("10:02", 1, 0), ("11:30", 0, 2)], [("11:25", 3, 0)], [("10:05", 50, 50)], [("13:00", 0, 0)]]
    for i, data in enumerate(feeds):
        flow_rows(spark, *data).coalesce(1).write.parquet(f"{root}/feed/{i}")
        for folder, _, files in os.walk(f"{root}/feed/{i}"):
            for f in files:
                os.utime(f"{folder}/{f}", (1_700_000_000 + i, 1_700_000_000 + i))
    schema = flow_rows(spark).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/feed/*")
    start_sliding_total_job(stream, f"{root}/job", trigger=ONCE).awaitTermination()
    got = rows(zoneless(spark.read.parquet(f"{root}/job/total_hourly_stats")), *TOTALS)
    kept = flow_rows(spark, ("10:02", 1, 0), ("11:30", 0, 2), ("11:25", 3, 0), ("13:00", 0, 0))
    final = sliding_total(kept).filter(F.col("end") <= F.lit("2024-07-01 12:50:00").cast("timestamp"))
    assert got == rows(zoneless(final), *TOTALS)


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "Asia/Kathmandu", "UTC"])
def test_hours_of_half_hour_zones_are_all_published(spark, root, zone):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    data = [("A", "00:10", 9), ("A", "00:20", 4), ("A", "00:50", 4), ("A", "2024-07-02 00:05", 1), ("B", "1970-01-03 00:10", 7)]

    def zoned(rows):
        return snapshots(session, *rows).withColumn("event_time", F.col("event_time").cast("timestamp"))

    for epoch, batch in enumerate([data[:3], data[3:]]):
        handle_hourly_batch(zoned(batch), epoch, root, ["offset"])
    want = hourly_tumbling(delta_lag(zoned(data)))
    assert rows(session.read.parquet(f"{root}/hourly_summary"), *HOURLY) == rows(want, *HOURLY)
    totals = sliding_total(delta_lag(zoned(data)))
    assert rows(session.read.parquet(f"{root}/total_hourly_stats"), *TOTALS) == rows(totals, *TOTALS)


def test_a_stray_day_reads_itself_and_no_range(spark, root, monkeypatch):
    read = []
    plain = Partials.read
    monkeypatch.setattr(Partials, "read", lambda self, epoch, days: read.append(sorted(set(days))) or plain(self, epoch, days))
    run_batches(spark, root, [DAY[:6], [("Z", "1970-01-05 10:00", 3), ("A", "10:50", 5)]])
    assert [d.isoformat() for d in read[2]] == ["1970-01-05", "2024-07-01"]
    assert len(read[3]) == 6


def test_backfill_equals_the_job_on_broken_rows(spark, root):
    data = [("A", "10:00", 9), ("A", "10:10", None), ("A", "10:20", 4), (None, "10:25", 1), ("A", "10:30", 8),
            ("A", "10:30", 6), ("A", None, 2), ("B", "10:40", 3), ("B", "10:40", 3)]
    run_batches(spark, root, [data])
    flows = station_flows(snapshots(spark, *data), ["offset"])
    assert published(spark, root) == (rows(hourly_tumbling(flows), *HOURLY), rows(sliding_total(flows), *TOTALS))
    assert ("A", 5, 2) in [(r[2], r[3], r[4]) for r in published(spark, root)[0]]


def test_latest_job_hands_the_newest_rows_to_its_sink(spark, root):
    got = []

    def sink(newest, epoch):
        got.append((epoch, rows(newest, "stationId", "parkingBikeTotCnt")))

    for epoch, batch in enumerate([[("A", "10:00", 5), ("B", "10:00", 2)], [("A", "09:00", 1), ("C", "10:00", 7)]]):
        handle_latest_batch(snapshots(spark, *batch), epoch, root, sink=sink)
    assert got == [(0, [("A", 5), ("B", 2)]), (1, [("A", 5), ("C", 7)])]


def test_sliding_job_refuses_an_old_output_without_its_checkpoint(spark, root):
    os.makedirs(f"{root}/job/total_hourly_stats/year=2024")
    flows = spark.readStream.schema("event_time timestamp, rental int, return int").parquet(root)
    with pytest.raises(ValueError, match="no checkpoint"):
        start_sliding_total_job(flows, f"{root}/job", trigger=ONCE)


def test_a_batch_is_read_once_besides_the_look_whether_it_has_rows(spark, root):
    """What buckets it touches, what is malformed and what arrived are told by the same kept rows."""
    read = spark.sparkContext.accumulator(0)
    frame = snapshots(spark, *[(f"S{i % 7}", f"10:{i % 60:02}", i % 9) for i in range(50)], (None, "10:00", 1))
    log = frame.rdd.coalesce(1).map(lambda r: read.add(1) or r)
    handle_hourly_batch(spark.createDataFrame(log, frame.schema), 0, root, ["offset"], repair=True, state_buckets=2)
    assert read.value <= 2 * 51
    assert spark.read.parquet(f"{root}/arrivals").count() == 50 and spark.read.parquet(f"{root}/metrics").first()["total"] == 51
