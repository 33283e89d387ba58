"""Late rows put where they belong: any cut of a feed gives the totals of one batch run."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from frames import at, rows, snapshots

from pyspark.sql import functions as F

from stationflow.operators import delta_lag, hourly_tumbling, repairs, sliding_total, station_flows
from stationflow.streaming.jobs import handle_hourly_batch, kept_rows
from stationflow.streaming.tables import JobTables

HOURLY = ("start", "end", "stationId", "total_rental", "total_return")
TOTALS = ("start", "end", "total_hourly_rental", "total_hourly_return")


def run(spark, root, batches, **options):
    """Batches of (station, time, count), each row with its place in the whole feed as its tie-breaker."""
    place = 0
    for epoch, batch in enumerate(batches):
        frame = snapshots(spark, *batch).withColumn("offset", F.col("offset") + place)
        place += len(batch)
        handle_hourly_batch(frame, epoch, root, ["offset"], repair=True, **options)


def published(spark, root):
    read = lambda name, columns: rows(spark.read.parquet(f"{root}/{name}"), *columns)
    return read("hourly_summary", HOURLY), read("total_hourly_stats", TOTALS)


def one_run(spark, batches):
    flows = station_flows(snapshots(spark, *[r for b in batches for r in b]), ["offset"])
    return rows(hourly_tumbling(flows), *HOURLY), rows(sliding_total(flows), *TOTALS)


def test_a_late_row_splits_the_step_between_its_neighbours(spark, root):
    batches = [[("A", "10:00", 5), ("A", "10:30", 9)], [("A", "10:10", 1)]]
    run(spark, root, batches)
    repaired = spark.read.parquet(f"{root}/repairs/epoch=1")
    assert rows(repaired, "event_time", "prev_count", "rental", "return", "rental_before", "return_before") == [
        (at("10:10"), 5, 4, 0, 0, 0), (at("10:30"), 1, 0, 8, 0, 4)]
    assert published(spark, root) == one_run(spark, batches)
    assert rows(spark.read.parquet(f"{root}/arrivals/epoch=1"), "outcome") == [("late",)]


CASES = {
    "before the first": [[("A", "10:00", 5)], [("A", "09:00", 2), ("A", "11:00", 1)]],
    "several in a row": [[("A", "10:00", 5), ("A", "11:00", 7)], [("A", "10:10", 9), ("A", "10:20", 0), ("A", "10:50", 3), ("A", "11:30", 2)]],
    "one after the other": [[("A", "10:00", 5), ("A", "11:00", 7)], [("A", "10:30", 9)], [("A", "10:40", 1)], [("A", "10:20", 4)]],
    "in the newest one's place": [[("A", "10:00", 5), ("B", "10:00", 1)], [("A", "10:00", 9), ("A", "10:20", 3)], [("A", "10:30", 3)]],
    "in another's place": [[("A", "10:00", 5), ("A", "10:10", 6), ("A", "10:20", 7)], [("A", "10:10", 1), ("A", "10:05", 2)]],
    "sent again": [[("A", "10:00", 5), ("A", "10:10", 6)], [("A", "10:00", 5), ("A", "10:10", 6)]],
    "over midnight": [[("A", "2024-07-01 23:50", 5), ("A", "2024-07-02 00:10", 6)], [("A", "2024-07-01 23:58", 1)]],
    "long silence": [[("A", "2024-07-01 10:00", 5), ("A", "2024-07-09 10:00", 6), ("A", "2024-07-20 10:00", 8)], [("A", "2024-07-03 10:00", 1), ("A", "2024-07-20 09:00", 2)], [("A", "2024-07-08 23:59", 4)]],
    "a gap between two": [[("A", "2024-07-03 10:00", 5), ("A", "2024-07-10 10:00", 6), ("A", "2024-07-20 10:00", 8)], [("A", "2024-07-03 09:00", 1), ("A", "2024-07-20 09:00", 2)]],
    "malformed beside": [[("A", "10:00", 5), (None, "10:05", 1), ("A", "10:30", None), ("A", "10:40", 2)], [("A", "10:20", 4), ("A", None, 3), ("A", "10:25", None)]],
}


def all_cases():
    """Every case with stations of its own, batch by batch."""
    batches = [[] for _ in range(max(map(len, CASES.values())))]
    for name, case in CASES.items():
        for i, batch in enumerate(case):
            batches[i] += [(f"{name}: {s}" if s else None, t, n) for s, t, n in batch]
    return batches


def test_cuts_equal_one_run(spark, root):
    batches = all_cases()
    run(spark, root, batches)
    assert published(spark, root) == one_run(spark, batches)


def test_any_cut_equals_one_run_with_folding_and_buckets(spark, root):
    rng = random.Random(1)
    start = datetime(2024, 7, 1, 20)
    feed = [(rng.choice("ABCDEF"), str(start + timedelta(minutes=10 * rng.randrange(40))), rng.randint(0, 9)) for _ in range(160)]
    feed.sort(key=lambda r: datetime.fromisoformat(r[1]) + timedelta(minutes=rng.choice([0, 0, 0, 5, 200])))
    batches = [feed[i : i + 40] for i in range(0, len(feed), 40)]
    run(spark, root, batches, state_buckets=3, fold_after=2)
    assert published(spark, root) == one_run(spark, batches)


def test_a_repeated_epoch_changes_nothing(spark, root):
    batches = CASES["one after the other"]
    run(spark, root, batches)
    tables = ["hourly_summary", "total_hourly_stats", "hour_partials", "pane_partials", "kept", "repairs", "flows"]
    before = {t: rows(spark.read.parquet(f"{root}/{t}"), "*") for t in tables}
    frame = snapshots(spark, *batches[-1]).withColumn("offset", F.col("offset") + 4)
    handle_hourly_batch(frame, 3, root, ["offset"], repair=True)
    assert {t: rows(spark.read.parquet(f"{root}/{t}"), "*") for t in tables} == before


def test_repairs_of_many_stations_at_once(spark):
    """The operator alone: what it gives, put over the kept rows, is the lag of all rows."""
    rng = random.Random(3)
    kept, late = [], []
    for s in range(150):
        times = rng.sample(range(60), rng.randint(1, 9))
        newest = max(times)
        for t in times:
            kept.append((f"s{s}", t, rng.randint(0, 5), rng.randint(0, 3)))
        for t in rng.choices(range(newest + 1), k=rng.randint(0, 4)):
            late.append((f"s{s}", t, rng.randint(0, 5), rng.randint(0, 3)))
    best = {}
    for s, t, n, tie in late:
        best[s, t] = max(best.get((s, t), (-1, -1)), (tie, n))
    schema = "stationId string, m int, parkingBikeTotCnt int, tie int"
    timed = lambda data: spark.createDataFrame(data, schema).withColumn("event_time", F.expr("timestamp_ntz'2024-07-01' + make_dt_interval(0, 0, m)")).drop("m")
    before = delta_lag(timed(kept))
    after = repairs(timed([(s, t, n, tie) for (s, t), (tie, n) in best.items()]), before)
    all_rows = {(s, t): (tie, n) for s, t, n, tie in kept}
    for key, value in best.items():
        all_rows[key] = max(all_rows.get(key, (-1, -1)), value)
    want = delta_lag(timed([(s, t, n, tie) for (s, t), (tie, n) in all_rows.items()]))
    columns = ["stationId", "event_time", "parkingBikeTotCnt", "prev_count", "rental", "return"]
    changed = after.select("stationId", "event_time")
    result = before.join(changed, ["stationId", "event_time"], "left_anti").select(*columns).unionByName(after.select(*columns))
    assert rows(result, *columns) == rows(want, *columns)
    sums = lambda df, suffix="": df.agg(F.sum(f"rental{suffix}"), F.sum(f"return{suffix}")).first()
    moved, was, now, all_before = sums(after), sums(after, "_before"), sums(want), sums(before)
    assert [a + m - w for a, m, w in zip(all_before, moved, was)] == list(now)


def test_a_late_row_that_no_kept_one_follows_stays_aside(spark, root):
    """Rows handled before repairs were switched on aren't kept: what would need them is set aside, as without repairs."""
    handle_hourly_batch(snapshots(spark, ("A", "10:00", 5), ("A", "10:30", 9)), 0, root, ["offset"])
    handle_hourly_batch(snapshots(spark, ("A", "10:10", 1), ("A", "10:40", 2)), 1, root, ["offset"], repair=True)
    assert published(spark, root)[0] == [(at("10:00"), at("11:00"), "A", 7, 4)]


def test_repairs_read_the_late_rows_days_only(spark, root, monkeypatch):
    from stationflow.streaming.parts import DayParts

    batches = [[("A", f"2024-07-{d:02d} 10:{m}", d) for d in range(1, 28) for m in (10, 40)], [("A", "2024-07-20 10:20", 4)]]
    read = []
    plain = DayParts.read
    monkeypatch.setattr(DayParts, "read", lambda self, epoch, days: read.append((self.parts.path.rsplit("/")[-1], list(days))) or plain(self, epoch, days))
    run(spark, root, batches)
    days = [d for name, d in read if name == "kept"]
    assert [[x.day for x in d] for d in days] == [[20, 21]]
    assert len(kept_rows(JobTables(spark, root), spark.read.parquet(f"{root}/flows/epoch=0").schema).days()) == 27
