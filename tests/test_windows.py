from __future__ import annotations

from collections import Counter
from datetime import timedelta

from frames import at, rows
from pyspark.sql import functions as F

from stationflow.operators import (
    current_hour,
    hourly_truncated,
    hourly_tumbling,
    ordered_preview,
    sliding_station,
    sliding_total,
    total_by_window,
)

from stationflow.sinks import with_bucket


def flows(spark, *data, time_type="timestamp_ntz"):
    data = [(s, at(t) if t else None, rental, ret) for s, t, rental, ret in data]
    schema = f"stationId string, event_time {time_type}, rental int, `return` int"
    return spark.createDataFrame(data, schema)


EDGES = [("A", "10:00:00", 1, 0), ("A", "10:59:59", 2, 5), ("A", "11:00:00", 4, 0), ("B", "10:00:00", 8, 8)]
HOURS = [
    (at("10:00"), at("11:00"), "A", 3, 5),
    (at("10:00"), at("11:00"), "B", 8, 8),
    (at("11:00"), at("12:00"), "A", 4, 0),
]
COLUMNS = ("start", "end", "stationId", "total_rental", "total_return")


def test_hour_edges(spark):
    df = flows(spark, *EDGES)
    assert rows(hourly_tumbling(df), *COLUMNS) == HOURS
    assert rows(hourly_truncated(df), *COLUMNS) == HOURS


def test_hours_of_zoned_time(spark):
    df = flows(spark, *EDGES, time_type="timestamp")
    for hourly in (hourly_tumbling, hourly_truncated):
        got = hourly(df)
        assert dict(got.dtypes)["start"] == "timestamp"
        zoneless = got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
        assert rows(zoneless, *COLUMNS) == HOURS


def test_zoneless_hours_ignore_the_session_zone(spark):
    # 02:30 does not exist on this day in the session's zone.
    df = flows(spark, ("A", "2024-03-10 02:30:00", 1, 0), ("A", "2024-03-10 03:30:00", 2, 0))
    expected = [(at("2024-03-10 02:00"), at("2024-03-10 03:00"), "A", 1, 0),
                (at("2024-03-10 03:00"), at("2024-03-10 04:00"), "A", 2, 0)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(hourly_truncated(df), *COLUMNS) == expected
        bucketed = with_bucket(hourly_tumbling(df), "start")
        assert rows(bucketed, "start", "end", "stationId", "total_rental", "total_return") == expected
        assert rows(bucketed, "day", "hour") == [("10", "02"), ("10", "03")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows_without_time_fall_in_no_hour(spark):
    df = flows(spark, ("A", None, 1, 1), ("A", "10:00", 2, 2))
    assert hourly_tumbling(df).count() == hourly_truncated(df).count() == 1


def test_current_hour_is_that_of_as_of(spark):
    as_of = F.lit("2024-07-01 10:30:00").cast("timestamp_ntz")
    assert rows(current_hour(flows(spark, *EDGES), as_of), *COLUMNS) == HOURS[:2]
    assert current_hour(flows(spark, *EDGES), as_of + F.expr("INTERVAL 2 HOURS")).count() == 0


def test_a_row_is_in_twelve_sliding_windows(spark):
    got = sliding_station(flows(spark, ("A", "10:07:00", 3, 1))).orderBy("start").collect()
    assert [r.start for r in got] == [at("09:10") + timedelta(minutes=5 * i) for i in range(12)]
    assert {(r.end - r.start, r.hourly_rental, r.hourly_return) for r in got} == {(timedelta(hours=1), 3, 1)}


def test_sliding_windows_are_those_of_rows_added_up_one_by_one(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    days = ["2024-03-10", "1969-12-31", "2024-11-03"]
    data = [(["A", "B", None][i % 3], f"{days[i % 7 % 3]} {i * i % 4:02}:{(17 * i) % 60:02}:{(11 * i) % 60:02}", i % 5 or None, i % 4) for i in range(300)]
    data += [("C", None, 1, 1), ("D", "10:55:00", None, 2), ("D", "11:54:59", None, None), ("D", "11:55:00", 4, None)]
    for time_type in ("timestamp_ntz", "timestamp"):
        df = flows(session, *data, time_type=time_type)
        sums = [F.sum("rental").alias("hourly_rental"), F.sum("return").alias("hourly_return")]
        plain = df.groupBy(F.window("event_time", "1 hour", "5 minutes").alias("w"), "stationId").agg(*sums).select("w.start", "w.end", "stationId", "hourly_rental", "hourly_return")
        got = sliding_station(df)
        assert got.dtypes == plain.dtypes
        assert rows(got, *plain.columns) == rows(plain, *plain.columns)


def test_sliding_total_by_brute_force_and_in_two_levels(spark):
    data = [("AB"[i % 2], f"1{i % 3}:{(7 * i) % 60:02}:{(11 * i) % 60:02}", i % 5, i % 4) for i in range(60)]
    df = flows(spark, *data)
    expected = Counter()
    for _, t, rental, ret in data:
        pane = at(t) - timedelta(minutes=at(t).minute % 5, seconds=at(t).second)
        for i in range(12):
            expected[pane - timedelta(minutes=5 * i), "rental"] += rental
            expected[pane - timedelta(minutes=5 * i), "return"] += ret
    columns = ("start", "end", "total_hourly_rental", "total_hourly_return")
    got = rows(sliding_total(df), *columns)
    assert got == sorted(
        ((s, s + timedelta(hours=1), expected[s, "rental"], expected[s, "return"])
         for s in {s for s, _ in expected}), key=str)
    assert rows(total_by_window(sliding_station(df)), *columns) == got


def test_ordered_preview(spark):
    got = ordered_preview(hourly_tumbling(flows(spark, *EDGES)), ["start", "stationId"], 2)
    assert [(r.start, r.stationId) for r in got.collect()] == [(at("10:00"), "A"), (at("10:00"), "B")]
