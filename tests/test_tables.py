"""Tables that a job keeps: folded parts and buckets."""

from __future__ import annotations

import os
from datetime import date

from frames import rows, snapshots

from pyspark.sql import functions as F

from stationflow.operators import latest_by
from stationflow.streaming.jobs import handle_latest_batch, latest_table
from stationflow.streaming.parts import DayParts
from stationflow.streaming.tables import BucketedTable, JobTables

DAY = date(2024, 7, 1)
SCHEMA = "k string, at timestamp_ntz, n long"


def parts_table(spark, root):
    fold = lambda df: df.groupBy("k", "at").agg(F.sum("n").alias("n"))
    return DayParts(JobTables(spark, root), "sums", spark.createDataFrame([], SCHEMA).schema, fold)


def some(spark, n, day="2024-07-01"):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(f"{day} 10:00:00").cast("timestamp_ntz").alias("at"), F.lit(1).cast("long").alias("n")).coalesce(1)


def total(table, epoch):
    return table.read(epoch, [DAY]).agg(F.sum("n")).first()[0]


def test_a_day_of_a_thousand_epochs_is_read_as_few_parts(spark, root):
    table = parts_table(spark, root)
    many = spark.range(1000).select(F.lit("a").alias("k"), F.lit("2024-07-01 09:00:00").cast("timestamp_ntz").alias("at"), F.lit(1).cast("long").alias("n"), F.lit("2024-07-01").alias("event_date"), F.col("id").alias("epoch"))
    many.repartition(1).write.partitionBy("event_date", "epoch").parquet(table.parts.path)
    table.write(some(spark, 3), 1000, "at")
    assert len(table.paths(1000, [DAY])[0]) == 1001 and total(table, 1000) == 1003
    table.fold(1000, [DAY], after=32)
    assert [len(x) for x in table.paths(1000, [DAY])] == [1, 1] and total(table, 1000) == 1003
    table.write(some(spark, 3), 1000, "at")  # handled again
    table.fold(1000, [DAY], after=32)
    assert total(table, 1000) == 1003 and total(table, 999) == 1000
    assert sorted(os.listdir(f"{table.parts.path}/event_date=2024-07-01")) == ["epoch=1000"]


def test_folding_goes_on_and_survives_a_crash(spark, root):
    table = parts_table(spark, root)
    most = 0
    for epoch in range(9):
        table.write(some(spark, 2).unionByName(some(spark, 1, "2024-07-02")), epoch, "at")
        table.fold(epoch, [DAY], after=2)
        most = max(most, sum(map(len, table.paths(epoch, [DAY]))))
        assert total(table, epoch) == 2 * (epoch + 1)
    assert most <= 4 and len(table.paths(8, [date(2024, 7, 2)])[0]) == 9
    # A fold that did not finish does not count, nor do parts that a finished one has left behind.
    os.makedirs(f"{table.folded.path}/event_date=2024-07-01/upto=8")
    assert total(table, 9) == 18
    some(spark, 5).withColumns({"event_date": F.lit("2024-07-01"), "epoch": F.lit(0)}).write.mode("append").partitionBy("event_date", "epoch").parquet(table.parts.path)
    assert total(table, 8) == 18
    assert table.days() == [DAY, date(2024, 7, 2)] and table.read(8, [date(2020, 1, 1)]).count() == 0


def test_a_batch_rewrites_the_buckets_of_its_keys(spark, root):
    rows_of = lambda low, high, n: spark.range(low, high).select(F.col("id").cast("string").alias("k"), F.lit(n).alias("n"))
    table = BucketedTable(spark, f"{root}/t", rows_of(0, 1, 0).schema, ["k"], 200)
    assert table.load().count() == 0 and table.versions() == []
    table.save(rows_of(0, 3000, 0), 0)
    few = rows_of(0, 30, 1)  # one key in a hundred
    merged = table.load(before=1, of=few)
    assert merged.count() < 3000 / 5
    table.save(merged.join(few, "k", "left_anti").unionByName(few), 1)
    written = [b for b, e in table.folder.pairs("bucket", "epoch") if e == 1]
    assert 20 <= len(written) <= 30
    assert table.load().agg(F.count("k"), F.countDistinct("k"), F.sum("n")).first()[:] == (3000, 3000, 30)
    assert table.load(before=1).agg(F.sum("n")).first()[0] == 0  # an epoch handled again
    os.rmdir(f"{root}/t/committed/epoch=1")  # an epoch that did not finish
    assert table.load().agg(F.sum("n")).first()[0] == 0
    one = rows_of(5, 6, 9)
    for epoch in range(1, 6):
        table.save(table.load(before=epoch, of=one), epoch)
    (bucket,) = table.touched(one)
    assert sorted(e for b, e in table.folder.pairs("bucket", "epoch") if b == bucket) == [3, 4, 5]


def test_latest_in_buckets(spark, root):
    batches = [[("A", "10:00", 5), ("B", "10:30", 9), (None, "11:00", 1)], [("A", "10:10", 1), ("C", "10:00", 2)], []]
    got = []
    for epoch, batch in enumerate(batches):
        for _ in range(2):
            handle_latest_batch(snapshots(spark, *batch), epoch, root, sink=lambda df, e: got.append(rows(df, "stationId")), buckets=4)
    table = latest_table(JobTables(spark, root), snapshots(spark).schema, buckets=4)
    want = latest_by(snapshots(spark, *batches[0], *batches[1]), ["stationId"], ["event_time"])
    assert rows(table.load(), "stationId", "parkingBikeTotCnt") == rows(want, "stationId", "parkingBikeTotCnt")
    assert got[-1] == [("A",), ("C",)]
