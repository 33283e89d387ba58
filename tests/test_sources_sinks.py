from __future__ import annotations

import os

from frames import at, rows, snapshots
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from stationflow.sinks import put_rows, write_bucketed
from stationflow.sources import read_envelopes
from stationflow.sources.envelopes import kafka_options


def test_kafka_options():
    assert kafka_options(["a:9092", "b:9092"], ["t", "u"], max_offsets_per_trigger=5) == {
        "kafka.bootstrap.servers": "a:9092,b:9092",
        "subscribe": "t,u",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }


def test_text_envelopes(spark, root):
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(f"{root}/in")
    batch = read_envelopes(spark, "text", f"{root}/in", streaming=False)
    assert batch.dtypes == [("value", "string")] and rows(batch, "value") == [("a",), ("b",)]
    stream = read_envelopes(spark, "text", f"{root}/in")
    assert stream.isStreaming and stream.dtypes == [("value", "string")]


def test_parquet_envelopes(spark, root):
    spark.createDataFrame([("a", 1)], "value string, other int").write.parquet(f"{root}/in")
    batch = read_envelopes(spark, "parquet", f"{root}/in", streaming=False, position=True)
    # An archive without the log's position has it as nulls.
    assert batch.columns == ["value", "topic", "partition", "offset"]
    assert rows(batch, "value", "offset") == [("a", None)]
    plain = read_envelopes(spark, "parquet", f"{root}/in", streaming=False)
    assert plain.dtypes == [("value", "string")] and rows(plain, "value") == [("a",)]


def hours(spark, *data):
    data = [(at(t), n) for t, n in data]
    return spark.createDataFrame(data, "`end` timestamp_ntz, n int")


def test_every_window_lands_in_its_own_bucket_and_others_stay(spark, root):
    write_bucketed(hours(spark, ("09:00", 1), ("10:00", 2), ("2024-07-02 00:00", 3)), root)
    write_bucketed(hours(spark, ("10:05", 7), ("10:00", 8)), root)
    assert rows(spark.read.parquet(root), "n") == [(1,), (3,), (7,), (8,)]
    assert os.path.isdir(f"{root}/year=2024/month=07/day=02/hour=00")
    assert len([f for f in os.listdir(f"{root}/year=2024/month=07/day=01/hour=10") if f.endswith(".parquet")]) == 1


def test_empty_result_writes_no_bucket(spark, root):
    write_bucketed(hours(spark, ("09:00", 1)), root)
    write_bucketed(hours(spark), root)
    assert rows(spark.read.parquet(root), "n") == [(1,)]


def folder_store():
    """Stands in for a key-value store: a file per key. Local classes travel by value."""

    class FolderWriter(DataSourceWriter):
        def __init__(self, options):
            self.options = dict(options)

        def write(self, iterator):
            for row in iterator:
                key = row[self.options["key.column"]]
                with open(f"{self.options['folder']}/{self.options['table']}:{key}", "w") as f:
                    f.write(str(row.parkingBikeTotCnt))
            return WriterCommitMessage()

    class FolderStore(DataSource):
        @classmethod
        def name(cls):
            return "folder_store"

        def writer(self, schema, overwrite):
            return FolderWriter(self.options)

    return FolderStore


def contents(folder):
    return {name: open(f"{folder}/{name}").read() for name in os.listdir(folder)}


def test_put_rows_sends_the_newest_row_per_key(spark, root):
    spark.dataSource.register(folder_store())
    df = snapshots(spark, ("A", "10:00", 5), ("A", "10:05", 7), ("B", "10:00", 1), (None, "10:00", 2))
    put_rows(df, "bike_stations", ["stationId"], fmt="folder_store", options={"folder": root})
    assert contents(root) == {"bike_stations:A": "7", "bike_stations:B": "1"}


def test_put_rows_joins_several_keys(spark, root):
    spark.dataSource.register(folder_store())
    df = snapshots(spark, ("A", "10:00", 5), ("B", "10:00", 1)).withColumn("city", F.lit("x"))
    put_rows(df, "t", ["city", "stationId"], fmt="folder_store", options={"folder": root})
    assert contents(root) == {'t:["x","A"]': "5", 't:["x","B"]': "1"}
