from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import Observation

from stationflow.functions import parse_snapshots, split_malformed
from stationflow.operators import batch_metrics, observe_batch

GOOD = {"stationId": "ST-1", "parkingBikeTotCnt": 5, "timestamp": "2024-07-01 10:05:00", "rackTotCnt": "10"}
TIME = datetime(2024, 7, 1, 10, 5)


def envelopes(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset bigint, value string")


def parse_one(spark, document, tz=None):
    value = document if document is None or isinstance(document, str) else json.dumps(document)
    parsed = parse_snapshots(envelopes(spark, value), tz)
    return parsed.withColumn("event_time", parsed.event_time.cast("timestamp_ntz")).first().asDict()


def test_good_row(spark):
    row = parse_one(spark, GOOD)
    assert row == {
        "offset": 0, "rackTotCnt": "10", "stationName": None, "parkingBikeTotCnt": 5, "shared": None,
        "stationLatitude": None, "stationLongitude": None, "stationId": "ST-1", "event_time": TIME,
    }


@pytest.mark.parametrize("count", ["5", 5.7, 99999999999])
def test_bad_count_is_null_alone(spark, count):
    row = parse_one(spark, GOOD | {"parkingBikeTotCnt": count})
    assert (row["parkingBikeTotCnt"], row["stationId"], row["event_time"]) == (None, "ST-1", TIME)


def test_number_for_text_and_unknown_fields(spark):
    row = parse_one(spark, {"rackTotCnt": 10, "zzz": 1})
    assert row["rackTotCnt"] == "10"
    assert row["stationId"] is None


@pytest.mark.parametrize("value", ["not json", "", None, json.dumps([GOOD, GOOD])])
def test_unreadable_document_is_a_null_row(spark, value):
    row = parse_one(spark, value)
    assert {v for k, v in row.items() if k != "offset"} == {None}


@pytest.mark.parametrize("text", ["2024-07-01 10:05", "2024-07-01T10:05:00", "2024-07-01 10:05:00.123", ""])
def test_bad_timestamp_is_null(spark, text):
    row = parse_one(spark, GOOD | {"timestamp": text})
    assert (row["event_time"], row["stationId"]) == (None, "ST-1")


def test_timestamp_in_a_given_zone(spark):
    assert parse_one(spark, GOOD, tz="Asia/Seoul")["event_time"] == datetime(2024, 7, 1, 1, 5)
    assert parse_one(spark, GOOD | {"timestamp": "x"}, tz="Asia/Seoul")["event_time"] is None


def mixed(spark):
    lacking = [json.dumps({k: v for k, v in GOOD.items() if k != f}) for f in
               ("stationId", "parkingBikeTotCnt", "timestamp")]
    return parse_snapshots(envelopes(spark, json.dumps(GOOD), "not json", *lacking))


def test_split_malformed_keeps_every_row_once(spark):
    usable, malformed = split_malformed(mixed(spark))
    assert [r.offset for r in usable.collect()] == [0]
    assert sorted(r.offset for r in malformed.collect()) == [1, 2, 3, 4]


def test_metrics_count_malformed_rows(spark):
    assert batch_metrics(mixed(spark)).first().asDict() == {"total": 5, "parsed": 1, "malformed": 4}


def test_observed_metrics_need_no_pass_of_their_own(spark, root):
    counts = Observation("m")
    observe_batch(mixed(spark), counts).write.parquet(f"{root}/out")
    assert counts.get == {"total": 5, "parsed": 1, "malformed": 4}


def test_evidence_is_kept_of_malformed_rows_only(spark):
    good = '{"stationId":"A","parkingBikeTotCnt":5,"timestamp":"2024-07-01 10:00:00"}'
    docs = [good, "prose", good.replace(":5", ':"x"'), good.replace("2024-07-01 10", "soon"), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "offset int, value string")
    got = parse_snapshots(df, evidence=True, keep_text=True).orderBy("offset").collect()
    assert [(r["value"], r["reason"]) for r in got] == [
        (None, None), ("prose", "no station, time, count"), (docs[2], "no count"), (docs[3], "no time"),
        (None, "no station, time, count"),
    ]
    assert [r["timestamp"] for r in got][:1] == ["2024-07-01 10:00:00"] and got[3]["timestamp"] == "soon:00:00"
