from stationflow.streaming.jobs import (
    HourlyOptions,
    seed_hourly_job,
    start_hourly_job,
    start_latest_job,
    start_sliding_total_job,
    stream_sliding_total,
)
from stationflow.streaming.keyed import ROCKSDB, keyed_flows, start_keyed_hourly_job
from stationflow.streaming.parts import DayParts
from stationflow.streaming.tables import BucketedTable, JobTables, VersionedTable

__all__ = [
    "BucketedTable",
    "DayParts",
    "HourlyOptions",
    "JobTables",
    "ROCKSDB",
    "VersionedTable",
    "keyed_flows",
    "seed_hourly_job",
    "start_hourly_job",
    "start_keyed_hourly_job",
    "start_latest_job",
    "start_sliding_total_job",
    "stream_sliding_total",
]
