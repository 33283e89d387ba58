from stationflow.sinks.bucketed import (
    BUCKET,
    HOURLY_SUMMARY,
    TOTAL_HOURLY_STATS,
    with_bucket,
    write_bucketed,
)
from stationflow.sinks.keyed import put_rows

__all__ = ["BUCKET", "HOURLY_SUMMARY", "TOTAL_HOURLY_STATS", "put_rows", "with_bucket", "write_bucketed"]
