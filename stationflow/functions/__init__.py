from stationflow.functions.flow import flow_columns
from stationflow.functions.hour import hour_start, is_zoned
from stationflow.functions.parse import is_placed, parse_snapshots, set_aside_ahead, split_malformed

__all__ = ["flow_columns", "hour_start", "is_placed", "is_zoned", "parse_snapshots", "set_aside_ahead", "split_malformed"]
