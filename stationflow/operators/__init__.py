from stationflow.operators.current import flows_of_hour
from stationflow.operators.flows import station_flows, usable_once
from stationflow.operators.lag import delta_lag
from stationflow.operators.latest import (
    dedupe_snapshots,
    latest_by,
    next_state,
    upsert_latest,
)
from stationflow.operators.metrics import batch_metrics, observe_batch
from stationflow.operators.preview import ordered_preview
from stationflow.operators.repair import repairs
from stationflow.operators.state_join import delta_vs_state, late_snapshots
from stationflow.operators.windows import (
    current_hour,
    hourly_truncated,
    hourly_tumbling,
    pane_totals,
    sliding_station,
    sliding_total,
    total_by_window,
    totals_from_panes,
)

__all__ = [
    "batch_metrics",
    "current_hour",
    "dedupe_snapshots",
    "delta_lag",
    "delta_vs_state",
    "flows_of_hour",
    "hourly_truncated",
    "hourly_tumbling",
    "late_snapshots",
    "latest_by",
    "next_state",
    "observe_batch",
    "ordered_preview",
    "repairs",
    "pane_totals",
    "sliding_station",
    "sliding_total",
    "station_flows",
    "total_by_window",
    "totals_from_panes",
    "upsert_latest",
    "usable_once",
]
