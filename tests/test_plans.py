"""What the physical plans must look like, since results alone do not show it."""

from __future__ import annotations

import re

import pytest
from frames import SF

from pyspark.sql import functions as F

from stationflow.functions import parse_snapshots
from stationflow.operators import delta_lag, flows_of_hour, hourly_tumbling, latest_by
from stationflow.plans.queries import QUERIES, _around_cut
from stationflow.plans.snapshots import TIES, as_envelopes, snapshots
from stationflow.schema import STATION, TIME

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """The plan adaptive execution ended with. Collecting runs this very plan."""
    df.collect()
    return plan_of(df).split("== Initial Plan")[0]


def read_schemas(plan: str) -> set[str]:
    return set(re.findall(r"ReadSchema: struct<(.*?)>\n", plan + "\n"))


@pytest.mark.parametrize("name", ["delta_lag", "hourly_tumbling", "sliding_station", "sliding_total", "latest_by_station"])
def test_scans_read_only_needed_columns_and_no_plan_pairs_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for schema in read_schemas(plan):
        assert "event_type" not in schema and "value" not in schema
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|SinglePartition|ArrowEval|BatchEvalPython", plan)


def test_lag_scans_and_shuffles_its_rows_once(spark):
    plan = final_plan_of(hourly_tumbling(delta_lag(snapshots(spark, SF), TIES)))
    assert plan.count("FileScan") == 1 or plan.count("Scan parquet") == 1
    with_json = [s for s in re.findall(r"ReadSchema: (.*)", plan) if "props" in s]
    assert len(with_json) == 1 and "BroadcastExchange" not in plan


def test_lag_plans_without_looking_at_the_data(spark):
    status = spark.sparkContext.statusTracker()
    before = set(status.getJobIdsForGroup(None))
    envelopes = as_envelopes(spark.read.schema(EVENTS).parquet(f"{SF}/events.parquet"))
    lagged = delta_lag(parse_snapshots(envelopes), ["offset"])
    assert set(status.getJobIdsForGroup(None)) == before
    assert final_plan_of(lagged).count("props") and len(re.findall(r"ReadSchema: .*props", plan_of(lagged).split("== Initial Plan")[0])) == 1


@pytest.mark.parametrize("name", ["dedupe_snapshots", "next_state", "delta_state_join"])
def test_newest_row_reductions_hash(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_current_hour_with_state_reads_one_hour(spark):
    state, _ = _around_cut(spark, SF)
    state = spark.createDataFrame([], state.schema)
    plan = plan_of(flows_of_hour(snapshots(spark, SF), F.lit("2024-01-15 10:30:00").cast("timestamp_ntz"), TIES, state))
    for scan in re.findall(r"PushedFilters: \[(.*?)\]\n?", plan):
        assert not scan or "GreaterThanOrEqual(ts,2024-01-15T10:00)" in scan


def test_sliding_station_folds_into_panes_before_expanding(spark):
    plan = plan_of(QUERIES["sliding_station"](spark, SF))
    expand = plan.index("Expand")
    assert plan.index("partial_sum", expand) > expand


def test_windows_of_a_station_are_neither_shuffled_nor_held(spark):
    """Twelve windows a pane: only panes, each at two hours, are shuffled and sorted, and nothing is kept by window."""
    plan = plan_of(QUERIES["sliding_station"](spark, SF))
    above = plan[: plan.index("Expand")]
    assert "Aggregate" not in above and above.count("Exchange") == 1
    assert re.search(r"Exchange hashpartitioning\(hour#\d+, stationId#\d+", above) and "Generate explode(sequence(low" in above


def test_two_levels_of_totals_hold_no_windows_of_a_station(spark):
    """Above the expansion to two hours a pane, sums are kept by window alone, a task's by one row each."""
    plan = plan_of(QUERIES["sliding_total_two_level"](spark, SF))
    keys = re.findall(r"Aggregate\(keys=\[(.*?)\]", plan[: plan.index("Expand")])
    assert len(keys) == 2 and all(re.fullmatch(r"start#\d+, end#\d+", k) for k in keys)


def test_baseline_touches_edge_rows_only(spark):
    state, batch = _around_cut(spark, SF)
    plan = final_plan_of(hourly_tumbling(delta_lag(batch, TIES, baseline=state)))
    assert plan.count(" LeftOuter") == 1


def test_lag_partitions_by_station_and_slice(spark):
    plan = plan_of(delta_lag(snapshots(spark, SF), TIES))
    assert re.search(r"hashpartitioning\(stationId#\d+, _slice#\d+L?, \d+\)", plan)


def test_time_range_reaches_the_scan(spark):
    plan = plan_of(QUERIES["current_hour"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-15T10:00)" in plan and "LessThan(ts,2024-01-15T11:00)" in plan
    plan = plan_of(QUERIES["delta_state_join"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-16T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_unused_json_fields_are_not_parsed(spark):
    plan = plan_of(QUERIES["parse_projection"](spark, SF))
    parsed = re.findall(r"from_json\((StructField.*?)\), ", plan)
    assert parsed and not any("stationLatitude" in p for p in parsed)


def test_latest_combines_before_the_shuffle(spark):
    plan = plan_of(latest_by(snapshots(spark, SF), [STATION], [TIME, *TIES]))
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_totals_fold_into_panes_before_expanding(spark):
    plan = plan_of(QUERIES["sliding_total"](spark, SF))
    expand = plan.index("Expand")
    assert plan.index("partial_sum", expand) > expand  # panes are summed below the expansion


def test_preview_needs_no_global_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["ordered_preview"](spark, SF))
