"""The same results in DuckDB's SQL, for every query a single statement can state."""

from __future__ import annotations

from stationflow.plans.queries import AS_OF, CUT, LATE_BEFORE

# Snapshots, and their flow against the preceding snapshot of the station.
_SN = """
sn as (select event_id, cast(user_id as varchar) as "stationId",
         cast(json_extract(props, '$.k') as integer) as bikes, ts as event_time
       from events)"""
_LAGGED = """
l as (select *, lag(bikes) over (partition by "stationId" order by event_time, event_id) as prev_count
      from sn),
d as (select *, bikes - prev_count as diff,
        case when bikes < prev_count then prev_count - bikes else 0 end as rental,
        case when bikes > prev_count then bikes - prev_count else 0 end as ret
      from l)"""
_D = f"{_SN},{_LAGGED}"
# Two rows of three belong to one station.
_HOT = _D.replace("cast(user_id as varchar)", "case when event_id % 3 <> 0 then 'hot' else cast(user_id as varchar) end")
# Rows sent again: corrected with a higher id, outdated with a lower one; and the one of each instant that wins.
_SENT = f"""{_SN},
sent as (select * from sn
  union all select event_id + 10000000, "stationId", bikes + 1, event_time from sn where event_id % 2 = 0
  union all select event_id - 10000000, "stationId", bikes + 2, event_time from sn where event_id % 3 = 0)"""
_WINS = """qualify row_number() over (partition by "stationId", event_time order by event_id desc) = 1"""
_POLLUTED = f"""{_SENT},
once as (select * from sent where event_id % 11 <> 0 and event_id % 7 <> 0 and event_id % 13 <> 0 {_WINS}),
{_LAGGED.strip().replace("from sn)", "from once)")}"""
# What the streams see: times cut to seconds, and one row of a station and second.
_SN_S = f"""{_SN.replace("ts as event_time", "date_trunc('second', ts) as event_time").replace("sn as (", "all_s as (")},
sn as (select * from all_s {_WINS})"""
_D_S = f"{_SN_S},{_LAGGED}"
_HOURLY = """
h as (select date_trunc('hour', event_time) as "start",
        date_trunc('hour', event_time) + interval 1 hour as "end", "stationId",
        cast(sum(rental) as bigint) as total_rental, cast(sum(ret) as bigint) as total_return
      from d group by all)"""
_SLIDING = """
x as (select time_bucket(interval 5 minutes, event_time) - i * interval 5 minutes as "start",
        "stationId", rental, ret from d, range(12) r(i)),
hs as (select "start", "start" + interval 1 hour as "end", "stationId",
         cast(sum(rental) as bigint) as hourly_rental, cast(sum(ret) as bigint) as hourly_return
       from x group by all),
ht as (select "start", "end", cast(sum(hourly_rental) as bigint) as total_hourly_rental,
         cast(sum(hourly_return) as bigint) as total_hourly_return
       from hs group by all)"""
_BUCKET = """strftime("end", '%Y') as "year", strftime("end", '%m') as "month",
       strftime("end", '%d') as "day", strftime("end", '%H') as "hour" """
_LATEST = """select event_id, "stationId", bikes as "parkingBikeTotCnt", event_time from sn
  qualify row_number() over (partition by "stationId" order by event_time desc, event_id desc) = 1"""
_OLD_OF_ODD = f"""(event_time < timestamp '{CUT}' or cast("stationId" as bigint) % 2 = 0)"""
_STATE = """select "stationId", bikes as "previous_parkingBikeTotCnt", event_time from sn
  qualify row_number() over (partition by "stationId" order by event_time desc, event_id desc) = 1"""
_TOTALS = 'select "start", "end", total_hourly_rental, total_hourly_return from ht'


def _vs_state(guard: str) -> str:
    return f"""{_SN},
st as (select "stationId", arg_max(bikes, (event_time, event_id)) as prev
       from sn where event_time < timestamp '{CUT}' group by 1),
j as (select sn.*, prev, case when {guard} then bikes - prev else 0 end as change
      from sn left join st on sn."stationId" = st."stationId"
      where event_time >= timestamp '{CUT}'),
d as (select *, case when change < 0 then -change else 0 end as rental,
        case when change > 0 then change else 0 end as ret from j)"""


_VS_COLUMNS = """select event_id, "stationId", bikes as "parkingBikeTotCnt", event_time,
  coalesce(prev, 0) as "previous_parkingBikeTotCnt", change, rental, ret as "return" from d"""
_UNKNOWN_ZERO = "prev is not null and prev <> 0"

_PARSED = """select event_id as "offset",
  cast(cast(json_extract(props, '$.k') as integer) + 10 as varchar) as "rackTotCnt",
  'Stop ' || user_id as "stationName", cast(json_extract(props, '$.k') as integer) as "parkingBikeTotCnt",
  event_type as shared, '37.' || user_id as "stationLatitude", '127.' || user_id as "stationLongitude",
  cast(user_id as varchar) as "stationId", date_trunc('second', ts) as event_time from events"""

ORACLES: dict[str, str] = {
    "parse_snapshots": _PARSED,
    "parse_projection": f'select "offset", "stationId", "parkingBikeTotCnt", event_time from ({_PARSED})',
    "split_malformed": f"""select 'documents' as topic, doc_id as "offset", 'no station, time, count' as reason,
        cast(strlen(text) as bigint) as n_bytes from documents
      union all select 'events', event_id,
        case when event_id % 35 = 0 then 'no time, count' when event_id % 7 = 0 then 'no time' else 'no count' end,
        cast(strlen(doc) + case when event_id % 5 = 0 then 6 - strlen(k) else 0 end
          + case when event_id % 7 = 0 then 9 - 19 else 0 end as bigint)
      from (select event_id, cast(json_extract(props, '$.k') as varchar) as k,
          '{{"rackTotCnt":"' || (cast(json_extract(props, '$.k') as integer) + 10) || '","stationName":"Stop ' || user_id
          || '","parkingBikeTotCnt":' || cast(json_extract(props, '$.k') as varchar) || ',"shared":"' || event_type
          || '","stationLatitude":"37.' || user_id || '","stationLongitude":"127.' || user_id || '","stationId":"' || user_id
          || '","timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}}' as doc from events)
      where event_id % 5 = 0 or event_id % 7 = 0""",
    "batch_metrics": """select e + d as total, e as parsed, d as malformed
      from (select count(*) as e from events), (select count(*) as d from documents)""",
    "dedupe_snapshots": f"""with {_SENT} select "stationId", event_time, bikes as "parkingBikeTotCnt" from sent {_WINS}""",
    "delta_lag_hot": f"""with {_HOT} select event_id, "stationId", bikes as "parkingBikeTotCnt", event_time,
      prev_count, diff, rental, ret as "return" from d""",
    "backfill_hourly": f"with {_POLLUTED}, {_HOURLY} select * from h",
    "delta_lag": f"""with {_D} select event_id, "stationId", bikes as "parkingBikeTotCnt", event_time,
      prev_count, diff, rental, ret as "return" from d""",
    "delta_state_join": f"with {_vs_state(_UNKNOWN_ZERO)} {_VS_COLUMNS}",
    "delta_state_join_known_zero": f"with {_vs_state('prev is not null')} {_VS_COLUMNS}",
    "next_state": f"with {_SN} {_STATE.replace('from sn', f'from sn where {_OLD_OF_ODD}')}",
    "state_table": f"with {_SN} {_STATE}",
    "late_snapshots": f"""with {_SN},
      st as (select "stationId", max(event_time) as known_at
             from sn where event_time < timestamp '{CUT}' group by 1)
      select event_id, sn."stationId", bikes as "parkingBikeTotCnt", event_time, known_at
      from sn join st on sn."stationId" = st."stationId" where event_time <= known_at""",
    "latest_by_station": f"with {_SN} {_LATEST}",
    "upsert_latest": f"with {_SN} {_LATEST.replace('from sn', f'from sn where {_OLD_OF_ODD}')}",
    "hourly_tumbling": f"with {_D}, {_HOURLY} select * from h",
    "hourly_truncated": f"with {_D}, {_HOURLY} select * from h",
    "hourly_vs_state": f"with {_vs_state(_UNKNOWN_ZERO)}, {_HOURLY} select * from h",
    "current_hour": f"""with {_D}, {_HOURLY}
      select * from h where "start" = date_trunc('hour', timestamp '{AS_OF}')""",
    "sliding_station": f"with {_D}, {_SLIDING} select * from hs",
    "sliding_total": f"with {_D}, {_SLIDING} {_TOTALS}",
    "sliding_total_two_level": f"with {_D}, {_SLIDING} {_TOTALS}",
    "ordered_preview": f'with {_D}, {_HOURLY} select * from h order by "start", "stationId" limit 20',
    "partitioned_hourly": f"with {_D}, {_HOURLY} select *, {_BUCKET} from h",
    "partitioned_total": f"with {_D}, {_SLIDING} select *, {_BUCKET} from ht",
    "stream_hourly_station": f"with {_D_S}, {_HOURLY} select * from h",
    "stream_repaired": f"with {_D_S}, {_HOURLY} select * from h",
    "stream_keyed": f"with {_D_S}, {_HOURLY} select * from h",
    "stream_handover": f"with {_D_S}, {_HOURLY} select * from h",
    "stream_hourly_total": f"with {_D_S}, {_SLIDING} {_TOTALS}",
    "stream_latest": f"""with {_SN_S} select event_id as "offset", "stationId", bikes as "parkingBikeTotCnt", event_time
      from sn qualify row_number() over (partition by "stationId" order by event_time desc, event_id desc) = 1""",
    "stream_late": f"""with {_SN_S} select 3::bigint as epoch, "stationId", event_time, bikes as "parkingBikeTotCnt"
      from sn where cast("stationId" as bigint) % 10 = 0 and event_time < timestamp '{LATE_BEFORE}'""",
    "stream_sliding_total": f"""with {_D}, {_SLIDING} {_TOTALS}
      where "end" <= (select max(ts) - interval 10 minutes from events)""",
}
