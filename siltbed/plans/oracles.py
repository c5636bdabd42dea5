"""The catalogue's queries in DuckDB SQL over the same tables."""

from __future__ import annotations

from siltbed.plans.catalogue import GROUP, OUTPUT_ROOT, ROLLOVER_BLOCK, SMALL_POLICY
from siltbed.plans.messages import DUCKDB_MESSAGES

KEYS = 'topic, "partition", "offset"'

_FIELDS = """
select *,
  cast(case when value <> '' and rtrim(value, ',') = '' then 0
       else len(string_split(rtrim(value, ','), ',')) end as int) as n_fields
from messages
"""

_PARSED = """
select *, case when regexp_full_match(f9, '[+-]?[0-9]+') then try_cast(f9 as bigint) end as event_ms
from (select *, case when n_fields > 9 then string_split(value, ',')[10] end as f9 from fields)
"""

_ROUTED = """
select *,
  cast(lt as date) as event_day, cast(hour(lt) as int) as event_hour,
  case when lt is not null
    then year(lt) || '-' || month(lt) || '-' || day(lt) || '/' || hour(lt) end as route
from (
  select *, case when reject_reason is null then make_timestamp((event_ms + 28800000) * 1000) end as lt
  from (
    select *, "offset" + 1 as next_offset,
      case when value is null then 'null_value'
        when n_fields < 9 then 'too_few_fields'
        when event_ms is null then 'bad_timestamp'
        when event_ms > 9223372036854775 or event_ms < -9223372036854775 then 'timestamp_out_of_range'
      end as reject_reason
    from parsed))
"""

_CHARS = """
select *, cast(coalesce(
  length(value) + length(regexp_replace(value, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')), 0) as bigint) as chars
from routed
"""

_BOUNDS = """
select topic, "partition", min("offset") as earliest, max("offset") + 1 as latest
from messages group by all
"""

_STARTS = """
select *,
  case "partition" when 1 then latest // 2 when 2 then earliest - 5 when 3 then latest + 400
    when 4 then latest // 2 end as saved,
  case "partition" when 2 then -5 when 4 then latest // 2 + 7 end as explicit
from bounds
"""


def _with(sql: str) -> str:
    # A body may have tables of its own.
    own, sql = (f", {sql.strip()[5:]}", "") if sql.strip().startswith("with ") else ("", sql)
    return f"""
with messages as ({DUCKDB_MESSAGES}), fields as ({_FIELDS}), parsed as ({_PARSED}), routed as ({_ROUTED}),
sized as ({_CHARS}), bounds as ({_BOUNDS}), starts as ({_STARTS}){own}
{sql}
"""


def _start(policy_position: str) -> str:
    return f"""
greatest(earliest, least(latest, coalesce(
  case when explicit >= 0 then explicit end, saved, explicit, {policy_position})))
"""


def _metrics(extra: str) -> str:
    return f"""
select topic, "partition", {extra}
  cast(sum(chars) as bigint) as fetch_chars,
  count(distinct route) as n_routes,
  min("offset") as start_offset, max("offset") + 1 as next_offset
from sized group by all
"""


_LANDED = f"select {KEYS}, event_day, event_hour, value as line from routed where reject_reason is null"

_TWO_BATCHES = f"""
select {KEYS}, event_day, event_hour, value as line,
  case when "offset" < latest // 2 then earliest else latest // 2 end as start_offset
from routed join bounds using (topic, "partition") where reject_reason is null
"""

_FANOUT = f"""
select {KEYS}, 'all' as route, value as line from messages where value is not null
union all
select {KEYS}, 'alerts/' || string_split(value, ',')[3], value
from messages where string_split(value, ',')[3] in ('error', 'purchase')
"""

_BODIES = {
    "decode_messages": f"select {KEYS}, key, value from messages",
    "tail_format": f"""
select {KEYS}, printf('offset = %d, key = %s, value = %s', "offset", coalesce(key, 'null'), coalesce(value, 'null')) as line
from messages where "partition" = 0""",
    "next_offset": f'select {KEYS}, "offset" + 1 as next_offset from messages',
    "partition_bounds": "select * from bounds",
    "resolve_start_earliest": f'select topic, "partition", {_start("-1")} as start_offset from starts',
    "resolve_start_latest": f'select topic, "partition", {_start("9223372036854775807")} as start_offset from starts',
    "incremental_scan": f"""
select {KEYS}, key, value from messages join starts using (topic, "partition") where "offset" >= {_start("-1")}""",
    "incremental_scan_pruned": f"""
select {KEYS}, key, value from messages join starts using (topic, "partition") where "offset" >= {_start("-1")}""",
    "commit_ledger": f"""
select topic, '{GROUP}' as grp, "partition", case when "partition" % 2 = 0 then latest else latest // 2 end as next_offset
from bounds""",
    "field_count": f"select {KEYS}, n_fields from fields",
    "field_extract": f"select {KEYS}, f9 from parsed",
    "parse_event_ms": f"select {KEYS}, event_ms from parsed",
    "event_local_parts": f"select {KEYS}, event_day, event_hour from routed where reject_reason is null",
    "local_parts_of_events": f"""
select {KEYS},
  cast(make_timestamp((28800000 - ms) * 1000) as date) as day_before_epoch,
  cast(hour(make_timestamp((28800000 - ms) * 1000)) as int) as hour_before_epoch,
  cast(make_timestamp((ms - 18000000) * 1000) as date) as day_west,
  cast(hour(make_timestamp((ms - 18000000) * 1000)) as int) as hour_west,
  cast(make_timestamp(ms * 1000) as date) as day_utc,
  cast(hour(make_timestamp(ms * 1000)) as int) as hour_utc
from (select *, event_ms % 4000000000000 as ms from parsed where event_ms is not null)""",
    "message_chars": f"select {KEYS}, chars from sized",
    "route_messages": f"select {KEYS}, next_offset, value, reject_reason, event_day, event_hour, route from routed",
    "accepted_messages": f"select {KEYS}, value as line from routed where reject_reason is null",
    "rejected_messages": f"select {KEYS}, value, reject_reason from routed where reject_reason is not null",
    "legacy_file_name": f"""
select {KEYS}, '{OUTPUT_ROOT}/' || topic || '/' || route || '-' || "partition" || '.' || earliest || '.lzo' as file_name
from routed join bounds using (topic, "partition") where reject_reason is null""",
    "batch_commit_metrics": _metrics(""),
    "rollover_reason": f"""
select *, case when fetch_chars >= {SMALL_POLICY.max_chars} then 'size'
  when batch_no % 7 = 3 then 'age' when n_routes >= {SMALL_POLICY.max_routes} then 'paths' end as rollover_reason
from ({_metrics(f'"offset" // {ROLLOVER_BLOCK} as batch_no,')})""",
    "landed_lines": _LANDED,
    "landed_rejects": f"select {KEYS}, value, reject_reason from routed where reject_reason is not null",
    "landed_rebalanced": _LANDED,
    "text_export": """
select topic, event_day, event_hour, "partition", earliest as start_offset, value as line
from routed join bounds using (topic, "partition") where reject_reason is null""",
    "text_export_late": f'select topic, event_day, event_hour, "partition", start_offset, line from ({_TWO_BATCHES})',
    "text_export_named": f"""
select topic || '/' || year(event_day) || '-' || month(event_day) || '-' || day(event_day) || '/' || event_hour
  || '-' || "partition" || '.' || start_offset || '.gz' as file_name, line
from ({_TWO_BATCHES})""",
    "text_export_folders": "select topic, event_day, event_hour, value as line from routed where reject_reason is null",
    "commit_metrics_fanout": """
with halves as (select * from sized join bounds using (topic, "partition")),
landed as (
  select topic, "partition", 'a' as commit_key, 0 as batch_id, "offset", chars, value from halves where "offset" >= latest // 2
  union all
  select topic, "partition", 'b', 1, "offset" + 10000000, chars, value from halves where "partition" % 2 = 1
)
select topic, "partition", commit_key, cast(batch_id as bigint) as batch_id, count(*) as n_messages, cast(sum(chars) as bigint) as fetch_chars,
  min("offset") as start_offset, max("offset") + 1 as next_offset,
  cast(max(case when value is null then 0 else 1 end)
    + count(distinct case when string_split(value, ',')[3] in ('error', 'purchase') then string_split(value, ',')[3] end) as bigint) as n_routes
from landed group by all
union all
select topic, "partition", 'b', 1, 0, 0, latest, latest, 0 from bounds where "partition" % 2 = 0""",
    "repeated_messages": _LANDED,
    "committed_overlap": f"""
select {KEYS}, event_day, event_hour, value as line, case when "offset" < 2 * (latest // 3) then 'lower' else 'upper' end as commit_key
from routed join bounds using (topic, "partition") where reject_reason is null""",
    "compacted_read": f"""
select {KEYS}, event_day, event_hour, value as line,
  case when "offset" < latest // 3 then 'batch-0' when "offset" < 2 * (latest // 3) then 'batch-1' else 'batch-2' end as commit_key
from routed join bounds using (topic, "partition") where reject_reason is null""",
    "compacted_days": f"""{_LANDED} and event_day in (
  select unnest([min(event_day), max(event_day)]) from routed where reject_reason is null)""",
    "rollover_of_commits": f"""
select *, case when fetch_chars >= {SMALL_POLICY.max_chars} then 'size'
  when age_ms >= {SMALL_POLICY.max_age_ms} then 'age' when n_routes >= {SMALL_POLICY.max_routes} then 'paths' end as rollover_reason
from (
  select topic, "partition", "offset" // {ROLLOVER_BLOCK} as batch_id, count(*) as n_messages, cast(sum(chars) as bigint) as fetch_chars,
    count(distinct route) as n_routes, min("offset") as start_offset, max("offset") + 1 as next_offset,
    cast(case "offset" // {ROLLOVER_BLOCK} when 0 then 600000 when 1 then 1900000 else 500 end as bigint) as age_ms
  from sized where "offset" // {ROLLOVER_BLOCK} < 2 or ("offset" // {ROLLOVER_BLOCK} = 2 and "offset" % 8 = 0)
  group by all)""",
    "routes_of_commits": """
select topic, "partition", cast(2 as bigint) as n_commits, count(distinct route) as n_routes, true as is_near
from routed where reject_reason is null group by all""",
    "offset_gaps": """
select topic, "partition", latest // 2 - 3 * "partition" as gap_start, latest // 2 as gap_next, cast(3 * "partition" as bigint) as n_missing
from bounds where "partition" > 0""",
    "ledger_snapshot": """
select topic, "partition", cast(max((b + 1) * (latest // 7)) as bigint) as saved_offset, count(*) as n_commits
from bounds, range(7) as r(b) where "partition" <= b and "partition" <> 6 - b group by all""",
    "late_file_log": f"""
select {KEYS}, case when "offset" < latest // 2 then 'behind_position' else coalesce(reject_reason, 'landed') end as outcome
from routed join bounds using (topic, "partition")""",
    "two_topics_one_root": """
select case when "partition" < 2 then 'left' else 'right' end as topic, "partition", "offset", event_day, event_hour, value as line
from routed where reject_reason is null""",
    "stream_landing": _LANDED,
    "replay_idempotent": _LANDED,
    "committed_read": _TWO_BATCHES,
    "late_arrivals": f"""
select topic, event_day, event_hour, "partition", count(distinct start_offset) as n_batches, count(*) as n_lines
from ({_TWO_BATCHES}) group by all having count(distinct start_offset) > 1""",
    "mapper_transform": f"""
select {KEYS}, 'kind/' || string_split(value, ',')[3] as route, value as line
from fields where n_fields > 2""",
    "mapper_fanout": _FANOUT,
    "mapper_row_function": _FANOUT,
    "mapper_udtf": _FANOUT,
    "producer_payload": "select cast(event_id as varchar) as key, cast(event_id as varchar) as value from events",
    "produced_log": f"select {KEYS}, key, value from messages",
}

ORACLES: dict[str, str] = {name: _with(body).strip() for name, body in _BODIES.items()}
