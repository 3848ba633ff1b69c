"""The same results in SQL over the given tables, for every query that SQL can express."""

from __future__ import annotations

from landinglake.registry.fixtures import (BAD_TIME, BAD_TIME_BELOW, BLANK_BELOW, BROKEN_ENTITY,
                                           BROKEN_FROM, METADATA, SHORT_BELOW, SOURCES)
from landinglake.registry.queries import CLOCK

MICROS = "'%Y-%m-%d %H:%M:%S.%f'"
TS = f"strftime(ts, {MICROS})"
GOOD = f"value >= {BLANK_BELOW} and value < {BROKEN_FROM}"
READ_TS = f"case when value < {BAD_TIME_BELOW} then null else ts end"

EVENT_TEXT = f"""
    event_id, {TS} as ts, user_id, event_type, cast(cast({{value}} as decimal(38,6)) as varchar) as value,
    props"""

# One landing line as the fixture writes it, before it is spoilt.
LINE = f"""
    '{{"event_id":' || event_id || ',"ts":"' ||
    case when value >= {BLANK_BELOW} and value < {BAD_TIME_BELOW} then '{BAD_TIME}' else {TS} end ||
    '","userID":' || user_id || ',"Événement type":"' || event_type || '","value":' || value ||
    ',"props":"' || replace(props, '"', '\\"') || '","note":null}}'"""
BROKEN_LINE = f"substr({LINE}, 1, cast(floor(length({LINE}) / 2) as int))"


def _with(*names: str) -> str:
    tables = {s: s for s in SOURCES}
    return "with " + ", ".join(f"{n} as ({METADATA[n].format(**tables)})" for n in names)


def _event_text(value: str = "value") -> str:
    return EVENT_TEXT.format(value=value)


_LATEST = """
    select jobs_id, jobs_status as job_status from runs {where}
    qualify row_number() over (partition by jobs_id order by id desc) = 1"""

_READY = _with("runs", "jobs", "classes", "edges") + """,
  newest as ({latest}),
  parents as (
    select edges.jobs_id as job, count(newest.job_status) as total,
      count(*) filter (newest.job_status = 'S') as done,
      count(*) filter (newest.job_status = 'F') as broken,
      count(*) filter (newest.job_status = 'R') as ready,
      count(*) filter (newest.job_status = 'I') as busy
    from edges left join newest on newest.jobs_id = edges.parent_jobs_id group by edges.jobs_id)
  select runs.id as job_execution_id, process_execution_id, jobs_id as job_id,
    jobs.name as job_name, classes.name as execution_class, jobs_status as job_status,
    total as parent_jobs_total_count, done as parent_jobs_success_count,
    broken as parent_jobs_failed_count, ready as parent_jobs_ready_count,
    busy as parent_jobs_inprogess_count
  from runs, jobs, classes, parents
  where jobs_status = 'R' and jobs_id = jobs.id and jobs_id = job
    and jobs_execution_class_id = classes.id {own}"""

_PARAMS = _with("jobs", "classes", "class_params", "edges", "processes", "subscribers",
                "applications", "job_values") + """,
  owners as (
    select processes.id as process_id, subscribers.name as subscriber,
      applications.name as application
    from processes, subscribers, applications
    where subsriber_id = subscribers.id and applications_id = applications.id),
  settings as (
    select jobs.id as job_id, jobs.name as job_name, class_params.id as param_id,
      lower(class_params.name) as param_key, default_param_value,
      cast(is_mandatory as bigint) as is_mandatory
    from jobs, class_params
    where jobs.jobs_execution_class_id = class_params.jobs_execution_class_id
      and jobs.jobs_execution_class_id in (select id from classes)),
  valued as (
    select settings.*, coalesce(param_value, default_param_value) as raw
    from settings left join job_values
      on job_id = jobs_id and param_id = jobs_execution_class_param_id)
  select {key} job_id, job_name, param_key, is_mandatory,
    replace(replace(raw, '<application>', application), '<subscriber>', subscriber) as param_value
  from valued, owners
  where (process_id, job_id) in (select process_id, jobs_id from edges) {where}"""

_STEPS = """
    select o_orderkey, 'customer ' || o_custkey as entity, 'extract' as step,
      strftime(o_orderdate, {m}) as start_dt,
      strftime(o_orderdate + interval 90 seconds, {m}) as end_dt,
      'Success' as status, cast(null as varchar) as description
    from orders where o_orderstatus <> 'P'
    union all
    select o_orderkey, 'customer ' || o_custkey, 'load',
      strftime(o_orderdate + interval 90 seconds, {m}),
      strftime(o_orderdate + interval 90 seconds, {m}),
      case when o_orderpriority = '1-URGENT' then 'Failed: late' else 'Success' end,
      'says "' || o_orderpriority || '"'
    from orders where o_orderstatus <> 'P'""".format(m=MICROS)

_HOURS = f"""
    event_type as entity, event_id, strftime({READ_TS}, {MICROS}) as ts, user_id,
    event_type as evenement_type, cast(cast(value as decimal(38,6)) as varchar) as value, props,
    cast(11 as bigint) as process_execution_id, year({READ_TS}) as year,
    month({READ_TS}) as month, day({READ_TS}) as day, hour({READ_TS}) as hour"""


def _changed(status: str, start: str, end: str, new: str, touched: str, times: dict[str, str]
             ) -> str:
    """Run table after the changes; ``times`` says which rows got which time."""
    def time(column: str) -> str:
        return f"case when {times[column]} then '{CLOCK}' end as {column}" if column in times \
            else f"cast(null as varchar) as {column}"
    return _with("runs") + f"""
      select id, process_execution_id, jobs_id, {new} as {status}, {time(start)}, {time(end)},
        case when {touched} then '{CLOCK}' end as updated_dt,
        case when {touched} then 'landinglake' else 'setup' end as updated_by
      from runs"""


_READY_RUN = "jobs_status = 'R'"
_TWICE = "jobs_status = 'R' and process_execution_id < 5"

_COLUMN_PROFILE = " union all ".join(
    f"select '{name}' as column_name, count({column}) as non_null_cnt from events"
    for name, column in {
        "event_id": "event_id", "ts": "ts", "user_id": "user_id", "event_type": "event_type",
        "value": "case when event_type <> 'view' then value end", "props": "props",
        "is_large": "case when event_type = 'view' then value end",
        "late_ts": "case when value > 50 then ts end",
        "tags": "case when event_type <> 'view' then 1 end",
        "origin": "case when event_type = 'view' then 1 end"}.items())

_TAKEN = "event_type <> 'signup'"
_LOADED = f"event_type <> '{BROKEN_ENTITY}' and {GOOD}"

ORACLES: dict[str, str] = {
    "landing_accept": f"""
        select event_id, case when value < {BAD_TIME_BELOW} then '{BAD_TIME}' else {TS} end as ts,
          user_id, event_type as evenement_type, value, props from events where {GOOD}""",
    "reject_counts": f"""
        select count(*) as records_cnt, count(case when value >= {BROKEN_FROM} then 1 end)
          as reject_records_cnt, min(value) >= {BROKEN_FROM} as all_rejected from events""",
    "reject_lines": f"""
        select {BROKEN_LINE} as _corrupt_record, cast(7 as bigint) as process_execution_id
        from events where value >= {BROKEN_FROM}""",
    "all_rejected": f"""
        select event_type as entity, count(*) as records_cnt,
          count(case when event_type = '{BROKEN_ENTITY}' or value >= {BROKEN_FROM} then 1 end)
            as reject_records_cnt,
          bool_and(event_type = '{BROKEN_ENTITY}' or value >= {BROKEN_FROM}) as all_rejected
        from events group by event_type""",
    "landing_entities": """
        select distinct event_type as entity from events where event_type <> 'signup'""",
    "lineage_counts": """
        select event_type as entity, count(*) as records from events group by event_type""",
    "csv_rejects": f"""
        select s_suppkey, s_name,
          case when s_acctbal >= {SHORT_BELOW} then cast(s_nationkey as bigint) end as s_nationkey,
          case when s_acctbal >= {SHORT_BELOW} then s_acctbal end as s_acctbal,
          case when s_acctbal < {SHORT_BELOW} then s_suppkey || ',' || s_name end as rejected_line
        from supplier""",
    "column_profile": _COLUMN_PROFILE,
    "drop_null_columns": f"""
        select event_id, {TS} as ts, user_id, event_type, cast(value as varchar) as value, props
        from events""",
    "drop_blank_rows": """
        select event_id, user_id, event_type, value, props,
          cast(3 as bigint) as process_execution_id
        from events where event_type <> 'click'""",
    "sanitize_columns": """
        select s_suppkey as ssuppkey, s_name as s_name, s_nationkey, s_acctbal
        from supplier""",
    "sanitize_values": r"""
        select doc_id, lower(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(
          strip_accents(text)), '\p{Mn}+', '', 'g'), '[^A-Za-z0-9_]+', '_', 'g'),
          '([a-z0-9])([A-Z])', '\1_\2', 'g')) as clean from documents""",
    "parse_time": f"""
        select event_id, case when event_type <> 'error' then {TS} end as ts from events""",
    "time_partitions": """
        select event_id, year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour
        from events""",
    "align_schema": """
        select l_orderkey, l_suppkey, l_linestatus, cast(trunc(l_quantity) as bigint) as l_quantity,
          try_cast(l_returnflag as bigint) as l_returnflag, l_tax,
          cast(l_linenumber as varchar) as l_linenumber,
          cast(cast(l_partkey as decimal(38,6)) as varchar) as l_partkey,
          cast(cast(l_extendedprice as decimal(38,6)) as varchar) as l_extendedprice,
          cast(cast(l_discount as decimal(38,6)) as varchar) as l_discount,
          'decimal(38,6)' as price_type,
          'l_partkey,l_linenumber,l_quantity,l_tax,l_returnflag' as first_columns
        from lineitem""",
    "lost_values": """
        select count(*) - count(try_cast(l_returnflag as bigint)) as lost from lineitem""",
    "lake_append": f"select {_event_text()} from events",
    "lake_overwrite": f"select {_event_text()} from events where day(ts) > 3",
    "lake_dynamic": f"""
        select {_event_text('case when day(ts) <= 15 then -value else value end')} from events""",
    "plain_files": """
        select event_type, count(*) as records, max(value) as max_value
        from events group by event_type""",
    "schema_evolution": """
        select event_id, user_id, cast(cast(value as decimal(38,6)) as varchar) as value,
          event_type, cast(null as varchar) as kind from events
        union all
        select event_id, case when event_type <> 'view' then user_id end,
          cast(cast(value as decimal(38,6)) as varchar), cast(null as varchar), event_type
        from events""",
    "array_columns": """
        select vec_id, cast(label as bigint) as label, cast(len(embedding) as bigint) as dims,
          array_to_string([cast(round(cast(x as double) * 1000000) as bigint)
            for x in embedding], ',') as millionths from embeddings""",
    "bulk_write": """
        select year(l_shipdate) as year, month(l_shipdate) as month, count(*) as records,
          cast(sum(cast(l_quantity as decimal(38,6))) as varchar) as quantity
        from lineitem group by 1, 2""",
    "bulk_profile": " union all ".join(
        f"select '{c}' as column_name, count({c}) as non_null_cnt from lineitem" for c in (
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_shipdate")),
    "partition_pruned": """
        select day(ts) as day, count(*) as records, count(distinct user_id) as users
        from events where year(ts) = 2024 and month(ts) = 1 and day(ts) between 10 and 12
        group by day(ts)""",
    "partition_tuples": """
        select distinct year(ts) as year, month(ts) as month, day(ts) as day, hour(ts) as hour
        from events""",
    "partition_summary": """
        select distinct 'lake/events/year=' || year(ts) || '/month=' || month(ts) || '/day=' ||
            day(ts) || '/hour=' || hour(ts) || '/' as prefix,
          year(ts) || '|' || month(ts) || '|' || day(ts) || '|' || hour(ts) as values
        from events""",
    "table_partitions": """
        select distinct case when event_type = 'error' then 'year=__HIVE_DEFAULT_PARTITION__/'
            || 'month=__HIVE_DEFAULT_PARTITION__/day=__HIVE_DEFAULT_PARTITION__'
          else 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts) end as partition
        from events""",
    "schema_rows": """
        select column_name, case data_type when 'DOUBLE' then 'decimal(38,6)'
            when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz'
            else lower(data_type) end as data_type,
          'raw_events' as entity, cast(5 as bigint) as process_execution_id
        from information_schema.columns where table_name = 'events'""",
    "run_entities": _with("mapping") + """
        select distinct entity from mapping where process_execution_id = 3""",
    "job_params": _PARAMS.format(key="cast(process_id as bigint) as process_id,", where=""),
    "job_params_of_process": _PARAMS.format(key="", where="and process_id = 3"),
    "latest_status": _with("runs") + _LATEST.format(where=""),
    "latest_status_of_run": _with("runs") + _LATEST.format(where="where process_execution_id = 3"),
    "ready_jobs": _READY.format(latest=_LATEST.format(where="where process_execution_id = 3"), own=""),
    "ready_jobs_any_run": _READY.format(latest=_LATEST.format(where=""), own=""),
    "ready_jobs_own_run": _READY.format(
        latest=_LATEST.format(where="where process_execution_id = 3"),
        own="and process_execution_id = 3"),
    "timeline_entities": _with("timeline", "narrations", "fields") + """
        select distinct entity from timeline where status = 'Enabled'
          and entity in (select entity from narrations) and entity in (select entity from fields)""",
    "status_start": _changed(
        "jobs_status", "jobs_start_dt", "jobs_end_dt",
        f"case when {_TWICE} then 'W' when {_READY_RUN} then 'I' else jobs_status end",
        _READY_RUN, {"jobs_start_dt": _READY_RUN}),
    "status_end": _changed(
        "jobs_status", "jobs_start_dt", "jobs_end_dt",
        f"case when {_TWICE} then 'S' when {_READY_RUN} then 'I' else jobs_status end",
        _READY_RUN, {"jobs_end_dt": _READY_RUN}),
    "process_status": _changed(
        "status", "process_start_dt", "process_end_dt",
        f"case when {_TWICE} then 'S' when {_READY_RUN} then 'I' else jobs_status end",
        _READY_RUN, {"process_start_dt": _READY_RUN, "process_end_dt": _TWICE}),
    "step_rows": _STEPS,
    "step_failures": f"""
        select entity, bool_or(contains(status, 'Failed')) as any_failed from ({_STEPS})
        group by entity""",
    "first_steps": f"""
        select entity, step, start_dt, end_dt, status, description from ({_STEPS})
        where o_orderkey = (select min(o_orderkey) from orders where o_orderstatus <> 'P')""",
    "status_fold": _with("runs") + """
        select process_execution_id, jobs_id, bool_and(jobs_status <> 'F' and id % 7 <> 0) as ok
        from runs group by process_execution_id, jobs_id""",
    "job_status_fold": _with("runs") + """
        select jobs_id, bool_and(jobs_status = 'S') as ok from runs group by jobs_id""",
    "bulk_load": "select doc_id, text, lang, source, n_chars from documents",
    "empty_like": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier where false",
    "purge_sources": """
        select event_type as entity, (select max(event_id) from events) as event_id
        from events group by event_type""",
    "late_arrival": f"""
        select event_id, cast(null as varchar) as fresh from events
        where event_type = 'view' and value >= {BLANK_BELOW} and value < {BROKEN_FROM}
        union all
        select event_id, upper(event_type) from events where event_type <> 'view'""",
    "insert_rows": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier",
    "staged_publish": f"select {_event_text()} from events",
    "ingest_all": f"select {_HOURS} from events where {_LOADED} and {_TAKEN}",
    "ingest_audit": f"""
        select event_type as entity, step, case when step = 'raw_data_to_datalake' and
            event_type = '{BROKEN_ENTITY}' then 'Failed' else 'Success' end as status,
          case when step = 'raw_data_to_datalake' then count(*) end as records_cnt,
          case when step = 'raw_data_to_datalake' then
            count(case when event_type = '{BROKEN_ENTITY}' or value >= {BROKEN_FROM} then 1 end)
            end as reject_records_cnt,
          case when step <> 'raw_data_to_datalake' then null
            when event_type = '{BROKEN_ENTITY}' then event_type || ': all records are malformed'
            when count(case when value >= {BLANK_BELOW} and value < {BAD_TIME_BELOW} then 1 end) > 0
            then count(case when value >= {BLANK_BELOW} and value < {BAD_TIME_BELOW} then 1 end)
              || ' values did not fit their type' end as description,
          cast(21 as bigint) as jobs_execution_id, true as in_order
        from events join (values ('Load_datalake'), ('Update_glue_schema'),
          ('raw_data_to_datalake')) steps(step)
          on event_type <> '{BROKEN_ENTITY}' or step = 'raw_data_to_datalake'
        where {_TAKEN} group by event_type, step""",
    "ingest_schema_rows": f"""
        select column_name, data_type, event_type as entity,
          cast(11 as bigint) as process_execution_id
        from (select distinct event_type from events
            where event_type <> '{BROKEN_ENTITY}' and {_TAKEN}),
          (values ('event_id', 'bigint'), ('ts', 'timestamp'), ('user_id', 'bigint'),
            ('evenement_type', 'string'), ('value', 'decimal(38,6)'), ('props', 'string'),
            ('source_file_name', 'string')) types(column_name, data_type)""",
    "ingest_rejects": f"""
        select event_type as entity, cast(11 as bigint) as process_execution_id,
          count(*) as rejects, cast(sum(length({BROKEN_LINE})) as bigint) as characters
        from events where {_TAKEN} and (event_type = '{BROKEN_ENTITY}' or value >= {BROKEN_FROM})
        group by event_type""",
    "ingest_status": f"""
        select distinct event_type as entity, true as ok, true as run_ok,
          cast(0 as bigint) as files_left from events where {_TAKEN}""",
    "curated_layer": f"""
        select event_type as evenement_type, month({READ_TS}) as month, day({READ_TS}) as day,
          count(*) as records, count(distinct user_id) as users
        from events where {_LOADED} and {_TAKEN} group by 1, 2, 3""",
    "timeline_layer": f"""
        select o_custkey as customer, count(*) as orders,
          strftime(min(o_orderdate), {MICROS}) as first_order, o_orderstatus as entity
        from orders where o_orderstatus <> 'P' group by o_custkey, o_orderstatus""",
    "container_timeline_layer": f"""
        select o_orderpriority as priority, count(*) as orders,
          strftime(max(o_orderdate), {MICROS}) as last_order, o_orderstatus as entity
        from orders where o_orderstatus <> 'P' group by o_orderpriority, o_orderstatus""",
    "procedure_layer": """
        select o_orderpriority as entity, o_orderpriority < '4' and o_orderpriority >= '2' as ok,
          case when o_orderpriority < '4' then 'count' end as step,
          case when o_orderpriority < '2' then 'Failed'
            when o_orderpriority < '4' then 'Success' end as status,
          case when o_orderpriority < '4' then cast(count(*) as varchar) end as description
        from orders group by o_orderpriority""",
    "incremental": f"""
        select event_id, strftime({READ_TS}, {MICROS}) as ts, user_id,
          event_type as evenement_type, cast(cast(value as decimal(38,6)) as varchar) as value,
          props from events where {_LOADED}""",
    "flagship": f"""
        select year(ts) as year, month(ts) as month, day(ts) as day, count(*) as records,
          count(distinct user_id) as users,
          cast(sum(cast(value as decimal(38,6))) as varchar) as total_value
        from events where value >= {BAD_TIME_BELOW} and value < {BROKEN_FROM} group by 1, 2, 3""",
}
# The same rows, however they have come in.
ORACLES["ledger_reload"] = ORACLES["incremental"]
ORACLES["incremental_nested"] = f"""
    select r.*, how, case when evenement_type in ('view', 'error') then 'first' else 'second' end
      as arrival
    from ({ORACLES['incremental']}) r, (values ('stream'), ('batch')) as h(how)"""
ORACLES["swap_overwrite"] = """
    select cast(i as bigint) as overwrite, count_if(i = 0 or day(ts) > 5 * i) as before,
      count_if(day(ts) > 5 * i + 5) as after
    from events, (values (0), (1), (2)) as o(i) group by i"""
ORACLES["journal_undo"] = """
    select 'column' as kind, column_name as name from information_schema.columns
    where table_name = 'events'
    union all select 'column', unnest(['year', 'month', 'day'])
    union all select distinct 'partition',
      'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts)
    from events where day(ts) <= 20
    union all select 'rows', day(ts) || ': ' || count(*) from events where day(ts) <= 20
    group by day(ts)"""
ORACLES["incremental_all"] = ORACLES["curated_layer"]
