from meterlens.operators.latest import latest_per_key
from meterlens.plans import query_log
from registry.base import ORDERS_AS_OF, oracle, query, report

_MONTHS = {"year": 1998, "months": [5, 6]}
_ONE_WAREHOUSE = {**_MONTHS, "warehouse": "WH_3"}

QUERIES = {
    "q01_duration_buckets": report(query_log.duration_buckets, "query_history"),
    "q01_duration_buckets_report": report(
        query_log.duration_buckets, "query_history", year=1998, months=[4], warehouse="WH_3"
    ),
    "q02_duration_bucket_lines": report(
        query_log.duration_bucket_lines, "query_history", year=1998
    ),
    "q02_duration_bucket_lines_report": report(
        query_log.duration_bucket_lines, "query_history", **_ONE_WAREHOUSE
    ),
    "q03_monthly_query_lines": report(query_log.monthly_query_lines, "query_history", year=1998),
    "q03_monthly_query_lines_report": report(
        query_log.monthly_query_lines, "query_history", **_ONE_WAREHOUSE
    ),
    "q04_monthly_type_lines": report(query_log.monthly_type_lines, "query_history", year=1998),
    "q04_monthly_type_lines_report": report(
        query_log.monthly_type_lines, "query_history", **_ONE_WAREHOUSE
    ),
    "q05_costliest_shapes": report(
        query_log.costliest_shapes, "query_history", "query_attribution_history",
        as_of=ORDERS_AS_OF,
    ),
    "q06_costly_runs": report(
        query_log.costly_runs, "query_history", "query_attribution_history", month=5
    ),
    "q07_failure_groups": report(query_log.failure_groups, "query_history", as_of=ORDERS_AS_OF),
    "q08_latest_per_key": query(
        lambda log: latest_per_key(
            log("query_history").select(
                "query_parameterized_hash", "query_id", "start_time", "query_text",
                "warehouse_name", "user_name", "role_name",
            ),
            ["query_parameterized_hash"],
            ["start_time", "query_id"],
        )
    ),
}

_BUCKET = """case when total_elapsed_time <= 60000 then '<60s'
  when total_elapsed_time <= 300000 then '60s-5m'
  when total_elapsed_time <= 600000 then '5m-10m'
  when total_elapsed_time <= 1800000 then '10m-30m' else '>30m' end"""


def _lines(parts: str, group: str, where: str) -> str:
    return oracle(f"""
select cast(month(start_time) as varchar) || {parts} || '|' || cast(count(query_id) as varchar) as line
from query_history where total_elapsed_time > 0 and {where}
group by month(start_time){group}""")


_YEAR = "year(start_time) = 1998"
_REPORT = "year(start_time) = 1998 and month(start_time) in (5, 6) and warehouse_name = 'WH_3'"

ORACLES = {
    "q01_duration_buckets": oracle(f"""
select {_BUCKET} as buckets, count(query_id) as number_of_queries
from query_history where total_elapsed_time > 0 group by 1"""),
    "q01_duration_buckets_report": oracle(f"""
select {_BUCKET} as buckets, count(query_id) as number_of_queries
from query_history where total_elapsed_time > 0 and year(start_time) = 1998
  and month(start_time) = 4 and warehouse_name = 'WH_3' group by 1"""),
    "q02_duration_bucket_lines": _lines(f"'|' || {_BUCKET}", f", {_BUCKET}", _YEAR),
    "q02_duration_bucket_lines_report": _lines(f"'|' || {_BUCKET}", f", {_BUCKET}", _REPORT),
    "q03_monthly_query_lines": _lines("''", "", _YEAR),
    "q03_monthly_query_lines_report": _lines("''", "", _REPORT),
    "q04_monthly_type_lines": _lines("'|' || query_type", ", query_type", _YEAR),
    "q04_monthly_type_lines_report": _lines("'|' || query_type", ", query_type", _REPORT),
    "q05_costliest_shapes": oracle("""
with ranked as (
  select *, row_number() over (partition by query_parameterized_hash
    order by start_time desc, query_id desc) as rn
  from query_history
  where start_time >= date '1998-06-01' and start_time < date '1998-07-02'),
runs as (
  select q.*, a.credits_attributed_compute as credits
  from query_history q left join (
    select * from query_attribution_history
    where start_time >= date '1998-06-01' and start_time < date '1998-07-02') a
  on q.query_id = a.query_id
  where q.start_time >= date '1998-06-01' and q.start_time < date '1998-07-02'),
totals as (
  select query_parameterized_hash as h,
    ((sum(total_elapsed_time) + 300) // 600) / 100.0 as total_execution_time_mins,
    count(query_id) as no_of_runs,
    ((sum(total_elapsed_time) + 300 * count(query_id)) // (600 * count(query_id))) / 100.0
      as avg_execution_time_mins,
    round(sum(credits) * 2.56, 2) as total_query_cost,
    avg(bytes_spilled_to_local_storage) as bytes_spilled_local,
    avg(bytes_spilled_to_remote_storage) as bytes_spilled_remote,
    avg(bytes_sent_over_the_network) as bytes_sent_over_network,
    sum(rows_produced) as total_rows_produced, avg(bytes_scanned) as total_bytes_scanned
  from runs group by query_parameterized_hash)
select cast(h as bigint) as query_parameterized_hash,
  cast(total_execution_time_mins as double) as total_execution_time_mins,
  cast(no_of_runs as bigint) as no_of_runs,
  cast(avg_execution_time_mins as double) as avg_execution_time_mins,
  cast(total_query_cost as double) as total_query_cost,
  bytes_spilled_local, bytes_spilled_remote, bytes_sent_over_network,
  cast(total_rows_produced as bigint) as total_rows_produced, total_bytes_scanned,
  query_text, warehouse_name, user_name, role_name
from totals join ranked on h = query_parameterized_hash and rn = 1
where total_query_cost is not null"""),
    "q06_costly_runs": oracle("""
select q.query_id, query_text,
  cast(total_elapsed_time as double) / 1000 / 60 as query_execution_time_mins,
  strftime(q.start_time, '%Y-%m-%d %H:%M:%S') as start_time,
  partitions_scanned, partitions_total,
  cast(credits_attributed_compute * 2.56 as double) as total_query_cost,
  user_name, warehouse_name
from query_history q join query_attribution_history a on q.query_id = a.query_id
where month(q.start_time) = 5 and credits_attributed_compute * 2.56 >= 500
  and partitions_scanned is not null"""),
    "q07_failure_groups": oracle("""
with failed as (
  select *, row_number() over (partition by error_code, error_message, query_type
    order by start_time, query_id) as rn
  from query_history where execution_status <> 'SUCCESS'
    and start_time >= date '1998-06-24' and start_time < date '1998-07-02')
select cast(error_code as bigint) as error_code, error_message, query_type,
  count(*) as failure_count,
  strftime(min(start_time), '%Y-%m-%d %H:%M:%S') as first_occurrence,
  strftime(max(start_time), '%Y-%m-%d %H:%M:%S') as last_occurrence,
  max(case when rn = 1 then query_text end) as example_query_text,
  max(case when rn = 1 then user_name end) as example_user,
  max(case when rn = 1 then role_name end) as example_role
from failed group by 1, 2, 3
order by failure_count desc, error_code, error_message, query_type limit 1000"""),
    "q08_latest_per_key": oracle("""
select cast(query_parameterized_hash as bigint) as query_parameterized_hash, query_id,
  strftime(start_time, '%Y-%m-%d %H:%M:%S') as start_time,
  query_text, warehouse_name, user_name, role_name
from query_history qualify row_number() over (partition by query_parameterized_hash
  order by start_time desc, query_id desc) = 1"""),
}
