from meterlens.plans import operator_metrics as metrics
from meterlens.sources.workdir import work_folder
from registry.base import ORDERS_AS_OF, oracle, query, report

import datetime as dt

_LOGS = ("query_history", "query_operator_stats")


def _metric(plan):
    return report(plan, *_LOGS, as_of=ORDERS_AS_OF)


def _counts(plan):
    return query(
        lambda log: plan(*map(log, _LOGS), as_of=ORDERS_AS_OF).select("counts.*")
    )


def _loaded(log):
    """Four daily runs: one that expires, one that stays, the day itself and a repeat."""
    history, operators = map(log, _LOGS)
    store = work_folder(history.sparkSession, "metric-summary")
    for age in (3, 1, 0, 0):
        day = ORDERS_AS_OF - dt.timedelta(days=age)
        loaded = metrics.load_metric_summary(store, history, operators, day)
    return loaded


QUERIES = {
    "m01_exploding_counts": _counts(metrics.exploding_counts),
    "m02_exploding_queries": _metric(metrics.exploding_queries),
    "m03_spill_counts": _counts(metrics.spill_counts),
    "m04_spill_queries": _metric(metrics.spill_queries),
    "m05_pruning_counts": _counts(metrics.pruning_counts),
    "m06_pruning_queries": _metric(metrics.pruning_queries),
    "m07_union_distinct_counts": _counts(metrics.union_distinct_counts),
    "m08_union_distinct_queries": _metric(metrics.union_distinct_queries),
    "m09_operator_metric_summary": _metric(metrics.operator_metric_summary),
    "m10_load_metric_summary": query(_loaded),
    "m11_slowest_queries": report(
        metrics.slowest_queries, "query_history", as_of=ORDERS_AS_OF, min_age=0, max_age=6
    ),
}


def _rows(as_of: str, name: str = "flagged") -> str:
    """Flagged operators of the slowest queries at one date."""
    return f"""{name}_ids as (
  (select query_id, '7_days' as win from query_history
   where start_time >= date '{as_of}' - interval 6 day
     and start_time < date '{as_of}' + interval 1 day
   order by total_elapsed_time desc, query_id limit 100)
  union all
  (select query_id, '8_14_days' from query_history
   where start_time >= date '{as_of}' - interval 14 day
     and start_time < date '{as_of}' - interval 7 day
   order by total_elapsed_time desc, query_id limit 100)),
{name}_stats as (
  select o.query_id, win, operator_type,
    lag(operator_type) over (partition by o.query_id order by operator_id, step_id) as previous,
    cast(json_extract(operator_statistics, '$.input_rows') as bigint) as input_rows,
    cast(json_extract(operator_statistics, '$.output_rows') as bigint) as output_rows,
    cast(json_extract(operator_statistics, '$.spilling.bytes_spilled_local_storage') as bigint) as spilled_local,
    cast(json_extract(operator_statistics, '$.spilling.bytes_spilled_remote_storage') as bigint) as spilled_remote,
    cast(json_extract(operator_statistics, '$.pruning.partitions_scanned') as bigint) as scanned,
    cast(json_extract(operator_statistics, '$.pruning.partitions_total') as bigint) as total
  from query_operator_stats o join {name}_ids i on o.query_id = i.query_id),
{name} as (
  select query_id, win,
    case when input_rows > 0 and output_rows > input_rows then 1 else 0 end as exploding_join,
    case when operator_type = 'UnionAll' and previous = 'Aggregate' then 1 else 0 end as union_without_all,
    case when spilled_local > 0 or spilled_remote > 0 then 1 else 0 end as queries_too_large_memory,
    case when total >= 20000 and scanned * 10 >= total * 8 then 1 else 0 end as inefficient_pruning
  from {name}_stats)"""


def _count_oracle(flag: str) -> str:
    return oracle(f"""
with {_rows('1998-07-01')}
select count(*) filter (where win = '7_days') as "7_days",
  count(*) filter (where win = '8_14_days') as "8_14_days"
from flagged where {flag} = 1""")


def _query_oracle(flag: str) -> str:
    return oracle(f"""
with {_rows('1998-07-01')}
select distinct query_id from flagged where win = '7_days' and {flag} = 1""")


def _summary(name: str, day: str) -> str:
    return f"""select query_id, win as "window",
  cast(sum(exploding_join) as bigint) as exploding_join,
  cast(sum(union_without_all) as bigint) as union_without_all,
  cast(sum(queries_too_large_memory) as bigint) as queries_too_large_memory,
  cast(sum(inefficient_pruning) as bigint) as inefficient_pruning,
  date '{day}' as load_date
from {name} group by query_id, win"""


ORACLES = {
    "m01_exploding_counts": _count_oracle("exploding_join"),
    "m02_exploding_queries": _query_oracle("exploding_join"),
    "m03_spill_counts": _count_oracle("queries_too_large_memory"),
    "m04_spill_queries": _query_oracle("queries_too_large_memory"),
    "m05_pruning_counts": _count_oracle("inefficient_pruning"),
    "m06_pruning_queries": _query_oracle("inefficient_pruning"),
    "m07_union_distinct_counts": _count_oracle("union_without_all"),
    "m08_union_distinct_queries": _query_oracle("union_without_all"),
    "m09_operator_metric_summary": oracle(
        f"with {_rows('1998-07-01')} {_summary('flagged', '1998-07-01')}"
    ),
    "m10_load_metric_summary": oracle(
        f"with {_rows('1998-06-30', 'before')}, {_rows('1998-07-01', 'today')} "
        f"{_summary('before', '1998-06-30')} union all {_summary('today', '1998-07-01')}"
    ),
    "m11_slowest_queries": oracle("""
select query_id, total_elapsed_time from query_history
where start_time >= date '1998-06-25' and start_time < date '1998-07-02'
order by total_elapsed_time desc, query_id limit 100"""),
}
