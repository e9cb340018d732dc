from meterlens.plans import warehouse
from registry.base import EVENTS_AS_OF, ORDERS_AS_OF, oracle, report

_METERED = ("warehouse_metering_history", "warehouse_load_history")

QUERIES = {
    "w01_credit_trend_monthly": report(
        warehouse.credit_trend, "warehouse_credits", "warehouses", as_of=ORDERS_AS_OF
    ),
    "w02_credit_trend_weekly": report(
        warehouse.credit_trend, "warehouse_credits", "warehouses", as_of=ORDERS_AS_OF, unit="week"
    ),
    "w03_load_minutes": report(
        warehouse.load_minutes, "warehouse_load_history", as_of=EVENTS_AS_OF, like="%WH%"
    ),
    "w04_load_minutes_daily": report(
        warehouse.load_minutes, "warehouse_load_history", as_of=EVENTS_AS_OF, like="%WH%",
        by="usage_date",
    ),
    "w05_daily_utilisation": report(
        warehouse.daily_utilisation, *_METERED, as_of=EVENTS_AS_OF
    ),
    "w06_sized_utilisation": report(
        warehouse.sized_utilisation, *_METERED, "warehouses", as_of=EVENTS_AS_OF
    ),
    "w06_sized_utilisation_daily": report(
        warehouse.sized_utilisation, *_METERED, "warehouses", as_of=EVENTS_AS_OF, daily=True
    ),
    "w07_queries_inside": report(
        warehouse.queries_inside, "warehouse_metering_history", "query_activity"
    ),
    "w07_idle_gaps": report(
        warehouse.idle_gaps, "warehouse_metering_history", "query_activity"
    ),
    "w07_idle_gaps_report": report(
        warehouse.idle_gaps, "warehouse_metering_history", "query_activity", day="2024-01-15",
        warehouse="WH_3",
    ),
}


def _trend(unit: str, starts: list[str], select: str) -> str:
    names = [f"{unit}_4", f"{unit}_3", f"{unit}_2", f"last_{unit}", f"current_{unit}"]
    columns = ", ".join(
        f"max(case when period = date '{start}' then credits else 0 end) as {name}"
        for start, name in zip(starts, names)
    )
    return oracle(f"""
with periods as (
  select warehouse_name, cast(date_trunc('{unit}', start_time) as date) as period,
    sum(credits_used) as credits
  from warehouse_credits
  where warehouse_name in (select name from warehouses)
    and start_time >= date '{starts[0]}' and start_time < date '1998-07-02' group by 1, 2),
trend as (select warehouse_name, {columns} from periods group by 1)
select warehouse_name, {select} from trend""")


def _change(newer: str, older: str) -> str:
    return f"""case when {older} > 0 then
  round(cast({newer} - {older} as double) / cast({older} as double) * 100, 2) end as percent_change"""


_MINUTES = """
with measured as (
  select warehouse_name, cast(start_time as date) as usage_date,
    date_diff('second', start_time, end_time) as uptime,
    avg_running + avg_queued_load + avg_queued_provisioning + avg_blocked as busy
  from warehouse_load_history where warehouse_name like '%WH%'
    and start_time >= date '2024-01-24' and start_time < date '2024-01-31')
select {0}, sum(uptime) / 60.0 as total_wh_uptime_mins,
  cast(sum(uptime * busy) as double) / 60 as total_running_mins,
  cast(sum(uptime * (1 - busy)) as double) / 60 as total_idle_mins
from measured group by {0}"""

_EXECUTED = """executed as (
  select warehouse_name as wh, cast(start_time as date) as day,
    sum(execution_time) as execution_seconds
  from warehouse_load_history
  where start_time >= date '2024-01-23' and start_time < date '2024-01-31' group by 1, 2)"""
_SHARE = """
select warehouse_name, usage_date, round(share, 2) as utilization_percent,
  round(100 - share, 2) as idle_percent
from (select *, coalesce(cast(execution_seconds as double), 0) / nullif({0}, 0) * 100 as share
  from usage left join executed on wh = warehouse_name and day = usage_date) s"""


def _sized(credits: str, group: str) -> str:
    return oracle(f"""
with sizes as (select * from (values ('XSMALL', 0.25), ('SMALL', 0.5), ('MEDIUM', 1), ('LARGE', 2),
    ('XLARGE', 4), ('2XLARGE', 8), ('3XLARGE', 16), ('4XLARGE', 32)) v(size_name, multiplier)),
usage as (
  select m.warehouse_name, cast(m.start_time as date) as usage_date, {credits} as credits,
    cast(multiplier as double) as multiplier
  from warehouse_metering_history m join warehouses w on m.warehouse_name = w.name
  join sizes on size_name = w.size
  where m.start_time >= date '2024-01-23' and m.start_time < date '2024-01-31' {group}),
{_EXECUTED}
{_SHARE.format('cast(credits as double) / multiplier * 3600')}""")


_GAPS = """
select m.warehouse_name,
  strftime(m.start_time, '%Y-%m-%d %H:%M:%S') as warehouse_start_time,
  strftime(m.end_time, '%Y-%m-%d %H:%M:%S') as warehouse_end_time,
  strftime(min(q.start_time), '%Y-%m-%d %H:%M:%S') as next_query_start_time,
  min(epoch_us(date_trunc('second', q.start_time)) // 1000000
    - epoch_us(date_trunc('second', m.end_time)) // 1000000) as idle_seconds,
  count(*) as later_queries
from (select distinct warehouse_name, start_time, end_time from warehouse_metering_history) m
join query_activity q on q.warehouse_name = m.warehouse_name
  and cast(q.start_time as date) = cast(m.start_time as date)
  and date_trunc('second', q.start_time) > date_trunc('second', m.end_time)
where m.start_time <= m.end_time {0}
group by m.warehouse_name, m.start_time, m.end_time"""

_ALL_GAPS = """
with intervals as (
  select distinct warehouse_name, start_time, end_time from warehouse_metering_history
  where start_time <= end_time),
nearest as (
  select m.warehouse_name, m.start_time, m.end_time, min(q.start_time) as next_start
  from intervals m join query_activity q on q.warehouse_name = m.warehouse_name
    and date_trunc('second', q.start_time) > date_trunc('second', m.end_time)
  group by 1, 2, 3)
select n.warehouse_name,
  strftime(n.start_time, '%Y-%m-%d %H:%M:%S') as warehouse_start_time,
  strftime(n.end_time, '%Y-%m-%d %H:%M:%S') as warehouse_end_time,
  strftime(n.next_start, '%Y-%m-%d %H:%M:%S') as next_query_start_time,
  epoch_us(date_trunc('second', n.next_start)) // 1000000
    - epoch_us(date_trunc('second', n.end_time)) // 1000000 as idle_seconds,
  count(*) as later_queries
from nearest n join query_activity q on q.warehouse_name = n.warehouse_name
  and cast(q.start_time as date) = cast(n.next_start as date)
  and date_trunc('second', q.start_time) > date_trunc('second', n.end_time)
group by n.warehouse_name, n.start_time, n.end_time, n.next_start"""

ORACLES = {
    "w01_credit_trend_monthly": _trend(
        "month", ["1998-03-01", "1998-04-01", "1998-05-01", "1998-06-01", "1998-07-01"],
        ", ".join(
            f"cast({name} * 2.56 as double) as {name}_costs"
            for name in ("month_4", "month_3", "month_2", "last_month", "current_month")
        ) + ", " + _change("current_month", "last_month"),
    ),
    "w02_credit_trend_weekly": _trend(
        "week", ["1998-06-01", "1998-06-08", "1998-06-15", "1998-06-22", "1998-06-29"],
        ", ".join(
            f"cast({name} as double) as {name}"
            for name in ("week_4", "week_3", "week_2", "last_week")
        ) + ", " + _change("last_week", "week_2"),
    ),
    "w03_load_minutes": oracle(_MINUTES.format("warehouse_name")),
    "w04_load_minutes_daily": oracle(_MINUTES.format("usage_date")),
    "w05_daily_utilisation": oracle(f"""
with usage as (
  select warehouse_name, cast(start_time as date) as usage_date,
    sum(credits_used_compute) as credits
  from warehouse_metering_history
  where start_time >= date '2024-01-23' and start_time < date '2024-01-31' group by 1, 2),
{_EXECUTED}
{_SHARE.format('cast(credits as double) * 3600')}"""),
    "w06_sized_utilisation": _sized("m.credits_used_compute", ""),
    "w06_sized_utilisation_daily": _sized("sum(m.credits_used_compute)", "group by 1, 2, 4"),
    "w07_queries_inside": oracle("""
select m.warehouse_name, strftime(m.start_time, '%Y-%m-%d %H:%M:%S') as warehouse_start_time,
  strftime(m.end_time, '%Y-%m-%d %H:%M:%S') as warehouse_end_time, count(q.start_time) as queries,
  strftime(min(q.start_time), '%Y-%m-%d %H:%M:%S') as first_query_start_time,
  strftime(max(q.start_time), '%Y-%m-%d %H:%M:%S') as last_query_start_time
from (select distinct warehouse_name, start_time, end_time from warehouse_metering_history) m
left join query_activity q on q.warehouse_name = m.warehouse_name
  and q.start_time between m.start_time and m.end_time
group by m.warehouse_name, m.start_time, m.end_time"""),
    "w07_idle_gaps": oracle(_ALL_GAPS),
    "w07_idle_gaps_report": oracle(
        _GAPS.format(
            "and cast(m.start_time as date) = date '2024-01-15' and m.warehouse_name = 'WH_3'"
        )
    ),
}
