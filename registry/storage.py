from meterlens.plans import storage
from registry.base import ORDERS_AS_OF, oracle, query, report

_HALF_YEAR = {"year": 1998, "months": [1, 2, 3, 4, 5, 6]}
_COLUMNS = {
    1: "jan_98_size", 2: "feb_98_size", 3: "mar_98_size", 4: "apr_98_size", 5: "may_98_size",
    6: "jun_98_size",
}

QUERIES = {
    "s01_database_sizes": report(
        storage.database_sizes, "database_storage_usage_history", **_HALF_YEAR
    ),
    "s02_database_sizes_wide": query(
        lambda log: storage.database_sizes_wide(
            storage.database_sizes(log("database_storage_usage_history"), **_HALF_YEAR), _COLUMNS
        )
    ),
    "s03_table_storage_cost": report(
        storage.table_storage_cost, "table_storage_metrics", "automatic_clustering_history",
        as_of=ORDERS_AS_OF,
    ),
    "s04_org_storage_cost": report(
        storage.org_storage_cost, "database_storage_usage_history", start="1997-06-01",
        end="1998-08-01", exclude=["ACC_2"],
    ),
}

_SIZES = """sizes as (
select database_name, month(usage_date) as usage_month,
  max(round(average_database_bytes / power(2, 40), 1)) as database_size_tb,
  max(round(average_failsafe_bytes / power(2, 40), 1)) as failsafe_size_tb
from database_storage_usage_history
where month(usage_date) in (1, 2, 3, 4, 5, 6) and year(usage_date) = 1998 group by 1, 2)"""


def _wide(measure: str, title: str) -> str:
    columns = ", ".join(
        f"max(case when usage_month = {month} then {measure} end) as {name}"
        for month, name in _COLUMNS.items()
    )
    return f"select database_name, '{title}' as measure, {columns} from sizes group by 1"


ORACLES = {
    "s01_database_sizes": oracle(f"""
with {_SIZES}
select database_name, cast(usage_month as bigint) as usage_month, database_size_tb, failsafe_size_tb
from sizes"""),
    "s02_database_sizes_wide": oracle(f"""
with {_SIZES}
{_wide('database_size_tb', 'Average Active Size in TB')}
union
{_wide('failsafe_size_tb', 'Average Failsafe Size in TB')}"""),
    "s03_table_storage_cost": oracle("""
with stored as (
  select id, table_catalog, table_schema, table_name,
    cast(round(sum(active_bytes) / 1099511627776, 10) as decimal(24,10)) as active,
    cast(round(sum(failsafe_bytes) / 1099511627776, 10) as decimal(24,10)) as failsafe,
    cast(round(sum(time_travel_bytes) / 1099511627776, 10) as decimal(24,10)) as travel
  from table_storage_metrics where not deleted group by 1, 2, 3, 4),
clustered as (
  select table_id, database_name, schema_name, table_name, sum(credits_used) as credits
  from automatic_clustering_history
  where date_trunc('month', start_time) = date '1998-06-01' group by 1, 2, 3, 4)
select table_catalog, table_schema, s.table_name,
  cast(active as double) as total_active_bytes_in_tb,
  cast(active * 16.86 as double) as total_active_cost_per_month,
  cast(failsafe as double) as total_failsafe_bytes_in_tb,
  cast(failsafe * 16.86 as double) as total_failsafe_cost_per_month,
  cast(travel as double) as total_time_travel_bytes_in_tb,
  cast(travel * 16.86 as double) as total_time_travel_cost_per_month,
  cast(coalesce(credits, 0) as double) as total_auto_clustering_credits,
  cast(coalesce(credits * 2.32, 0) as double) as total_auto_clustering_cost
from stored s left join clustered on id = table_id"""),
    "s04_org_storage_cost": oracle("""
with daily as (
  select account_name, cast(date_trunc('month', usage_date) as date) as usage_month, database_name,
    max(average_database_bytes + average_hybrid_table_storage_bytes) as stored,
    max(average_failsafe_bytes) as failsafe
  from database_storage_usage_history
  where usage_date >= date '1997-06-01' and usage_date < date '1998-08-01'
    and account_name not in ('ACC_2') group by 1, 2, 3),
accounts as (
  select account_name, usage_month,
    cast(round(sum(stored) / power(2, 40), 1) as decimal(18,1)) as stored_tb,
    cast(round(sum(failsafe) / power(2, 40), 1) as decimal(18,1)) as failsafe_tb
  from daily group by 1, 2)
select usage_month, cast(sum(stored_tb) as double) as tot_db_storage_tb,
  cast(sum(failsafe_tb) as double) as tot_fs_storage_tb,
  cast(sum(18.40 * stored_tb) as double) as tot_database_storage_cost,
  cast(sum(18.40 * failsafe_tb) as double) as tot_failsafe_storage_cost
from accounts group by 1"""),
}
