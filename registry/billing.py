import datetime as dt
from decimal import Decimal

from meterlens.functions.dates import full_months, month_labels, short_month
from meterlens.operators.months import drop_all_zero, pivot_months, with_month_label
from meterlens.plans import billing
from registry.base import ORDERS_AS_OF, oracle, query, report

ACCOUNT = "ACC_0"  # for logs that carry no account column
TIERS = ((None, Decimal("2.32")), ("1998-01-01", Decimal("2.56")))
HALF_YEAR = month_labels(dt.date(1998, 1, 1), ORDERS_AS_OF)
LAST_13 = month_labels(*full_months(ORDERS_AS_OF, 13))
LAST_12 = month_labels(*full_months(ORDERS_AS_OF, 12))
COLUMNS_12 = [short_month(label) for label in LAST_12]
EXCLUDED = ["FRANCE", "CHINA"]


def _bill(plan, *logs, account=None):
    return report(plan, *logs, as_of=ORDERS_AS_OF, account=account)


def _account_labels(log):
    monthly = billing.account_monthly(log("usage_in_currency_daily"), ORDERS_AS_OF)
    return with_month_label(monthly, "usagemonth").select("account_name", "month", "billable_usage")


def _services(log):
    return billing.service_monthly(
        log("usage_in_currency_daily"), ORDERS_AS_OF, exclude=EXCLUDED
    )


def _cost(log):
    return billing.tiered_cost(billing.clean_credits(log("warehouse_credits")), TIERS)


def _wide(log):
    return pivot_months(
        billing.labelled_cost(_cost(log)), ["account_name", "warehouse_name"], LAST_12,
        "billable_usage",
    )


def _wide_with_owner(log):
    filled = billing.fill_months(_wide(log), COLUMNS_12)
    return billing.wide_with_owner(filled, log("wh_owner_xref"), COLUMNS_12)


QUERIES = {
    "b01_bill_compute": _bill(billing.bill_compute, "warehouse_credits"),
    "b02_bill_services": _bill(billing.bill_services, "metering_history", account=ACCOUNT),
    "b03_bill_search_opt": _bill(
        billing.bill_search_opt, "metering_history", "tables", account=ACCOUNT
    ),
    "b04_bill_clustering": _bill(
        billing.bill_clustering, "metering_history", "tables", account=ACCOUNT
    ),
    "b05_bill_mv": _bill(
        billing.bill_mv, "materialized_view_refresh_history", account=ACCOUNT
    ),
    "b06_bill_storage": _bill(billing.bill_storage, "database_storage_usage_history"),
    "b07_full_bill": _bill(
        billing.full_bill, "warehouse_credits", "metering_history", "tables",
        "materialized_view_refresh_history", "database_storage_usage_history", account=ACCOUNT,
    ),
    "b08_account_monthly": report(
        billing.account_monthly, "usage_in_currency_daily", as_of=ORDERS_AS_OF
    ),
    "b09_month_label": query(_account_labels),
    "b10_pivot_months": query(
        lambda log: pivot_months(
            _account_labels(log), ["account_name"], HALF_YEAR, "billable_usage", EXCLUDED
        ).orderBy("account_name")
    ),
    "b11_service_monthly": query(_services),
    "b12_service_month_totals": query(lambda log: billing.service_month_totals(_services(log))),
    "b13_service_month_totals_by_date": query(
        lambda log: billing.service_month_totals(_services(log), label=False)
    ),
    "b14_service_pivot": query(
        lambda log: billing.service_pivot(billing.service_month_totals(_services(log)), LAST_13)
    ),
    "b15_clean_credits": report(billing.clean_credits, "warehouse_credits"),
    "b16_tiered_cost": query(_cost),
    "b16_rated_cost": query(
        lambda log: billing.rated_cost(
            billing.clean_credits(log("warehouse_credits")), log("credit_rates")
        )
    ),
    "b17_labelled_cost": query(lambda log: billing.labelled_cost(_cost(log))),
    "b18_with_owner": query(
        lambda log: billing.with_owner(billing.labelled_cost(_cost(log)), log("wh_owner_xref"))
    ),
    "b19_pivot_warehouse_months": query(_wide),
    "b20_fill_months": query(
        lambda log: billing.fill_months(_wide(log), COLUMNS_12, {"ACC_1": "ACC_ONE"})
    ),
    "b21_wide_with_owner": query(_wide_with_owner),
    "b22_owner_month_report": query(
        lambda log: billing.owner_month_report(
            log("warehouse_credits"), log("wh_owner_xref"), LAST_12, TIERS
        )
    ),
    "b22_drop_all_zero": query(lambda log: drop_all_zero(_wide_with_owner(log), COLUMNS_12)),
    "b23_data_bounds": report(
        billing.data_bounds, "usage_in_currency_daily", column="usage_date"
    ),
    "b24_rates_on": report(
        billing.rates_on, "usage_in_currency_daily", service="5-LOW", date="1998-06-27",
        column="usage_date",
    ),
}

_JUNE = "start_time >= date '1998-06-01' and start_time < date '1998-07-01'"
_TOTALS = """cast(sum({0}) as double) as total_credits,
  cast(2.40 * sum(coalesce({0}, 0)) as double) as billable_usage"""
_MONTH = "cast(date_trunc('month', start_time) as date) as usage_month"

_BRANCHES = {
    "b01": f"""
select account_name, warehouse_name as wh_db_name, 'COMPUTE' as service_type, {_MONTH},
  {_TOTALS.format('coalesce(credits_used_compute, 0)')}
from warehouse_credits where {_JUNE} group by 1, 2, 3, 4""",
    "b02": f"""
select 'ACC_0' as account_name, name as wh_db_name,
  case when service_type = 'WAREHOUSE_METERING' then 'CLOUD SERVICES' else service_type end as service_type,
  {_MONTH},
  {_TOTALS.format('''case when service_type = 'WAREHOUSE_METERING' then credits_used_cloud_services
    else credits_used_compute end''')}
from metering_history where {_JUNE}
  and service_type not in ('SEARCH_OPTIMIZATION', 'AUTO_CLUSTERING', 'MATERIALIZED_VIEW')
group by 1, 2, 3, 4""",
    "b03": f"""
select 'ACC_0' as account_name, table_catalog as wh_db_name, service_type, {_MONTH},
  {_TOTALS.format('credits_used_compute')}
from metering_history
join (select distinct table_id, table_catalog from tables) t
  on try_cast(substr(name, 33, 10) as bigint) = t.table_id
where {_JUNE} and service_type = 'SEARCH_OPTIMIZATION' group by 1, 2, 3, 4""",
    "b04": f"""
select 'ACC_0' as account_name, table_catalog as wh_db_name, service_type, {_MONTH},
  {_TOTALS.format('credits_used_compute')}
from metering_history
join (select distinct table_id, table_catalog from tables) t on entity_id = t.table_id
where {_JUNE} and service_type = 'AUTO_CLUSTERING' group by 1, 2, 3, 4""",
    "b05": f"""
select 'ACC_0' as account_name, database_name as wh_db_name, 'MATERIALIZED_VIEW' as service_type,
  {_MONTH}, {_TOTALS.format('credits_used')}
from materialized_view_refresh_history
where {_JUNE} and service_type = 'MATERIALIZED_VIEW' group by 1, 2, 3, 4""",
    "b06": """
select account_name, database_name as wh_db_name, 'STORAGE' as service_type,
  cast(date_trunc('month', usage_date) as date) as usage_month,
  round(cast(sum(average_database_bytes + average_failsafe_bytes) as double) / count(*)
    / power(1024, 4), 3) as total_credits,
  cast(23 * cast(round(cast(sum(average_database_bytes + average_failsafe_bytes) as double)
    / count(*) / power(1024, 4), 3) as decimal(18,3)) as double) as billable_usage
from database_storage_usage_history
where usage_date >= date '1998-06-01' and usage_date < date '1998-07-01' group by 1, 2, 3, 4""",
}


def _branch(key: str) -> str:
    return f"select * from ({_BRANCHES[key]}) b where billable_usage > 0"


_ACCOUNT_MONTHLY = """account_months as (
select account_name, cast(date_trunc('month', usage_date) as date) as usagemonth,
  round(sum(usage_in_currency), 3) as billable_usage
from usage_in_currency_daily
where usage_date >= date '1998-01-01' and usage_date <= date '1998-06-30' group by 1, 2)"""
_SERVICES = """services as (
select account_name, service_type, cast(date_trunc('month', usage_date) as date) as usagemonth,
  round(sum(usage_in_currency), 3) as billable_usage
from usage_in_currency_daily
where usage_date >= date '1998-01-01' - interval 184 day and usage_date <= date '1998-06-30'
  and account_name not in ('FRANCE', 'CHINA') group by 1, 2, 3)"""
_CLEAN = """clean as (
select account_name, warehouse_name, credits_used_compute, start_time, service_type
from warehouse_credits
where warehouse_name is not null and warehouse_name <> 'CLOUD_SERVICES_ONLY')"""
_COST = f"""{_CLEAN}, credit_months as (
select account_name, service_type, warehouse_name,
  cast(date_trunc('month', start_time) as date) as usage_month,
  round(sum(credits_used_compute), 3) as total_credits
from clean group by 1, 2, 3, 4),
cost as (
select *, total_credits * case when usage_month >= date '1998-01-01' then 2.56 else 2.32 end
  as billable_usage, strftime(usage_month, '%Y-%b') as month from credit_months)"""


def _cells(labels: list[str], value: str, month: str, null: str = "null") -> str:
    return ", ".join(
        f"cast(coalesce(sum(case when {month} = '{label}' then {value} end), {null}) as double)"
        f" as {short_month(label)}"
        for label in labels
    )


_WIDE = f"""{_COST}, wide as (
select account_name, warehouse_name, {_cells(LAST_12, 'billable_usage', 'month')}
from cost group by 1, 2)"""
_FILLED = ", ".join(f"coalesce({c}, 0) as {c}" for c in COLUMNS_12)
_WIDE_OWNER = f"""{_WIDE}, owned as (
select w.account_name, warehouse_name, coalesce(application, 'Other') as application,
  coalesce(owner, 'Other') as owner, {_FILLED}
from wide w left join wh_owner_xref x
  on x.account_name = w.account_name and x.wh_name = w.warehouse_name)"""

ORACLES = {
    "b01_bill_compute": oracle(_branch("b01")),
    "b02_bill_services": oracle(_branch("b02")),
    "b03_bill_search_opt": oracle(_branch("b03")),
    "b04_bill_clustering": oracle(_branch("b04")),
    "b05_bill_mv": oracle(_branch("b05")),
    "b06_bill_storage": oracle(_branch("b06")),
    "b07_full_bill": oracle(
        " union all ".join(
            _branch(key).replace("select account_name,", "select 'ACC_0' as account_name,")
            for key in _BRANCHES
        )
    ),
    "b08_account_monthly": oracle(f"""
with {_ACCOUNT_MONTHLY}
select account_name, usagemonth, cast(billable_usage as double) as billable_usage
from account_months"""),
    "b09_month_label": oracle(f"""
with {_ACCOUNT_MONTHLY}
select account_name, strftime(usagemonth, '%Y-%b') as month,
  cast(billable_usage as double) as billable_usage from account_months"""),
    "b10_pivot_months": oracle(f"""
with {_ACCOUNT_MONTHLY}, labelled as (
  select *, strftime(usagemonth, '%Y-%b') as month from account_months
  where account_name not in ('FRANCE', 'CHINA'))
select account_name, {_cells(HALF_YEAR, 'billable_usage', 'month')}
from labelled group by 1"""),
    "b11_service_monthly": oracle(f"""
with {_SERVICES}
select account_name, service_type, usagemonth, cast(billable_usage as double) as billable_usage
from services"""),
    "b12_service_month_totals": oracle(f"""
with {_SERVICES}
select account_name, service_type, strftime(usagemonth, '%Y-%b') as us_month,
  cast(coalesce(sum(billable_usage), 0) as double) as bill_usage from services group by 1, 2, 3"""),
    "b13_service_month_totals_by_date": oracle(f"""
with {_SERVICES}
select account_name, service_type, usagemonth,
  cast(coalesce(sum(billable_usage), 0) as double) as bill_usage from services group by 1, 2, 3"""),
    "b14_service_pivot": oracle(f"""
with {_SERVICES}, labelled as (
  select *, strftime(usagemonth, '%Y-%b') as us_month from services)
select service_type, {_cells(LAST_13, 'billable_usage', 'us_month', '0')}
from labelled group by 1"""),
    "b15_clean_credits": oracle(f"""
with {_CLEAN}
select account_name, warehouse_name, cast(credits_used_compute as double) as credits_used_compute,
  strftime(start_time, '%Y-%m-%d %H:%M:%S') as start_time, service_type from clean"""),
    "b16_tiered_cost": oracle(f"""
with {_COST}
select account_name, service_type, warehouse_name, usage_month,
  cast(total_credits as double) as total_credits,
  cast(billable_usage as double) as billable_usage from cost"""),
    "b16_rated_cost": oracle(f"""
with {_COST},
priced as (
  select c.account_name, c.service_type, c.warehouse_name, c.usage_month, c.total_credits,
    count(r.valid_from) as rates, max(r.price) as price
  from cost c left join credit_rates r on r.account_name = c.account_name
    and r.valid_from <= c.usage_month and (r.valid_to is null or c.usage_month < r.valid_to)
  group by all)
select account_name, service_type, warehouse_name, usage_month,
  cast(total_credits as double) as total_credits,
  case rates when 0 then 'gap' when 1 then 'priced' else 'overlap' end as status, rates,
  cast(case when rates = 1 then price end as double) as price,
  cast(case when rates = 1 then total_credits * price end as double) as billable_usage
from priced"""),
    "b17_labelled_cost": oracle(f"""
with {_COST}
select account_name, warehouse_name, month, cast(billable_usage as double) as billable_usage
from cost"""),
    "b18_with_owner": oracle(f"""
with {_COST}
select c.account_name, warehouse_name, month, cast(billable_usage as double) as billable_usage,
  coalesce(application, 'Other') as application_1, coalesce(owner, 'Other') as owner_1
from cost c left join wh_owner_xref x
  on x.account_name = c.account_name and x.wh_name = c.warehouse_name"""),
    "b19_pivot_warehouse_months": oracle(f"with {_WIDE} select * from wide"),
    "b20_fill_months": oracle(f"""
with {_WIDE}
select case when account_name = 'ACC_1' then 'ACC_ONE' else account_name end as act_name,
  account_name, warehouse_name, {_FILLED} from wide"""),
    "b21_wide_with_owner": oracle(f"with {_WIDE_OWNER} select * from owned"),
    "b22_drop_all_zero": oracle(f"""
with {_WIDE_OWNER}
select * from owned where not ({' and '.join(f'{c} = 0' for c in COLUMNS_12)})"""),
    "b22_owner_month_report": oracle(f"""
with {_WIDE_OWNER}
select * from owned where not ({' and '.join(f'{c} = 0' for c in COLUMNS_12)})"""),
    "b23_data_bounds": oracle("""
select min(usage_date) as min_value, max(usage_date) as max_value, count(*) as row_count
from usage_in_currency_daily"""),
    "b24_rates_on": oracle("""
select account_name, service_type, usage_date,
  cast(usage_in_currency as double) as usage_in_currency
from usage_in_currency_daily
where service_type = '5-LOW' and usage_date = date '1998-06-27'"""),
}
