"""Monthly bills, account and service cost, wide monthly tables and owner lookup."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import (
    full_months,
    month_of,
    month_start,
    to_day,
    within,
)
from meterlens.operators.months import drop_all_zero, pivot_months, with_month_label, zero_nulls

BILL_KEYS = ["account_name", "wh_db_name", "service_type", "usage_month"]


# --- The six branches of the bill ---------------------------------------------------


def _account(account: str | None) -> Column:
    """A fixed account, or the table's own account column."""
    return (F.col("account_name") if account is None else F.lit(account)).alias("account_name")


def _bill(
    usage: DataFrame, credits: Column, price: Decimal, name: str | Column, service: Column,
    account: str | None, time: str = "start_time",
) -> DataFrame:
    """Credits and cost per account, name, service and month."""
    name = F.col(name) if isinstance(name, str) else name
    return usage.groupBy(
        _account(account), name.alias("wh_db_name"), service.alias("service_type"),
        month_of(time).alias("usage_month"),
    ).agg(
        F.sum(credits).alias("total_credits"),
        (F.lit(price) * F.sum(F.coalesce(credits, F.lit(Decimal(0))))).alias("billable_usage"),
    )


def _positive(bill: DataFrame) -> DataFrame:
    """Billed rows only, in one decimal type for all branches so a union loses no digit."""
    amounts = [F.col(c).cast("decimal(38,9)").alias(c) for c in ("total_credits", "billable_usage")]
    return bill.where(F.col("billable_usage") > 0).select(*BILL_KEYS, *amounts)


def _by_catalog(usage: DataFrame, price: Decimal, table_id: Column, tables: DataFrame,
                account: str | None) -> DataFrame:
    """Bill by the catalog of the table behind each usage row.

    Usage is summed per table and month first, so a table holding much of the usage
    meets the table list as one row per month.
    """
    per_table = _bill(
        usage, F.col("credits_used_compute"), price, table_id, F.col("service_type"), account
    ).withColumnRenamed("wh_db_name", "table_id")
    catalogs = tables.select("table_id", "table_catalog").distinct()
    return _positive(
        per_table.join(catalogs, "table_id")
        .groupBy(
            "account_name", F.col("table_catalog").alias("wh_db_name"), "service_type",
            "usage_month",
        )
        .agg(
            F.sum("total_credits").alias("total_credits"),
            F.sum("billable_usage").alias("billable_usage"),
        )
    )


def bill_compute(
    metering: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_CREDIT_PRICE, account: str | None = None,
) -> DataFrame:
    """Warehouse compute."""
    usage = metering.where(within("start_time", *full_months(as_of, months)))
    credits = F.coalesce("credits_used_compute", F.lit(Decimal(0)))
    return _positive(_bill(usage, credits, price, "warehouse_name", F.lit(fixed.COMPUTE_LABEL), account))


def bill_services(
    metering_history: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_CREDIT_PRICE, account: str | None = None,
) -> DataFrame:
    """Cloud services of warehouses and the services without a branch of their own."""
    usage = metering_history.where(within("start_time", *full_months(as_of, months)))
    usage = usage.where(
        ~F.col("service_type").isin(
            fixed.SEARCH_OPTIMIZATION, fixed.AUTO_CLUSTERING, fixed.MATERIALIZED_VIEW
        )
    )
    metered = F.col("service_type") == fixed.WAREHOUSE_METERING
    credits = F.when(metered, F.col("credits_used_cloud_services")).otherwise(
        F.col("credits_used_compute")
    )
    service = F.when(metered, F.lit(fixed.CLOUD_SERVICES_LABEL)).otherwise(F.col("service_type"))
    return _positive(_bill(usage, credits, price, "name", service, account))


def bill_search_opt(
    metering_history: DataFrame, tables: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_CREDIT_PRICE, account: str | None = None,
) -> DataFrame:
    """Search optimisation, by the table id inside the service's name."""
    usage = metering_history.where(within("start_time", *full_months(as_of, months)))
    usage = usage.where(F.col("service_type") == fixed.SEARCH_OPTIMIZATION)
    table_id = F.substring("name", *fixed.SEARCH_NAME_TABLE_ID).try_cast("bigint")
    return _by_catalog(usage, price, table_id, tables, account)


def bill_clustering(
    metering_history: DataFrame, tables: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_CREDIT_PRICE, account: str | None = None,
) -> DataFrame:
    """Automatic clustering, by table."""
    usage = metering_history.where(within("start_time", *full_months(as_of, months)))
    usage = usage.where(F.col("service_type") == fixed.AUTO_CLUSTERING)
    return _by_catalog(usage, price, F.col("entity_id"), tables, account)


def bill_mv(
    refresh_history: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_CREDIT_PRICE, account: str | None = None,
) -> DataFrame:
    """Materialised-view refreshes."""
    usage = refresh_history.where(within("start_time", *full_months(as_of, months)))
    usage = usage.where(F.col("service_type") == fixed.MATERIALIZED_VIEW)
    service = F.lit(fixed.MATERIALIZED_VIEW)
    return _positive(
        _bill(usage, F.col("credits_used"), price, "database_name", service, account)
    )


def bill_storage(
    storage: DataFrame, as_of: dt.date | str, months: int = 1,
    price: Decimal = fixed.BILL_STORAGE_PRICE, account: str | None = None,
) -> DataFrame:
    """Average terabytes (active plus failsafe) per database, rounded before pricing."""
    usage = storage.where(within("usage_date", *full_months(as_of, months)))
    size = F.col("average_database_bytes") + F.col("average_failsafe_bytes")
    mean = F.sum(size.cast("decimal(38,0)")).cast("double") / F.count(size)
    terabytes = F.round(mean / float(1024**4), 3).cast("decimal(18,3)")
    sized = usage.groupBy(
        _account(account), F.col("database_name").alias("wh_db_name"),
        F.lit(fixed.STORAGE_LABEL).alias("service_type"), month_of("usage_date").alias("usage_month"),
    ).agg(terabytes.alias("total_credits"))
    return _positive(
        sized.withColumn("billable_usage", F.lit(price) * F.col("total_credits"))
    )


def _bill_metered(
    metering_history: DataFrame, tables: DataFrame, as_of: dt.date | str, months: int,
    price: Decimal, account: str | None,
) -> DataFrame:
    """``bill_services``, ``bill_search_opt`` and ``bill_clustering`` in one pass.

    Usage is summed per name or table first; the sums of tables then take the name of
    their catalog, and those of unknown tables drop out.
    """
    usage = metering_history.where(within("start_time", *full_months(as_of, months)))
    kind = F.col("service_type")
    usage = usage.where(kind.isNotNull() & (kind != fixed.MATERIALIZED_VIEW))
    metered, searched = kind == fixed.WAREHOUSE_METERING, kind == fixed.SEARCH_OPTIMIZATION
    of_table = searched | (kind == fixed.AUTO_CLUSTERING)
    credits = F.when(metered, F.col("credits_used_cloud_services")).otherwise(
        F.col("credits_used_compute")
    )
    searched_table = F.substring("name", *fixed.SEARCH_NAME_TABLE_ID).try_cast("bigint")
    table_id = F.when(searched, searched_table).when(of_table, F.col("entity_id"))
    sums = usage.groupBy(
        _account(account), F.when(~of_table, F.col("name")).alias("_name"),
        table_id.alias("table_id"), of_table.alias("_of_table"),
        F.when(metered, fixed.CLOUD_SERVICES_LABEL).otherwise(kind).alias("service_type"),
        month_of("start_time").alias("usage_month"),
    ).agg(F.sum(credits).alias("total_credits"))
    catalogs = tables.select(
        "table_id", "table_catalog", F.lit(True).alias("_known")
    ).distinct()
    named = sums.join(catalogs, "table_id", "left").where(~F.col("_of_table") | F.col("_known"))
    name = F.when(F.col("_of_table"), F.col("table_catalog")).otherwise(F.col("_name"))
    nothing = F.lit(Decimal(0))
    return _positive(
        named.groupBy("account_name", name.alias("wh_db_name"), "service_type", "usage_month")
        .agg(
            F.sum("total_credits").alias("total_credits"),
            (F.lit(price) * F.sum(F.coalesce("total_credits", nothing))).alias("billable_usage"),
        )
    )


def full_bill(
    metering: DataFrame, metering_history: DataFrame, tables: DataFrame,
    refresh_history: DataFrame, storage: DataFrame, as_of: dt.date | str, months: int = 1,
    compute_price: Decimal = fixed.BILL_CREDIT_PRICE,
    storage_price: Decimal = fixed.BILL_STORAGE_PRICE, account: str | None = None,
) -> DataFrame:
    """All branches, ordered by month, account, name and service."""
    credits = {"as_of": as_of, "months": months, "price": compute_price, "account": account}
    branches = [
        bill_compute(metering, **credits),
        _bill_metered(metering_history, tables, **credits),
        bill_mv(refresh_history, **credits),
        bill_storage(storage, as_of, months, storage_price, account),
    ]
    return reduce(DataFrame.unionByName, branches).orderBy(
        "usage_month", "account_name", "wh_db_name", "service_type"
    )


# --- Cost by account and service ----------------------------------------------------


def _monthly(usage: DataFrame, keys: list[str], start: dt.date, end: dt.date) -> DataFrame:
    period = usage.where(within("usage_date", start, end))
    return period.groupBy(*keys, month_of("usage_date").alias("usagemonth")).agg(
        F.round(F.sum("usage_in_currency"), 3).alias("billable_usage")
    )


def _this_year(as_of: dt.date | str) -> tuple[dt.date, dt.date]:
    """From the start of the year to the end of the previous month, end exclusive."""
    day = to_day(as_of)
    return dt.date(day.year, 1, 1), month_start(day)


def account_monthly(usage: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Cost per account and month of the current year's full months."""
    return _monthly(usage, ["account_name"], *_this_year(as_of))


def service_monthly(
    usage: DataFrame, as_of: dt.date | str, lookback_days: int = 184, exclude: list[str] = ()
) -> DataFrame:
    """Cost per account, service and month, reaching back before the start of the year."""
    start, end = _this_year(as_of)
    if exclude:
        usage = usage.where(~F.col("account_name").isin(list(exclude)))
    return _monthly(
        usage, ["account_name", "service_type"], start - dt.timedelta(days=lookback_days), end
    )


def service_month_totals(monthly: DataFrame, label: bool = True) -> DataFrame:
    """Total per account, service and month (as a label or a date), null as zero."""
    month = "us_month" if label else "usagemonth"
    if label:
        monthly = with_month_label(monthly, "usagemonth", month)
    return monthly.groupBy("account_name", "service_type", month).agg(
        F.coalesce(F.sum("billable_usage"), F.lit(0)).alias("bill_usage")
    )


def service_pivot(totals: DataFrame, months: list[str]) -> DataFrame:
    """One row per service over all accounts, one column per month, null as zero."""
    wide = pivot_months(
        totals.drop("account_name"), ["service_type"], months, "bill_usage", month="us_month"
    )
    return zero_nulls(wide, [c for c in wide.columns if c != "service_type"])


# --- Warehouse credits: tiered price, wide months, owner ----------------------------


def clean_credits(credits: DataFrame) -> DataFrame:
    """Rows of real warehouses only."""
    name = F.col("warehouse_name")
    real = name.isNotNull() & (name != fixed.CLOUD_SERVICES_WAREHOUSE)
    return credits.where(real).select(
        "account_name", "warehouse_name", "credits_used_compute", "start_time", "service_type"
    )


def tiered_cost(credits: DataFrame, tiers=fixed.CREDIT_PRICE_TIERS) -> DataFrame:
    """Monthly credits priced by the tier in force in that calendar month."""
    first, *later = tiers
    price = F.lit(first[1])
    for start, value in later:
        price = F.when(F.col("usage_month") >= F.lit(to_day(start)), F.lit(value)).otherwise(price)
    return (
        credits.groupBy(
            "account_name", "service_type", "warehouse_name",
            month_of("start_time").alias("usage_month"),
        )
        .agg(F.round(F.sum("credits_used_compute"), 3).alias("total_credits"))
        .withColumn("billable_usage", F.col("total_credits") * price)
    )


def rated_cost(credits: DataFrame, rates: DataFrame) -> DataFrame:
    """Monthly credits priced from a rate table: the general form of ``tiered_cost``.

    ``rates`` has account_name, valid_from, valid_to (exclusive, null for open) and price. A
    month takes the rate valid on its first day. ``status`` says ``priced``, ``gap`` (no
    rate) or ``overlap`` (several, named by ``rates``); only ``priced`` rows have a price and
    a bill, so nothing is counted twice and nothing is lost. Months of accounts are looked
    up, not rows of the log.
    """
    keys = ["account_name", "usage_month"]
    usage = credits.groupBy(
        "account_name", "service_type", "warehouse_name",
        month_of("start_time").alias("usage_month"),
    ).agg(F.round(F.sum("credits_used_compute"), 3).alias("total_credits"))
    months, valid = usage.select(*keys).distinct().alias("m"), rates.alias("r")
    in_force = (
        F.col("m.account_name").eqNullSafe(F.col("r.account_name"))
        & (F.col("r.valid_from") <= F.col("m.usage_month"))
        & (F.col("r.valid_to").isNull() | (F.col("m.usage_month") < F.col("r.valid_to")))
    )
    found = (
        months.join(valid, in_force, "left")
        .groupBy(*[F.col(f"m.{c}") for c in keys])
        .agg(F.count("r.valid_from").alias("rates"), F.max("r.price").alias("_price"))
    )
    status = F.when(F.col("rates") == 0, "gap").when(F.col("rates") == 1, "priced")
    same = F.col("u.account_name").eqNullSafe(F.col("f.account_name")) & (
        F.col("u.usage_month").eqNullSafe(F.col("f.usage_month"))
    )
    price = F.when(F.col("rates") == 1, F.col("_price"))
    return usage.alias("u").join(found.alias("f"), same).select(
        "u.*", status.otherwise("overlap").alias("status"), "rates", price.alias("price"),
        (F.col("total_credits") * price).alias("billable_usage"),
    )


def labelled_cost(cost: DataFrame) -> DataFrame:
    return with_month_label(cost, "usage_month").select(
        "account_name", "warehouse_name", "month", "billable_usage"
    )


def _join_owner(df: DataFrame, xref: DataFrame) -> DataFrame:
    owners = xref.select(
        "account_name", F.col("wh_name").alias("warehouse_name"), "application", "owner"
    )
    unknown = F.lit(fixed.UNKNOWN_OWNER)
    return df.join(owners, ["account_name", "warehouse_name"], "left").withColumns(
        {
            "application": F.coalesce("application", unknown),
            "owner": F.coalesce("owner", unknown),
        }
    )


def with_owner(cost: DataFrame, xref: DataFrame) -> DataFrame:
    """Application and owner of each cost row, ``Other`` when unknown."""
    return (
        _join_owner(cost, xref)
        .select(
            "account_name", "warehouse_name", "month", "billable_usage",
            F.col("application").alias("application_1"), F.col("owner").alias("owner_1"),
        )
        .orderBy("account_name", "warehouse_name")
    )


def fill_months(
    wide: DataFrame, columns: list[str], rename_map: dict[str, str] | None = None
) -> DataFrame:
    """Null months as zero; ``act_name`` is the account under its mapped name."""
    shown = F.col("account_name")
    for old, new in (rename_map or {}).items():
        shown = F.when(F.col("account_name") == old, F.lit(new)).otherwise(shown)
    return zero_nulls(wide, columns).withColumn("act_name", shown)


def wide_with_owner(filled: DataFrame, xref: DataFrame, columns: list[str]) -> DataFrame:
    """Owner lookup on the wide table, by the original account name."""
    return (
        _join_owner(filled.drop("act_name"), xref)
        .select("account_name", "warehouse_name", "application", "owner", *columns)
        .orderBy("account_name", "warehouse_name")
    )


def owner_month_report(
    credits: DataFrame, xref: DataFrame, months: list[str], tiers=fixed.CREDIT_PRICE_TIERS
) -> DataFrame:
    """The whole chain: clean, price, label, pivot, fill, look up owners, drop empty rows."""
    cost = labelled_cost(tiered_cost(clean_credits(credits), tiers))
    wide = pivot_months(cost, ["account_name", "warehouse_name"], months, "billable_usage")
    columns = [c for c in wide.columns if c not in ("account_name", "warehouse_name")]
    return drop_all_zero(wide_with_owner(fill_months(wide, columns), xref, columns), columns)


# --- Reconciliation -----------------------------------------------------------------


def data_bounds(df: DataFrame, column: str) -> DataFrame:
    """Earliest and latest value of a column and the row count."""
    return df.agg(
        F.min(column).alias("min_value"), F.max(column).alias("max_value"),
        F.count(F.lit(1)).alias("row_count"),
    )


def rates_on(
    rate_sheet: DataFrame, service: str, date: dt.date | str, column: str = "date"
) -> DataFrame:
    """Rates of one service on one day, by account."""
    day = to_day(date)
    on_day = within(column, day, day + dt.timedelta(days=1))
    return rate_sheet.where((F.col("service_type") == service) & on_day).orderBy("account_name")
