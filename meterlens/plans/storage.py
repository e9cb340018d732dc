"""Storage size and cost."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import full_months, in_months, month_of, to_day, within

TERABYTE = float(2**40)
MEASURES = {
    "database_size_tb": fixed.ACTIVE_SIZE_TITLE,
    "failsafe_size_tb": fixed.FAILSAFE_SIZE_TITLE,
}


def database_sizes(
    storage: DataFrame, year: int | None = None, months: list[int] | None = None
) -> DataFrame:
    """Largest daily size in terabytes (one decimal) per database and month."""

    def largest(column: str) -> Column:
        return F.max(F.round(F.col(column).cast("double") / TERABYTE, 1))

    return (
        storage.where(in_months("usage_date", months, year))
        .groupBy("database_name", F.month("usage_date").alias("usage_month"))
        .agg(
            largest("average_database_bytes").alias("database_size_tb"),
            largest("average_failsafe_bytes").alias("failsafe_size_tb"),
        )
        .orderBy("database_name", "usage_month")
    )


def database_sizes_wide(sizes: DataFrame, months: dict[int, str]) -> DataFrame:
    """One row per database and measure, one column per month number in ``months``.

    Both measures come from one aggregation whose row is then turned into two, so the
    sizes are computed once; database and measure make the rows distinct.
    """
    cells = sizes.groupBy("database_name").agg(
        *[
            F.max(F.when(F.col("usage_month") == month, F.col(measure))).alias(
                f"{measure}_{month}"
            )
            for measure in MEASURES
            for month in months
        ]
    )
    rows = [
        F.struct(
            F.lit(title).alias("measure"),
            *[F.col(f"{measure}_{month}").alias(name) for month, name in months.items()],
        )
        for measure, title in MEASURES.items()
    ]
    return (
        cells.select("database_name", F.explode(F.array(*rows)).alias("_row"))
        .select("database_name", "_row.*")
        .orderBy("database_name", "measure")
    )


def table_storage_cost(
    metrics: DataFrame, clustering: DataFrame, as_of: dt.date | str,
    storage_price: Decimal = fixed.TABLE_STORAGE_PRICE,
    credit_price: Decimal = fixed.CLUSTERING_CREDIT_PRICE,
) -> DataFrame:
    """Storage cost of each live table and last month's clustering credits and cost."""
    live = metrics.where(F.lower(F.col("deleted").cast("string")) == "false")

    def terabytes(column: str) -> Column:
        return F.round(F.sum(column).cast("double") / TERABYTE, 10).cast("decimal(24,10)")

    kinds = {"active": "active_bytes", "failsafe": "failsafe_bytes",
             "time_travel": "time_travel_bytes"}
    stored = live.groupBy("id", "table_catalog", "table_schema", "table_name").agg(
        *[terabytes(column).alias(f"total_{kind}_bytes_in_tb") for kind, column in kinds.items()]
    )
    stored = stored.withColumns(
        {
            f"total_{kind}_cost_per_month":
                F.col(f"total_{kind}_bytes_in_tb") * F.lit(storage_price)
            for kind in kinds
        }
    )
    names = ["table_id", "database_name", "schema_name", "table_name"]
    clustered = (
        clustering.where(within("start_time", *full_months(as_of, 1)))
        .groupBy(*names)
        .agg(F.sum("credits_used").alias("_credits"))
        .select(F.col("table_id").alias("id"), "_credits")
    )
    credits = F.coalesce(F.col("_credits"), F.lit(0))
    return (
        stored.join(clustered, "id", "left")
        .withColumns(
            {
                "total_auto_clustering_credits": credits,
                "total_auto_clustering_cost": credits * F.lit(credit_price),
            }
        )
        .drop("id", "_credits")
        .orderBy("table_catalog", "table_schema", "table_name")
    )


def org_storage_cost(
    storage: DataFrame, start: dt.date | str, end: dt.date | str,
    price: Decimal = fixed.ORGANISATION_STORAGE_PRICE, exclude: list[str] = (),
) -> DataFrame:
    """Storage and failsafe terabytes and cost of all accounts per month.

    The month's largest value per database (database plus hybrid-table bytes) is summed
    per account, rounded to terabytes with one decimal, priced and summed per month.
    """
    period = storage.where(within("usage_date", to_day(start), to_day(end)))
    if exclude:
        period = period.where(~F.col("account_name").isin(list(exclude)))
    stored = F.col("average_database_bytes") + F.col("average_hybrid_table_storage_bytes")
    per_database = period.groupBy(
        "account_name", month_of("usage_date").alias("usage_month"), "database_name"
    ).agg(
        F.max(stored).alias("_stored"), F.max("average_failsafe_bytes").alias("_failsafe")
    )

    def terabytes(column: str) -> Column:
        return F.round(F.sum(column).cast("double") / TERABYTE, 1).cast("decimal(18,1)")

    per_account = per_database.groupBy("account_name", "usage_month").agg(
        terabytes("_stored").alias("_stored_tb"), terabytes("_failsafe").alias("_failsafe_tb")
    )
    return per_account.groupBy("usage_month").agg(
        F.sum("_stored_tb").alias("tot_db_storage_tb"),
        F.sum("_failsafe_tb").alias("tot_fs_storage_tb"),
        F.sum(F.lit(price) * F.col("_stored_tb")).alias("tot_database_storage_cost"),
        F.sum(F.lit(price) * F.col("_failsafe_tb")).alias("tot_failsafe_storage_cost"),
    )
