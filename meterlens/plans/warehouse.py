"""Warehouse credit trends, utilisation and idle time."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import (
    DAY,
    last_days,
    month_start,
    second_number,
    shift_months,
    to_day,
    within,
)
from meterlens.operators.joins import broadcast_up_to


def _period_starts(as_of: dt.date, unit: str) -> list[dt.date]:
    """Starts of the current period and the four before it, oldest first."""
    if unit == "month":
        current = month_start(as_of)
        return [shift_months(current, -age) for age in (4, 3, 2, 1, 0)]
    current = as_of - as_of.weekday() * DAY
    return [current - 7 * age * DAY for age in (4, 3, 2, 1, 0)]


def credit_trend(
    metering: DataFrame, warehouses: DataFrame, as_of: dt.date | str, unit: str = "month",
    price: Decimal = fixed.QUERY_CREDIT_PRICE,
) -> DataFrame:
    """Credits of existing warehouses over the current period and the four before.

    By month: cost of all five periods and the change of the current against the last
    month. By week: credits of the four past weeks and the change of the last against
    the week before. A missing period counts as zero, a negative total too.
    Credits are summed per warehouse before the list of warehouses is applied.
    """
    day = to_day(as_of)
    starts = _period_starts(day, unit)
    period = F.trunc(F.to_date("start_time"), unit).alias("period")
    totals = (
        metering.where(within("start_time", starts[0], day + DAY))
        .groupBy("warehouse_name", period)
        .agg(F.sum("credits_used").alias("credits"))
    )
    existing = warehouses.select(F.col("name").alias("warehouse_name"))
    totals = totals.join(existing, "warehouse_name", "left_semi")
    names = [f"{unit}_4", f"{unit}_3", f"{unit}_2", f"last_{unit}", f"current_{unit}"]
    zero = F.lit(Decimal(0))
    per_warehouse = totals.groupBy("warehouse_name").agg(
        *[
            F.max(F.when(F.col("period") == F.lit(start), F.col("credits")).otherwise(zero))
            .alias(name)
            for name, start in zip(names, starts)
        ]
    )
    newer, older = (names[4], names[3]) if unit == "month" else (names[3], names[2])
    change = (F.col(newer) - F.col(older)).cast("double") / F.col(older).cast("double")
    with_change = per_warehouse.withColumn(
        "percent_change", F.when(F.col(older) > 0, F.round(change * 100, 2))
    )
    if unit == "month":
        costs = [(F.col(name) * F.lit(price)).alias(f"{name}_costs") for name in names]
        return with_change.select("warehouse_name", *costs, "percent_change").orderBy(
            "warehouse_name"
        )
    return with_change.select("warehouse_name", *names[:4], "percent_change").orderBy(
        F.desc_nulls_last("percent_change"), "warehouse_name"
    )


def load_minutes(
    load: DataFrame, as_of: dt.date | str, like: str = "%", by: str = "warehouse_name",
    days: int = 7,
) -> DataFrame:
    """Uptime, running and idle minutes by warehouse or by day.

    Running time is uptime times all running, queued and blocked load; idle time is the
    rest and goes below zero when the load exceeds one.
    """
    recent = load.where(last_days("start_time", as_of, days - 1))
    recent = recent.where(F.col("warehouse_name").like(like))
    uptime = second_number("end_time") - second_number("start_time")
    busy = (
        F.col("avg_running") + F.col("avg_queued_load") + F.col("avg_queued_provisioning")
        + F.col("avg_blocked")
    )
    measured = recent.withColumn("usage_date", F.to_date("start_time")).withColumns(
        {"_uptime": uptime, "_running": uptime * busy, "_idle": uptime * (1 - busy)}
    )
    summed = measured.groupBy(by).agg(
        (F.sum("_uptime") / 60).alias("total_wh_uptime_mins"),
        (F.sum("_running").cast("double") / 60).alias("total_running_mins"),
        (F.sum("_idle").cast("double") / 60).alias("total_idle_mins"),
    )
    return summed.orderBy(F.desc(by)) if by == "usage_date" else summed


def _daily_execution(load: DataFrame, as_of: dt.date | str, days: int) -> DataFrame:
    """Execution time per warehouse and day, taken as seconds."""
    return (
        load.where(last_days("start_time", as_of, days))
        .groupBy("warehouse_name", F.to_date("start_time").alias("usage_date"))
        .agg(F.sum("execution_time").alias("execution_seconds"))
    )


def _utilisation(joined: DataFrame, billed_seconds) -> DataFrame:
    executed = F.coalesce(F.col("execution_seconds").cast("double"), F.lit(0.0))
    share = executed / F.nullif(billed_seconds, F.lit(0.0)) * 100
    return joined.select(
        "warehouse_name", "usage_date", F.round(share, 2).alias("utilization_percent"),
        F.round(100 - share, 2).alias("idle_percent"),
    ).orderBy(F.desc("usage_date"), "warehouse_name")


def daily_utilisation(
    metering: DataFrame, load: DataFrame, as_of: dt.date | str, days: int = 7
) -> DataFrame:
    """Execution time as a share of billed time, per warehouse and day."""
    usage = (
        metering.where(last_days("start_time", as_of, days))
        .groupBy("warehouse_name", F.to_date("start_time").alias("usage_date"))
        .agg(F.sum("credits_used_compute").alias("compute_credits"))
    )
    executed = _daily_execution(load, as_of, days)
    joined = usage.join(executed, ["warehouse_name", "usage_date"], "left")
    return _utilisation(joined, F.col("compute_credits").cast("double") * 3600)


def sized_utilisation(
    metering: DataFrame, load: DataFrame, warehouses: DataFrame, as_of: dt.date | str,
    days: int = 7, sizes: dict[str, float] | None = None, daily: bool = False,
) -> DataFrame:
    """Utilisation with credits divided by a multiplier of the warehouse size.

    Each metering row is set against the whole day's execution time. ``daily`` sums the
    metering per day first.
    """
    sizes = fixed.WAREHOUSE_SIZES if sizes is None else sizes
    multipliers = metering.sparkSession.createDataFrame(
        list(sizes.items()), "size string, multiplier double"
    )
    sized = warehouses.select(F.col("name").alias("warehouse_name"), "size").join(
        broadcast_up_to(multipliers, len(sizes)), "size"
    )
    usage = metering.where(last_days("start_time", as_of, days)).select(
        "warehouse_name", F.to_date("start_time").alias("usage_date"), "credits_used_compute"
    )
    if daily:
        usage = usage.groupBy("warehouse_name", "usage_date").agg(
            F.sum("credits_used_compute").alias("credits_used_compute")
        )
    executed = _daily_execution(load, as_of, days)
    joined = usage.join(sized, "warehouse_name").join(
        executed, ["warehouse_name", "usage_date"], "left"
    )
    credits = F.col("credits_used_compute").cast("double")
    return _utilisation(joined, credits / F.col("multiplier") * 3600)


def idle_gaps(
    metering: DataFrame, queries: DataFrame, day: dt.date | str | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Each metering interval with the next query starting after it.

    ``day`` restricts intervals and queries to one day, ``warehouse`` to one warehouse.
    Gaps are whole seconds above zero; ``later_queries`` counts the queries behind the
    gap on the day of the next query, instead of listing each of them with each interval.
    Queries are first reduced to one row per warehouse and second, so a day holds at most
    86,400 of them however busy the warehouse is; one backward pass then carries the next
    start to every interval end. An end without a later query on its day takes the first
    query of the next day that has one, from one row per warehouse and day.
    """
    if day is not None:
        one_day = within("start_time", to_day(day), to_day(day) + DAY)
        metering, queries = metering.where(one_day), queries.where(one_day)
    if warehouse is not None:
        one_warehouse = F.col("warehouse_name") == warehouse
        metering, queries = metering.where(one_warehouse), queries.where(one_warehouse)
    keys = ["warehouse_name", "_day"]
    intervals = (
        metering.where(F.col("start_time") <= F.col("end_time"))
        .select("warehouse_name", F.to_date("end_time").alias("_day"), "start_time", "end_time")
        .distinct()
    )
    ends = intervals.select(
        *keys, second_number("end_time").alias("_second"), F.lit(0).alias("_is_query"),
        F.lit(None).cast("timestamp_ntz").alias("_query_start"),
        F.lit(0).cast("bigint").alias("_queries"), "start_time", "end_time",
    )
    starts = (
        queries.groupBy(
            "warehouse_name", F.to_date("start_time").alias("_day"),
            second_number("start_time").alias("_second"),
        )
        .agg(
            F.min("start_time").alias("_query_start"), F.count(F.lit(1)).alias("_queries")
        )
        .select(
            *keys, "_second", F.lit(1).alias("_is_query"), "_query_start", "_queries",
            F.lit(None).cast("timestamp_ntz").alias("start_time"),
            F.lit(None).cast("timestamp_ntz").alias("end_time"),
        )
    )
    later = (
        Window.partitionBy(*keys)
        .orderBy(F.desc("_second"), "_is_query")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.unionByName(starts).withColumns(
        {"_next": F.min("_query_start").over(later), "_later": F.sum("_queries").over(later)}
    )
    daily = starts.groupBy(*keys).agg(
        F.struct(F.min("_query_start").alias("start"), F.sum("_queries").alias("n")).alias("_own")
    )
    following = (
        Window.partitionBy("warehouse_name")
        .orderBy(F.desc("_day"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    overnight = ends.select(*keys).distinct().join(daily, keys, "full").select(
        *keys, F.min("_own").over(following).alias("_other")
    )
    gap = second_number("_next") - F.col("_second")
    return (
        carried.where(F.col("_is_query") == 0)
        .join(overnight, keys, "left")
        .withColumns(
            {
                "_later": F.when(F.col("_next").isNull(), F.col("_other.n")).otherwise(F.col("_later")),
                "_next": F.coalesce("_next", "_other.start"),
            }
        )
        .where(F.col("_next").isNotNull())
        .select(
            "warehouse_name",
            F.col("start_time").alias("warehouse_start_time"),
            F.col("end_time").alias("warehouse_end_time"),
            F.col("_next").alias("next_query_start_time"),
            gap.alias("idle_seconds"),
            F.col("_later").alias("later_queries"),
        )
    )


def queries_inside(
    metering: DataFrame, queries: DataFrame, day: dt.date | str | None = None,
    warehouse: str | None = None, bin_seconds: int = 3600,
) -> DataFrame:
    """Each metering interval with the number, first and last start of the queries inside it
    (both ends included); intervals without queries have 0.

    An interval join by time bins: intervals are cut at the bounds of the bins. A bin that
    lies inside an interval as a whole is joined as one row of counts, made in the map tasks.
    Only the cut bins at both ends, two per interval, meet single query starts, and there
    the exact bounds decide. ``day`` and ``warehouse`` restrict both logs.
    """
    if day is not None:
        one_day = within("start_time", to_day(day), to_day(day) + DAY)
        metering, queries = metering.where(one_day), queries.where(one_day)
    if warehouse is not None:
        one_warehouse = F.col("warehouse_name") == warehouse
        metering, queries = metering.where(one_warehouse), queries.where(one_warehouse)

    def bin_of(column: str) -> Column:
        return F.floor(second_number(column) / bin_seconds)

    key = ["warehouse_name", "_bin"]
    interval = ["warehouse_name", "start_time", "end_time"]
    intervals = metering.where(F.col("start_time") <= F.col("end_time")).select(*interval).distinct()
    starts = queries.select(
        "warehouse_name", bin_of("start_time").alias("_bin"), F.col("start_time").alias("_start")
    ).groupBy(*key, "_start").agg(F.count(F.lit(1)).alias("_n"))
    whole_bins = starts.groupBy(*key).agg(
        F.sum("_n").alias("_n"), F.min("_start").alias("_first"), F.max("_start").alias("_last")
    )
    cut = intervals.withColumns({"_from": bin_of("start_time"), "_to": bin_of("end_time")})
    # The first and the last bin are cut, even if a bound of the interval is their own.
    inner = cut.where(F.col("_to") - F.col("_from") > 1).select(
        *interval, F.explode(F.sequence(F.col("_from") + 1, F.col("_to") - 1)).alias("_bin")
    )
    outer = cut.select(
        *interval, F.explode(F.array_distinct(F.array("_from", "_to"))).alias("_bin")
    )
    by_bin = inner.join(whole_bins, key).select(*interval, "_n", "_first", "_last")
    exact = F.col("_start").between(F.col("start_time"), F.col("end_time"))
    by_start = outer.join(starts, key).where(exact).select(
        *interval, "_n", F.col("_start").alias("_first"), F.col("_start").alias("_last")
    )
    found = by_bin.unionByName(by_start).groupBy(*interval).agg(
        F.sum("_n").alias("queries"), F.min("_first").alias("first_query_start_time"),
        F.max("_last").alias("last_query_start_time"),
    )
    return intervals.join(found, interval, "left").select(
        "warehouse_name", F.col("start_time").alias("warehouse_start_time"),
        F.col("end_time").alias("warehouse_end_time"),
        F.coalesce("queries", F.lit(0).cast("bigint")).alias("queries"),
        "first_query_start_time", "last_query_start_time",
    )
