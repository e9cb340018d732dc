"""Reports over the query log."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import DAY, in_months, last_days, months_between
from meterlens.operators.joins import broadcast_up_to
from meterlens.operators.latest import fetched, latest_per_key

MILLIS_PER_MINUTE = 60_000


def _timed_queries(
    query_history: DataFrame, year: int | None, months: list[int] | None, warehouse: str | None
) -> DataFrame:
    """Queries that took time, of the given months and warehouse (None: of all)."""
    picked = query_history.where(in_months("start_time", months, year))
    picked = picked.where(F.col("total_elapsed_time") > 0)
    return picked if warehouse is None else picked.where(F.col("warehouse_name") == warehouse)


def duration_bucket(elapsed: Column, bounds=fixed.DURATION_BUCKETS) -> Column:
    """Label of the first bound (inclusive) that the elapsed milliseconds do not exceed."""
    (bound, label), *others = bounds
    bucket = F.when(elapsed <= bound, label)
    for bound, label in others:
        bucket = bucket.when(elapsed <= bound, label)
    return bucket.otherwise(fixed.LONGEST_BUCKET)


def duration_buckets(
    query_history: DataFrame,
    year: int | None = None,
    months: list[int] | None = None,
    warehouse: str | None = None,
    bounds=fixed.DURATION_BUCKETS,
) -> DataFrame:
    """Queries per elapsed-time bucket."""
    timed = _timed_queries(query_history, year, months, warehouse)
    bucket = duration_bucket(F.col("total_elapsed_time"), bounds)
    return timed.groupBy(bucket.alias("buckets")).agg(
        F.count("query_id").alias("number_of_queries")
    )


def _month_lines(timed: DataFrame, parts: list[Column], order: list[Column]) -> DataFrame:
    """``month|part|...|count`` lines, one per month and part."""
    keys = [F.month("start_time").alias("u_month"), *parts]
    names = [f"_part{i}" for i in range(len(parts))]
    counted = timed.groupBy(
        keys[0], *[part.alias(name) for part, name in zip(parts, names)]
    ).agg(F.count("query_id").alias("queries_c"))
    cells = ["u_month", *names, "queries_c"]
    joined = [F.col(cells[0]).cast("string")]
    for cell in cells[1:]:
        joined += [F.lit("|"), F.col(cell).cast("string")]
    line = F.concat(*joined).alias("line")
    return counted.orderBy("u_month", *order, *names).select(line)


def duration_bucket_lines(
    query_history: DataFrame,
    year: int | None = None,
    months: list[int] | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Duration buckets by month as ``month|bucket|count`` lines."""
    timed = _timed_queries(query_history, year, months, warehouse)
    return _month_lines(timed, [duration_bucket(F.col("total_elapsed_time"))], [])


def monthly_query_lines(
    query_history: DataFrame,
    year: int | None = None,
    months: list[int] | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Queries per month as ``month|count`` lines."""
    timed = _timed_queries(query_history, year, months, warehouse)
    return _month_lines(timed, [], [])


def monthly_type_lines(
    query_history: DataFrame,
    year: int | None = None,
    months: list[int] | None = None,
    warehouse: str | None = None,
) -> DataFrame:
    """Queries per month and type as lines, most frequent type of a month first."""
    timed = _timed_queries(query_history, year, months, warehouse)
    return _month_lines(timed, [F.col("query_type")], [F.col("queries_c").desc()])


def credits_per_query(attribution: DataFrame) -> DataFrame:
    """One row per query: its credits and its number of attribution rows."""
    return attribution.groupBy("query_id").agg(
        F.sum("credits_attributed_compute").alias("credits"),
        F.count(F.lit(1)).alias("copies"),
    )


def costliest_shapes(
    query_history: DataFrame,
    attribution: DataFrame,
    as_of: dt.date | str,
    days: int = 30,
    price: Decimal = fixed.QUERY_CREDIT_PRICE,
) -> DataFrame:
    """Cost, time and volume per parameterised query hash, with the latest run's text.

    A query with several attribution rows counts once per row. The attribution is
    summed per query before the join and the repeats enter as weights, which gives the
    same figures as the repeated rows without making them. The wide query text stays
    out of the join on the query id: it is reduced to one row per hash on its own.
    """
    recent = query_history.where(last_days("start_time", as_of, days))
    recent = recent.where(F.col("query_parameterized_hash").isNotNull())
    credited = credits_per_query(attribution.where(last_days("start_time", as_of, days)))
    runs = recent.join(credited, "query_id", "left").withColumn(
        "_n", F.coalesce("copies", F.lit(1))
    )

    def total(column: str) -> Column:
        return F.sum(F.col(column) * F.col("_n"))

    def mean(column: str) -> Column:
        counted = F.sum(F.when(F.col(column).isNotNull(), F.col("_n")))
        return total(column).cast("double") / counted

    minutes = total("total_elapsed_time").cast("decimal(28,0)")
    timed_runs = F.sum(F.when(F.col("total_elapsed_time").isNotNull(), F.col("_n")))
    totals = runs.groupBy("query_parameterized_hash").agg(
        F.round(minutes / MILLIS_PER_MINUTE, 2).alias("total_execution_time_mins"),
        F.round(F.sum("credits") * F.lit(price), 2).alias("total_query_cost"),
        mean("bytes_spilled_to_local_storage").alias("bytes_spilled_local"),
        mean("bytes_spilled_to_remote_storage").alias("bytes_spilled_remote"),
        mean("bytes_sent_over_the_network").alias("bytes_sent_over_network"),
        total("rows_produced").alias("total_rows_produced"),
        mean("bytes_scanned").alias("total_bytes_scanned"),
        F.sum("_n").alias("no_of_runs"),
        F.round(
            minutes / (timed_runs * MILLIS_PER_MINUTE).cast("decimal(20,0)"), 2
        ).alias("avg_execution_time_mins"),
    )
    latest = latest_per_key(
        recent.select(
            "query_parameterized_hash", "start_time", "query_id",
            "query_text", "warehouse_name", "user_name", "role_name",
        ),
        ["query_parameterized_hash"],
        ["start_time", "query_id"],
    ).drop("start_time", "query_id")
    return (
        totals.where(F.col("total_query_cost").isNotNull())
        .join(latest, "query_parameterized_hash")
        .orderBy(
            F.desc_nulls_last("total_query_cost"),
            F.desc_nulls_last("total_execution_time_mins"),
            F.desc_nulls_last("bytes_spilled_local"),
        )
    )


def costly_runs(
    query_history: DataFrame,
    attribution: DataFrame,
    month: int,
    min_cost: int | Decimal = 500,
    price: Decimal = fixed.QUERY_CREDIT_PRICE,
    year: int | None = None,
) -> DataFrame:
    """Single runs at or above a cost in a calendar month, costliest first.

    Without a year the month of every year counts that the log touches: its first and last
    time come from one narrow aggregate and make a range per year, so both logs are pruned
    in either case. An attribution row has its query's start time; a day more is read on
    both sides.
    """
    if year is None:
        first, last = query_history.agg(F.min("start_time"), F.max("start_time")).first()
        in_time = months_between([month], first, last)
    else:
        in_time = months_between([month], dt.date(year, 1, 1), dt.date(year, 12, 31))
    runs = query_history.where(in_time("start_time"))
    if "start_time" in attribution.columns:
        attribution = attribution.where(in_time("start_time", DAY))
    runs = runs.where(F.col("partitions_scanned").isNotNull())
    cost = F.col("credits_attributed_compute") * F.lit(price)
    # The bare lower bound reaches the scan; the product decides.
    least = (Decimal(min_cost) / price).quantize(Decimal("0.0001"), rounding=ROUND_FLOOR)
    costly = attribution.where(F.col("credits_attributed_compute") >= F.lit(least))
    costly = costly.withColumn("total_query_cost", cost)
    costly = costly.where(F.col("total_query_cost") >= F.lit(Decimal(min_cost)))
    minutes = F.col("total_elapsed_time").cast("double") / 1000 / 60
    optional = [c for c in ("query_hash", "end_time") if c in query_history.columns]
    return (
        runs.join(costly.select("query_id", "total_query_cost"), "query_id")
        .select(
            "query_id", "query_text", minutes.alias("query_execution_time_mins"),
            "start_time", *optional, "partitions_scanned", "partitions_total",
            "total_query_cost", "user_name", "warehouse_name",
        )
        .orderBy(F.desc("total_query_cost"), "query_id")
    )


def failure_groups(
    query_history: DataFrame, as_of: dt.date | str, days: int = 7, limit: int = 1000
) -> DataFrame:
    """Failures by error and query type with the earliest run as the example.

    The groups are counted without the query text; the examples of the groups that are
    reported, ``limit`` at most, fetch theirs afterwards.
    """
    failed = query_history.where(last_days("start_time", as_of, days))
    failed = failed.where(F.col("execution_status") != "SUCCESS")
    keys = ["error_code", "error_message", "query_type"]
    groups = (
        failed.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("failure_count"),
            F.max("start_time").alias("last_occurrence"),
            F.min(F.struct("start_time", "query_id")).alias("_example"),
        )
        .orderBy(F.desc("failure_count"), *keys)
        .limit(limit)
        .select(*keys, "failure_count", "last_occurrence", "_example.*")
    )
    on = [*keys, "start_time", "query_id"]
    wide = failed.select(
        *on, F.col("query_text").alias("example_query_text"), F.col("user_name").alias("example_user"),
        F.col("role_name").alias("example_role"),
    )
    examples = fetched(wide, broadcast_up_to(groups, limit), on)
    same = reduce(Column.__and__, [F.col(f"g.{c}").eqNullSafe(F.col(f"x.{c}")) for c in on])
    return (
        broadcast_up_to(groups, limit).alias("g").join(examples.alias("x"), same)
        .select(
            *[F.col(f"g.{c}") for c in keys], "failure_count",
            F.col("g.start_time").alias("first_occurrence"), "last_occurrence",
            "example_query_text", "example_user", "example_role",
        )
        .orderBy(F.desc("failure_count"), *keys)
    )
