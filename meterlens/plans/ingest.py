"""Flattening, backup, purge and load audit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions.dates import DAY, moment, shift_months, to_day
from meterlens.functions.text import canonical_scalar, numbers_as_marked_text, without_marks
from meterlens.operators.arrays import explode_once
from meterlens.sources.dated import (
    day_of_rows,
    drop_rows_before,
    newest_value,
    period_column,
    read_dated,
    write_dated,
)


def flatten_attributes(
    df: DataFrame, id: str = "id", ids: str = "ids", attributes: str = "attributes",
    max_keys: int | None = None,
) -> DataFrame:
    """One column per key of a JSON object column and one row per element of an id array.

    The keys are found by a distributed distinct; only their names come to the driver, and
    more than ``max_keys`` of them are an error. For very many keys there is
    ``flatten_attributes_long``. Each object is parsed once per row. Values are text:
    numbers (with all their digits) and booleans in canonical form, anything else as it
    stands.
    """
    found = explode_once(df, [], F.json_object_keys(attributes), "key").distinct()
    found = found if max_keys is None else found.limit(max_keys + 1)
    keys = sorted(row.key for row in found.collect())
    if max_keys is not None and len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} distinct attribute keys")
    values = _attribute_values(attributes).alias("_values")
    # Numbered names until the end: keys may differ in case only.
    numbered = {f"_value{i}": key for i, key in enumerate(keys)}
    parsed = df.select(id, ids, values).select(
        id, ids, *[F.col("_values")[k].alias(n) for n, k in numbered.items()]
    )
    listed = F.from_json(ids, "array<string>")
    exploded = explode_once(parsed, [id, *numbered], listed, "individual_id")
    return exploded.select(
        id, "individual_id", *[F.col(name).alias(key) for name, key in numbered.items()]
    )


def flatten_attributes_long(
    df: DataFrame, id: str = "id", ids: str = "ids", attributes: str = "attributes"
) -> DataFrame:
    """One row (id, individual_id, key, value) per element of the id array and key of the
    object, for any number of keys. Values are those of ``flatten_attributes``; a key whose
    value is null has a row, an object without keys has none."""
    entries = F.map_entries(_attribute_values(attributes))
    pairs = explode_once(df, [id, ids], entries, "_entry").select(
        id, ids, F.col("_entry.key").alias("_key"), F.col("_entry.value").alias("_value")
    )
    listed = F.from_json(ids, "array<string>")
    exploded = explode_once(pairs, [id, "_key", "_value"], listed, "individual_id")
    return exploded.select(id, "individual_id", F.col("_key").alias("key"), F.col("_value").alias("value"))


def _attribute_values(attributes: str) -> Column:
    values = F.from_json(numbers_as_marked_text(F.col(attributes)), "map<string,string>")
    return F.transform_values(values, lambda _, value: canonical_scalar(without_marks(value)))


def audit_rows(
    df: DataFrame, column: str, table: str, load_type: str, start_time: dt.datetime
) -> DataFrame:
    """Load statistics: one row per day of the loaded rows."""
    return _audit(df.select(F.to_date(column).alias("run_date")), table, load_type, start_time)


def _audit(days: DataFrame, table: str, load_type: str, start_time: dt.datetime) -> DataFrame:
    return (
        days.groupBy("run_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            "run_date",
            F.lit(table).alias("table_name"),
            F.lit(load_type).alias("load_type"),
            moment(start_time).alias("start_time"),
            "row_count",
        )
    )


def backup_initial(
    source: DataFrame, dest: str, column: str, table: str, start_time: dt.datetime,
    limit: int | None = None, unit: str = "day",
) -> DataFrame:
    """Copy a table, partitioned by ``column``; fails if the copy exists.

    Returns audit rows per day. With ``limit`` only that many rows are copied (a trial
    run) and one audit row of the whole run is returned.
    """
    rows = source if limit is None else source.limit(limit)
    write_dated(rows, dest, column, "errorifexists", unit)
    copied = read_dated(source.sparkSession, dest)
    day = day_of_rows(copied, column) if limit is None else F.lit(start_time.date())
    return _audit(copied.select(day.alias("run_date")), table, "initial", start_time)


def backup_delta(
    source: DataFrame, dest: str, column: str, table: str, as_of: dt.date | str,
    start_time: dt.datetime, lag_days: int = 3, strict: bool = False, unit: str = "day",
) -> DataFrame:
    """Append the rows newer than the copy, up to ``lag_days`` before ``as_of``.

    Returns audit rows per day, counted on the copy; none if it is already up to date. An
    empty copy loads everything up to the lag; ``strict`` makes it count as up to date
    instead.
    """
    spark = source.sparkSession
    bound = to_day(as_of) - lag_days * DAY
    newest = newest_value(spark, dest, column)
    up_to_date = strict if newest is None else newest >= dt.datetime.combine(bound, dt.time())
    added = F.col(column) < F.lit(bound + DAY)
    if newest is not None:
        added = added & (F.col(column) > moment(newest))
    if up_to_date:
        return audit_rows(source.limit(0), column, table, "delta", start_time)
    write_dated(source.where(added), dest, column, "append", unit)
    copied = read_dated(spark, dest)
    if newest is not None:
        first = newest.date() if unit == "day" else newest.date().replace(day=1)
        copied = copied.where(F.col(period_column(copied)) >= F.lit(first))
    return audit_rows(copied.where(added), column, table, "delta", start_time)


def store_audit(audit: DataFrame, path: str) -> None:
    """Add the audit rows of a load to a stored audit table. Storing the same load (table,
    type and start time) again replaces its rows."""
    keyed = audit.withColumn("load_id", F.date_format("start_time", "yyyyMMddHHmmss"))
    (
        keyed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("table_name", "load_type", "load_id")
        .parquet(path)
    )


def purge_older_than(
    spark: SparkSession, path: str, column: str, as_of: dt.date | str, years: int = 3,
    lag_days: int = 3,
) -> DataFrame:
    """Remove rows older than some years from a partitioned copy and report how many.

    ``counted`` uses a cutoff some days earlier than ``deleted`` does. Counting reads
    the expired partitions only.
    """
    day = to_day(as_of)
    cutoff = shift_months(day, -12 * years)
    earlier = shift_months(day - lag_days * DAY, -12 * years)
    table = read_dated(spark, path)
    old = table.where(
        (F.col(period_column(table)) < F.lit(cutoff)) & (F.col(column) < F.lit(cutoff))
    )
    counts = old.agg(
        F.count_if(F.col(column) < F.lit(earlier)).alias("counted"),
        F.count(F.lit(1)).alias("deleted"),
    ).first()
    drop_rows_before(spark, path, column, cutoff)
    return spark.createDataFrame([tuple(counts)], "counted bigint, deleted bigint")


def join_and_save(left: DataFrame, right: DataFrame, dest: str) -> DataFrame:
    """Inner join on id, saved as a table that replaces the previous one."""
    joined = left.join(right, "id").select("id", "name", "value")
    joined.write.mode("overwrite").parquet(dest)
    return left.sparkSession.read.parquet(dest)
