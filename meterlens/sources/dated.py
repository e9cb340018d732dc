"""Parquet tables partitioned by day or month.

Choose the unit so that one partition holds at least some hundred megabytes. Expiring
or replacing periods touches whole partition folders; no plan reads and overwrites the
same files.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.functions.dates import DAY, shift_months
from meterlens.sources.workdir import work_folder

UNITS = {"day": "_day", "month": "_month"}
SCHEMA_FOLDER = "_schema"  # readers of the data skip names with a leading underscore


def with_period(df: DataFrame, column: str, unit: str) -> DataFrame:
    """Adds the partition column: the first day of the row's period."""
    day = F.to_date(column)
    return df.withColumn(UNITS[unit], day if unit == "day" else F.trunc(day, unit))


def write_dated(df: DataFrame, path: str, column: str, mode: str, unit: str = "day") -> None:
    """Write with one folder per period of ``column``.

    The rebalance hint lets Spark split large periods over several tasks and files and
    merge small ones.
    """
    period = UNITS[unit]
    dated = with_period(df, column, unit)
    dated.hint("rebalance", period).write.mode(mode).partitionBy(period).parquet(path)
    keep_schema(dated, path)


def keep_schema(df: DataFrame, path: str) -> None:
    """Keep the schema beside the data: a table without partitions has no file to tell it."""
    text = df.sparkSession.range(1).select(F.lit(df.schema.json()).alias("value"))
    text.coalesce(1).write.mode("overwrite").text(f"{path}/{SCHEMA_FOLDER}")


def read_dated(spark: SparkSession, path: str) -> DataFrame:
    """The table, also when it has no partition (any more)."""
    folder = f"{path}/{SCHEMA_FOLDER}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.read.parquet(path)
    schema = T.StructType.fromJson(json.loads(spark.read.text(folder).first()[0]))
    return spark.read.schema(schema).parquet(path)


def overwrite_periods(df: DataFrame, path: str, period: str) -> None:
    """Write the periods contained in ``df``, replacing those only."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )
    keep_schema(df, path)


def period_column(table: DataFrame) -> str:
    """The partition column of a table written by ``write_dated``."""
    return next(name for name in UNITS.values() if name in table.columns)


def day_of_rows(table: DataFrame, column: str) -> Column:
    """The day of every row; from the folder names alone if the table is kept by day."""
    by_day = UNITS["day"] in table.columns
    return F.col(UNITS["day"]) if by_day else F.to_date(column)


def newest_value(spark: SparkSession, path: str, column: str) -> dt.datetime | None:
    """Latest value of the time column; the newest partition is known from the folder
    names, and only its files are read."""
    days = partition_days(spark, path)
    if not days:
        return None
    table = read_dated(spark, path)
    newest = table.where(F.col(period_column(table)) == F.lit(days[-1]))
    return newest.agg(F.max(column)).first()[0]


def _partition_folders(spark: SparkSession, path: str):
    """File system and ``{first day: folder}`` of the partitions (metadata only)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = {}
    if files.exists(hadoop):
        for status in files.listStatus(hadoop):
            value = status.getPath().getName().partition("=")[2]
            try:
                found[dt.date.fromisoformat(value)] = status.getPath()
            except ValueError:  # rows without a time, commit markers
                continue
    return files, found


def partition_days(spark: SparkSession, path: str) -> list[dt.date]:
    """First day of each partition."""
    return sorted(_partition_folders(spark, path)[1])


def drop_partitions(spark: SparkSession, path: str, days: list[dt.date]) -> None:
    """Delete whole partitions; safe to repeat after a failure."""
    files, found = _partition_folders(spark, path)
    for day in days:
        if day in found:
            files.delete(found[day], True)


def drop_rows_before(spark: SparkSession, path: str, column: str, cutoff: dt.date) -> None:
    """Remove rows before a date: whole partitions at once, the rest of one by rewriting.

    Kept by day, the cutoff always falls between two partitions. Kept by month, the rows
    to keep of the month it falls in are staged in a folder of their own first.
    """
    days = [day for day in partition_days(spark, path) if day < cutoff]
    if not days:
        return
    table = read_dated(spark, path)
    period, last = period_column(table), days[-1]
    end = last + DAY if period == UNITS["day"] else shift_months(last, 1)
    drop_partitions(spark, path, days if end <= cutoff else days[:-1])
    if end > cutoff:
        kept = table.where((F.col(period) == F.lit(last)) & (F.col(column) >= F.lit(cutoff)))
        staged = work_folder(spark, "kept-rows")
        kept.write.parquet(staged)
        kept = spark.read.parquet(staged)
        if kept.isEmpty():
            drop_partitions(spark, path, [last])
        else:
            overwrite_periods(kept, path, period)
