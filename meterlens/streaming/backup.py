from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.functions.dates import as_utc, from_utc, moment
from meterlens.sources.dated import UNITS, day_of_rows, with_period
from meterlens.streaming.batches import Versions, exists, run_batches


@dataclass(frozen=True)
class BackupRun:
    """Where a backup stream writes its copy, the counts of final days and all its days."""

    copy: str
    counts: str
    days_now: str


def daily_counts(stream: DataFrame, column: str, lag: str = "3 days") -> DataFrame:
    """Rows per day; a day is final once the watermark has passed its end."""
    timed = stream.select(as_utc(column).alias("event_time"))
    days = timed.withWatermark("event_time", lag).groupBy(F.window("event_time", "1 day"))
    counted = days.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.to_date(from_utc("window.start")).alias("run_date"), "row_count")


def run_to_end(df: DataFrame, path: str, partition: str | None = None):
    """Append everything available to a parquet folder, exactly once across restarts.

    Offsets and state live beside the data, in a folder all executors share.
    """
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer = writer.option("checkpointLocation", f"{path}-state")
    if partition is not None:
        writer = writer.partitionBy(partition)
    query = writer.start(path)
    query.awaitTermination()
    return query


DAYS = "run_date date, row_count bigint, late_rows bigint, newest timestamp_ntz"


def _batch_rows(batch: DataFrame, copy: str, period: str, number: int) -> DataFrame:
    """The rows of one batch, from the folders it wrote (none for an empty batch)."""
    spark, folders = batch.sparkSession, f"{copy}/{period}=*/_batch={number}"
    if not exists(spark, folders):
        return spark.createDataFrame([], batch.schema)
    return spark.read.option("basePath", copy).parquet(folders)


def _write_batch(
    batch: DataFrame, number: int, dest: str, column: str, lag: str, unit: str
) -> None:
    """One batch of the backup: its rows, then the counts of what was written.

    The batch is read once. The writer sorts by period; the rebalance splits large batches and
    periods, so that a task sorts no more than about the advisory partition size. Counts come
    from the copy, so the two cannot disagree, and both stand under the batch's number:
    writing it again replaces them.
    """
    spark, period, copy = batch.sparkSession, UNITS[unit], f"{dest}/copy"
    days, counts = _versions(spark, dest)
    before = days.read(number)
    dated = with_period(batch, column, unit).withColumn("_batch", F.lit(number).cast("bigint"))
    (
        dated.hint("rebalance", period)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period, "_batch")
        .parquet(copy)
    )
    closed = before.agg((F.max("newest") - F.expr(f"interval {lag}")).alias("at")).first().at
    day = F.to_date(column)
    ends = (F.date_add(day, 1)).cast("timestamp_ntz")
    late = F.lit(False) if closed is None else ends <= moment(closed)
    written = _batch_rows(batch, copy, period, number).where(F.col(column).isNotNull())
    fresh = written.groupBy(day.alias("run_date")).agg(
        F.count_if(~late).alias("row_count"), F.count_if(late).alias("late_rows"),
        F.max(column).alias("newest"),
    )
    summed = before.unionByName(fresh).groupBy("run_date").agg(
        F.sum("row_count").alias("row_count"), F.sum("late_rows").alias("late_rows"),
        F.max("newest").alias("newest"),
    )
    days.write(summed, number + 1)
    now = days.read(number + 1)
    passed = now.agg((F.max("newest") - F.expr(f"interval {lag}")).alias("at")).first().at
    final = F.lit(False)
    if passed is not None:
        final = F.date_add("run_date", 1).cast("timestamp_ntz") <= moment(passed)
    counts.write(now.where(final & (F.col("row_count") > 0)).select("run_date", "row_count"), number + 1)


def _versions(spark: SparkSession, dest: str) -> tuple[Versions, Versions]:
    return (
        Versions(spark, f"{dest}/days", DAYS),
        Versions(spark, f"{dest}/counts", "run_date date, row_count bigint"),
    )


def stream_backup(
    stream: DataFrame, dest: str, column: str, lag: str = "3 days", unit: str = "day"
) -> BackupRun:
    """Append arriving rows to a partitioned copy and count them per day.

    The copy takes every row. A day is counted once the watermark (the newest time of all
    rows less ``lag``) has passed it; rows that arrive even later are in the copy only, see
    ``late_rows``. Copy and counts are one sink with numbered batches: a batch is read once
    and may be repeated, and files that arrive meanwhile belong to the next. The batch size
    is that of the stream; without late rows the counts are the same for any size.
    """
    spark = stream.sparkSession
    run_batches(
        stream, f"{dest}/state",
        lambda batch, number: _write_batch(batch, number, dest, column, lag, unit),
    )
    days, counts = _versions(spark, dest)
    if counts.newest() == 0:  # nothing has arrived yet
        days.write(days.read(0), 1)
        counts.write(counts.read(0), 1)
        with_period(spark.createDataFrame([], stream.schema), column, unit).write.mode(
            "ignore"
        ).parquet(f"{dest}/copy")
    return BackupRun(f"{dest}/copy", counts.at(counts.newest()), days.at(days.newest()))


def late_rows(spark: SparkSession, run: BackupRun, column: str) -> DataFrame:
    """Rows per counted day that came too late for the count, over all runs so far."""
    copy = spark.read.parquet(run.copy)
    copied = copy.groupBy(day_of_rows(copy, column).alias("run_date")).agg(
        F.count(F.lit(1)).alias("copied")
    )
    compared = spark.read.parquet(run.counts).join(copied, "run_date")
    late = compared.select("run_date", (F.col("copied") - F.col("row_count")).alias("late_rows"))
    return late.where(F.col("late_rows") > 0)


def copy_differences(spark: SparkSession, run: BackupRun, column: str) -> DataFrame:
    """Days on which the copy does not hold what its batches wrote: rows missing (below
    zero) or too many. Days that are not final yet and late rows are included."""
    booked = spark.read.parquet(run.days_now).select(
        "run_date", (F.col("row_count") + F.col("late_rows")).alias("booked")
    )
    copy = spark.read.parquet(run.copy).where(F.col(column).isNotNull())
    found = copy.groupBy(day_of_rows(copy, column).alias("run_date")).agg(
        F.count(F.lit(1)).alias("copied")
    )
    none = F.lit(0).cast("bigint")
    off = F.coalesce("copied", none) - F.coalesce("booked", none)
    return booked.join(found, "run_date", "full").select("run_date", off.alias("difference")).where(
        F.col("difference") != 0
    )
