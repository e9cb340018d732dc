from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions.dates import as_utc, from_utc


def failure_stream(tasks: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Failed tasks per one-hour window, advancing by one minute.

    Works on a stream and on a batch. Failures are first counted per minute, so each
    minute, not each failure, enters its sixty overlapping windows; the watermark bounds
    both states. All tasks move the watermark, so a quiet hour does not hold back the
    windows before it.
    """
    timed = tasks.select(as_utc("query_start_time").alias("started"), "state")
    minutes = (
        timed.withWatermark("started", watermark)
        .groupBy(F.window("started", "1 minute").alias("minute"))
        .agg(F.count_if(F.col("state") == "FAILED").alias("failures"))
    )
    hours = minutes.groupBy(
        F.window(F.window_time("minute"), "1 hour", "1 minute").alias("hour")
    ).agg(F.sum("failures").alias("failures"))
    return hours.select(
        from_utc("hour.start").alias("window_start"), from_utc("hour.end").alias("window_end"),
        "failures",
    ).where(F.col("failures") > 0)
