"""Micro-batches written with their batch number, so that a repeated batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlens.functions.dates import as_utc

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams with much state: the state store keeps it in files
    of each executor, backed up beside the checkpoint, instead of in its memory."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def run_batches(stream: DataFrame, state: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hand all available rows to ``write(batch, number)``, batch by batch.

    How much a batch holds is set where the stream is read (files or bytes per trigger).
    After a failure the last batch comes again with its number and the same rows, so
    ``write`` has to replace what it wrote under that number.
    """
    writer = stream.writeStream.foreachBatch(write).trigger(availableNow=True)
    writer.option("checkpointLocation", state).start().awaitTermination()


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, pattern: str) -> bool:
    files, path = _files(spark, pattern)
    return bool(files.globStatus(path))


class Versions:
    """A small table with one whole copy per batch; version 0 is the state before any."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def at(self, version: int) -> str:
        return f"{self.path}/version-{version}"

    def read(self, version: int) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.at(version))

    def write(self, df: DataFrame, version: int) -> None:
        """Replace a version and drop the one before the last: a repeated batch needs only
        its predecessor."""
        df.coalesce(1).write.mode("overwrite").parquet(self.at(version))
        files, old = _files(self.spark, self.at(version - 2))
        if version > 2:
            files.delete(old, True)

    def newest(self) -> int:
        files, folder = _files(self.spark, self.path)
        if not files.exists(folder):
            return 0
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        complete = [
            int(name.removeprefix("version-")) for name in names
            if exists(self.spark, f"{self.path}/{name}/_SUCCESS")
        ]
        return max(complete, default=0)


def keep_late(
    stream: DataFrame, dest: str, column: str, delay: str, window: str = "1 minute"
) -> DataFrame:
    """Keep the rows that a watermark of the stream drops, and return all kept so far.

    A row is late if its window ended at or before the newest time of all earlier batches
    less ``delay``: the rule by which stateful operators leave rows out. Run it over the same
    source and with the same batch size as the operator. Rows and newest time come from one
    pass over a batch; both are stored under its number.
    """
    spark = stream.sparkSession
    newest = Versions(spark, f"{dest}/newest", "newest bigint")  # microseconds
    micros = F.unix_micros(as_utc(column))

    def write(batch: DataFrame, number: int) -> None:
        known = newest.read(number).first()
        path, latest = f"{dest}/late/_batch={number}", F.max(micros).alias("newest")
        if known is None or known.newest is None:  # no time yet, so nothing is late
            seen = batch.agg(latest).first().newest
            batch.limit(0).write.mode("overwrite").parquet(path)
        else:
            observed, end = Observation(), F.window(as_utc(column), window).getField("end")
            late = end <= F.timestamp_micros(F.lit(known.newest)) - F.expr(f"interval {delay}")
            batch.observe(observed, latest).where(late).write.mode("overwrite").parquet(path)
            seen = max(known.newest, observed.get["newest"] or known.newest)
        newest.write(spark.createDataFrame([(seen,)], newest.schema), number + 1)

    run_batches(stream, f"{dest}/state", write)
    return spark.read.schema(stream.schema).parquet(f"{dest}/late")
