"""Helpers shared by the text operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import pathlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlens.sources.workdir import work_folder

# Rows in one numbering block: the most that one task has to hold together.
BLOCK_ROWS = 4096
# Fixed value: the setting by which a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared work folder and read it back: later steps start from
    the files, also after executors were lost. Once it is written nothing reads the
    shuffles that led to it, so their files go at once instead of with the driver's next
    garbage collection; without such a setting Spark keeps them until then."""
    spark, path = df.sparkSession, work_folder(df.sparkSession, name)
    before = spark.conf.get(FREE_SHUFFLES) if spark.conf.isModifiable(FREE_SHUFFLES) else None
    if before is not None:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is not None:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _give_memory_back() -> None:
    """Workers outlive their tasks and share an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no such call in other C libraries
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_batches(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` whose Python workers find this package where it lies on the same path;
    elsewhere it is shipped with ``--py-files``. A task's memory is given back at its end."""

    def run(batches):
        yield from function(batches)
        _give_memory_back()

    environment = df.sparkSession.sparkContext.environment
    root = str(pathlib.Path(__file__).resolve().parents[2])
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = f"{root}:{environment.get('PYTHONPATH', '')}".rstrip(":")
    return df.mapInArrow(run, schema)


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: numbers from 0 without a gap among the rows of equal keys.

    Rows of a key are spread over hashed blocks. Blocks are counted, their first numbers
    summed up, and rows numbered inside their block, so a key that holds most rows is
    never sorted in one task. ``df`` is read twice: pass a stored table.
    """
    blocks = max(1, math.ceil(df.count() / BLOCK_ROWS))
    block, first, count = f"{name}_block", f"{name}_first", f"{name}_count"
    spread = df.withColumn(block, F.pmod(F.xxhash64(*order), F.lit(blocks)))
    before = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        spread.groupBy(*keys, block)
        .agg(F.count(F.lit(1)).alias(count))
        .select(*keys, block, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(first))
    )
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    numbered = spread.withColumn(count, F.row_number().over(inside) - 1)
    left, right = numbered.alias("left"), firsts.alias("right")
    same = [F.col(f"left.{c}").eqNullSafe(F.col(f"right.{c}")) for c in (*keys, block)]
    return left.join(right, same).select(
        *[F.col(f"left.{c}") for c in df.columns],
        (F.col(f"left.{count}") + F.col(f"right.{first}")).cast("long").alias(name),
    )
