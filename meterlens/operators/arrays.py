from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, keep: list[str], array: Column, name: str) -> DataFrame:
    """One row per array element, null elements included, with the kept columns.

    A plain ``explode`` makes Spark add a filter on the array's size, which works out the
    array a second time. The outer form does not; rows of empty and null arrays are
    dropped by their missing position instead.
    """
    exploded = df.select(*keep, F.posexplode_outer(array).alias("_position", name))
    return exploded.where(F.col("_position").isNotNull()).drop("_position")
