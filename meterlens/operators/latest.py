from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fetched(df: DataFrame, winners: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` that equal a row of ``winners`` (few and narrow) in the ``on`` columns,
    nulls included; one of those that repeat all of them."""
    same: list[Column] = [F.col(f"_all.{c}").eqNullSafe(F.col(f"_won.{c}")) for c in on]
    matched = df.alias("_all").join(
        winners.select(*on).alias("_won"), reduce(Column.__and__, same), "left_semi"
    )
    return matched.dropDuplicates(on)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` values for each key (null keys form a group).

    Two phases, so that wide columns are neither sorted nor combined: keys and order columns
    alone find the greatest values, one row per key and map task before the shuffle, so a
    key holding a large share of the log never has its rows gathered in one task. The
    winners then fetch their rows by a semi join. ``order`` should end in a unique column;
    of rows that are equal in it any one is taken.
    """
    greatest = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_greatest"))
    winners = greatest.select(*keys, "_greatest.*")
    return fetched(df, winners, [*keys, *order])
