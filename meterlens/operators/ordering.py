"""Row order without gathering a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 65_536


def with_previous(
    df: DataFrame, key: str, order: list[str], value: str, name: str, block: int = BLOCK
) -> DataFrame:
    """``lag(value)`` per key, splitting each key into blocks of its first order column.

    The first order column must be an integer. Inside a block a window finds the
    previous row; the first row of a block takes the last value of the key's previous
    block from a table with one row per block. Both sides start from the same exchange
    (the block is never null, so no null filter tells them apart): the input is read and
    shuffled once, and no task ever holds more than a block. Rows without a key drop out.
    """
    blocked = df.withColumn(
        "_block", F.coalesce(F.expr(f"`{order[0]}` div {block}"), F.lit(0).cast("bigint"))
    )
    blocked = blocked.repartition(key, "_block")
    position = F.struct(*order, value)
    ends = blocked.groupBy(key, "_block").agg(F.max_by(value, position).alias("_end"))
    by_key = Window.partitionBy(key).orderBy("_block")
    carried = ends.select(key, "_block", F.lag("_end").over(by_key).alias("_carried"))
    inside = Window.partitionBy(key, "_block").orderBy(*order, value)
    numbered = blocked.withColumns(
        {"_row": F.row_number().over(inside), "_before": F.lag(value).over(inside)}
    )
    previous = F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_before"))
    return (
        numbered.join(carried, [key, "_block"])
        .withColumn(name, previous)
        .select(*df.columns, name)
    )


def with_row_number(
    df: DataFrame, slots: list[str], order: list[str | Column], name: str
) -> DataFrame:
    """Global row numbers from 1, ordered by the ``slots`` columns and then ``order``.

    Rows are ranked inside their innermost slot only. The offset of a slot is a running
    sum over one count per slot within the next outer slot, so a window never sees more
    rows than an outer slot has inner ones. The caller picks slots that are fine enough;
    slot columns must not be null.
    """
    counts = df.groupBy(*slots).agg(F.count(F.lit(1)).alias("_rows"))
    numbered = df.withColumn("_rank", F.row_number().over(_by(slots).orderBy(*order)))
    number = F.col("_rank")
    for level in range(len(slots), 0, -1):
        outer, slot = slots[: level - 1], slots[level - 1]
        earlier = _by(outer).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(f"_before{level}")
        numbered = numbered.join(counts.select(*slots[:level], before), slots[:level])
        number = number + F.col(f"_before{level}")
        counts = counts.groupBy(*outer).agg(F.sum("_rows").alias("_rows"))
    return numbered.select(*df.columns, number.alias(name))


def _by(columns: list[str]):
    return Window.partitionBy(*columns) if columns else Window.partitionBy(F.lit(0))
