from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
KEYS_PER_PARTITION = 250_000


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only when the plan itself bounds the number of rows.

    ``rows`` must be a true upper bound (a top-n limit, an argument list). Beyond
    ``BROADCAST_ROWS`` nothing is hinted and Spark picks the join from measured sizes.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def spread_by(df: DataFrame, key: str, keys: int) -> DataFrame:
    """Partition by a key with about ``keys`` values, so that a task gets a bounded number.

    Adaptive execution merges partitions until there are hardly more than cores; a stage
    that sorts, joins and combines then needs memory in proportion to the table. A number
    given here is kept. It is never less than that of other shuffles.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-keys // KEYS_PER_PARTITION)), key)
