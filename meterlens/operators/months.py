"""Month labels and month-by-month wide tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions.dates import month_label, short_month


def with_month_label(df: DataFrame, column: str, label: str = "month") -> DataFrame:
    return df.withColumn(label, month_label(column))


def pivot_months(
    df: DataFrame,
    keys: list[str],
    months: list[str],
    value: str,
    exclude: list[str] = (),
    month: str = "month",
    account: str = "account_name",
) -> DataFrame:
    """One row per key and one column per listed month label.

    The list is given, so Spark needs no extra job to find the columns; sums combine
    before the shuffle. Columns are named ``aug_24`` for ``2024-Aug``.
    """
    if exclude:
        df = df.where(~F.col(account).isin(list(exclude)))
    wide = df.groupBy(*keys).pivot(month, months).sum(value)
    return wide.withColumnsRenamed({label: short_month(label) for label in months})


def zero_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})


def drop_all_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Remove rows in which every listed column is zero."""
    all_zero = F.lit(True)
    for column in columns:
        all_zero = all_zero & (F.col(column) == 0)
    return df.where(~F.coalesce(all_zero, F.lit(False)))
