from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.sources.usage_logs import DERIVATIONS, usage_log

# Reference dates of the order-based and the event-based logs.
ORDERS_AS_OF = dt.date(1998, 7, 1)
EVENTS_AS_OF = dt.date(2024, 1, 30)
EVENTS_NOW = dt.datetime(2024, 1, 30, 13, 0, 0)


def plain_types(df: DataFrame) -> DataFrame:
    """Result types every engine shares: bigint, double, string, boolean, date."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def report(plan: Callable[..., DataFrame], *logs: str, **arguments):
    """Bind a report to usage logs by name and to its arguments."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(plan(*(usage_log(spark, folder, log) for log in logs), **arguments))

    return run


def query(build: Callable[..., DataFrame]):
    """Bind a function of ``log(name)`` to a data folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(build(lambda name: usage_log(spark, folder, name)))

    return run


def oracle(sql: str) -> str:
    """Prefix the derivations of all usage logs that a statement mentions."""
    used = [name for name in DERIVATIONS if re.search(rf"\b(from|join)\s+{name}\b", sql)]
    ctes = ",\n".join(f"{name} as ({DERIVATIONS[name].strip()})" for name in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
