import datetime as dt
import pathlib
import sys
from decimal import Decimal

import pytest
from pyspark.sql import types as T

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from meterlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture
def frame(spark):
    """Small literal table: ``frame("a int, b string", (1, "x"), ...)``."""

    def build(schema, *rows):
        kinds = [field.dataType for field in T.StructType.fromDDL(schema)]
        return spark.createDataFrame(
            [
                tuple(
                    Decimal(str(v)) if v is not None and isinstance(kind, T.DecimalType) else v
                    for v, kind in zip(row, kinds)
                )
                for row in rows
            ],
            schema,
        )

    return build


@pytest.fixture
def at():
    """``at("1998-07-01 06:00:00")`` as a datetime."""
    return dt.datetime.fromisoformat


def rows(df, *order):
    return [tuple(row) for row in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
