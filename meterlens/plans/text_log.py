"""Table names in the query log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions import text
from meterlens.operators.arrays import explode_once


def _with_names(df: DataFrame, text_col: str, clean: bool) -> DataFrame:
    """Adds the array of names; the upper-cased text is made once per row."""
    upper = df.withColumn("_upper", F.upper(F.col(text_col)))
    names = text.referenced_tables(F.col("_upper"), clean)
    return upper.withColumn("_names", names).drop("_upper")


def table_references(
    df: DataFrame, text_col: str, clean: bool = False, name: str = "table_names"
) -> DataFrame:
    """Adds the comma-separated names of the tables a text mentions, null without any."""
    listed = F.when(F.size("_names") > 0, F.array_join("_names", ", "))
    return _with_names(df, text_col, clean).withColumn(name, listed).drop("_names")


def table_reference_counts(df: DataFrame, text_col: str, clean: bool = False) -> DataFrame:
    """How often each table is mentioned over the whole log."""
    named = _with_names(df.select(text_col), text_col, clean)
    mentions = explode_once(named, [], F.col("_names"), "table_name")
    return mentions.groupBy("table_name").agg(F.count(F.lit(1)).alias("mentions"))


def merge_target(df: DataFrame, text_col: str, name: str = "target_table") -> DataFrame:
    """Adds the target of a merge, found by pattern."""
    found = text.extract(F.col(text_col), fixed.MERGE_TARGET_PATTERN, 1)
    return df.withColumn(name, found)


def merge_target_by_position(
    df: DataFrame, text_col: str, name: str = "target_table"
) -> DataFrame:
    """Adds the target of a merge, cut out by position (upper-cased)."""
    return df.withColumn(name, text.first_word(text.after_merge_phrase(F.col(text_col))))


def leading_identifier(df: DataFrame, text_col: str, name: str = "target_table") -> DataFrame:
    """Adds the one- to three-part identifier at the start of the text."""
    found = text.extract(F.col(text_col), fixed.LEADING_IDENTIFIER_PATTERN, 0)
    return df.withColumn(name, found)


def identifier_argument(df: DataFrame, text_col: str, name: str = "argument") -> DataFrame:
    """Adds the argument of the first ``IDENTIFIER('...')``."""
    found = text.extract(F.col(text_col), fixed.IDENTIFIER_ARGUMENT_PATTERN, 1)
    return df.withColumn(name, found)


def identifier_call(df: DataFrame, text_col: str, name: str = "call") -> DataFrame:
    """Adds the first ``IDENTIFIER('...')`` as a whole."""
    found = text.extract(F.col(text_col), fixed.IDENTIFIER_CALL_PATTERN, 0)
    return df.withColumn(name, found)
