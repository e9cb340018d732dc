"""Health flags over per-operator statistics of the slowest queries.

Two windows are reported: the last seven days (ages 0 to 6 at ``as_of``) and ages 8 to
14. Age 7 belongs to neither; this gap is kept on purpose. Every operator is tested for
producing more rows than it reads, not only joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import DAY, last_days, to_day, within
from meterlens.operators.joins import broadcast_up_to
from meterlens.operators.ordering import BLOCK
from meterlens.sources.dated import (
    UNITS,
    drop_partitions,
    overwrite_periods,
    partition_days,
    read_dated,
)

WINDOWS = {"7_days": (6, 0), "8_14_days": (14, 8)}
LISTED_IDS = 1_000  # a list is searched from its start for each row
FLAGS = (
    "exploding_join", "union_without_all", "queries_too_large_memory", "inefficient_pruning",
)
STATISTICS = (
    "input_rows double, output_rows double, "
    "spilling struct<bytes_spilled_local_storage: double, bytes_spilled_remote_storage: double>, "
    "pruning struct<partitions_scanned: double, partitions_total: double>"
)


def slowest_queries(
    query_history: DataFrame, as_of: dt.date | str, min_age: int = 0, max_age: int = 6,
    n: int = 100,
) -> DataFrame:
    """The n longest queries of an age range (days), ties by query id."""
    aged = query_history.where(last_days("start_time", as_of, max_age, min_age))
    longest = aged.orderBy(F.desc_nulls_last("total_elapsed_time"), "query_id").limit(n)
    return longest.select("query_id", "total_elapsed_time")


def _slowest_by_window(
    query_history: DataFrame, as_of: dt.date | str, n: int, windows: list[str]
) -> DataFrame:
    """The n longest queries of each window, in one pass over the log.

    The rank filter becomes a group limit, so each task passes on at most n rows per
    window before the shuffle.
    """
    label, wanted = F.lit(None).cast("string"), F.lit(False)
    for name in windows:
        oldest, newest = WINDOWS[name]
        aged = last_days("start_time", as_of, oldest, newest)
        label, wanted = F.when(aged, F.lit(name)).otherwise(label), wanted | aged
    longest = Window.partitionBy("window").orderBy(
        F.desc_nulls_last("total_elapsed_time"), "query_id"
    )
    ranked = query_history.where(wanted).select(
        "query_id", "total_elapsed_time", label.alias("window"),
        F.to_date("start_time").alias(UNITS["day"]),
    )
    ranked = ranked.withColumn("_rank", F.row_number().over(longest))
    return ranked.where(F.col("_rank") <= n).select("query_id", "window", UNITS["day"])


def _slowest_ids(query_history, as_of, n: int, windows: list[str]) -> DataFrame:
    ids = _slowest_by_window(query_history, as_of, n, windows)
    return broadcast_up_to(ids, n * len(windows))


def with_statistic_flags(operators: DataFrame) -> DataFrame:
    """The three flags that need only an operator's own statistics."""
    parsed = operators.withColumn("_s", F.from_json("operator_statistics", STATISTICS))
    grew = F.try_divide("_s.output_rows", "_s.input_rows") > 1
    spilled = (F.col("_s.spilling.bytes_spilled_local_storage") > 0) | (
        F.col("_s.spilling.bytes_spilled_remote_storage") > 0
    )
    ratio = F.try_divide("_s.pruning.partitions_scanned", "_s.pruning.partitions_total")
    unpruned = (ratio >= fixed.PRUNING_RATIO) & (
        F.col("_s.pruning.partitions_total") >= fixed.PRUNING_PARTITIONS
    )
    return parsed.withColumns(
        {
            "exploding_join": _flag((F.col("_s.input_rows") > 0) & grew),
            "queries_too_large_memory": _flag(spilled),
            "inefficient_pruning": _flag(unpruned),
        }
    ).drop("_s")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _selected(
    operators: DataFrame, ids: DataFrame, as_of, windows: list[str], most: int
) -> DataFrame:
    """Operators of the selected queries, of which there are ``most`` at the most.

    Few ids (up to ``LISTED_IDS``) also become one list that filters the log: a filter on a
    key reaches the scans below joins and windows that a log is made by, a semi join stays
    above them, and the whole log would be shuffled first. A dated log (with the
    ``start_time`` of the queries) is read for the days of the windows only. Is it kept in
    partitions by day, the days of the selected queries prune it further while the join runs.
    """
    on = ["query_id"]
    if "start_time" in operators.columns:
        ages = [age for name in windows for age in WINDOWS[name]]
        day = to_day(as_of)
        operators = operators.where(
            within("start_time", day - max(ages) * DAY, day - min(ages) * DAY + DAY)
        )
    if UNITS["day"] in operators.columns:
        on.append(UNITS["day"])
    if most <= LISTED_IDS:
        listed = ids.agg(F.collect_set("query_id")).scalar()
        operators = operators.where(F.array_contains(listed, F.col("query_id")))
    return operators.join(ids, on, "left_semi")


def _flags_per_query(operators: DataFrame, flags: list[str]) -> DataFrame:
    """Number of flagged operators of each query, all flags in one pass.

    The statistics are parsed for these operators only. The flags are counted, not filtered
    on: a filter would be moved below the selection and would parse the whole log. A union
    is flagged if it directly follows an aggregate in operator order; that order is made in
    blocks of operator numbers, and between blocks only their first and last type
    count. So a query with very many operators is never sorted in one task.
    """
    own = [f for f in flags if f != "union_without_all"]
    if own:
        operators = with_statistic_flags(operators)
    block = F.coalesce(F.expr(f"operator_id div {BLOCK}"), F.lit(0).cast("bigint"))
    in_order = F.array_sort(F.collect_list(F.struct("operator_id", "step_id", "operator_type")))
    measures = [F.count_if(F.col(f)).alias(f) for f in own]
    if len(own) == len(flags):
        return operators.groupBy("query_id").agg(*measures)
    blocks = operators.groupBy("query_id", block.alias("_block")).agg(
        *measures, in_order.alias("_ops")
    )
    types = F.col("_ops.operator_type")
    follows = F.zip_with(
        F.slice(types, 1, F.size(types) - 1), F.slice(types, 2, F.size(types) - 1),
        lambda before, after: _flag(_needless(before, after)),
    )
    inside = F.size(F.filter(follows, lambda found: found))
    across = Window.partitionBy("query_id").orderBy("_block")
    before = F.lag(F.element_at(types, -1)).over(across)
    at_head = _flag(_needless(before, F.element_at(types, 1))).cast("int")
    counted = blocks.withColumn("union_without_all", inside + at_head)
    return counted.groupBy("query_id").agg(*[F.sum(f).cast("bigint").alias(f) for f in flags])


def _needless(before: Column, after: Column) -> Column:
    return (after == fixed.UNION_OPERATOR) & (before == fixed.AGGREGATE_OPERATOR)


def _counts(query_history, operators, as_of, n, flag) -> DataFrame:
    """One row, one struct: flagged operators (not queries) of each window."""
    ids = _slowest_ids(query_history, as_of, n, list(WINDOWS))
    selected = _selected(operators, ids, as_of, list(WINDOWS), n * len(WINDOWS))
    per_query = _flags_per_query(selected, [flag]).join(ids, "query_id")
    per_window = [
        F.coalesce(F.sum(F.when(F.col("window") == name, F.col(flag))), F.lit(0)).alias(name)
        for name in WINDOWS
    ]
    return per_query.agg(*per_window).select(F.struct(*WINDOWS).alias("counts"))


def _query_ids(query_history, operators, as_of, n, flag) -> DataFrame:
    """Queries of the last seven days with a flagged operator."""
    ids = _slowest_ids(query_history, as_of, n, ["7_days"])
    selected = _selected(operators, ids, as_of, ["7_days"], n)
    per_query = _flags_per_query(selected, [flag])
    return per_query.where(F.col(flag) > 0).select("query_id")


def exploding_counts(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    """Operators that produce more rows than they read, per window."""
    return _counts(query_history, operators, as_of, top_n, "exploding_join")


def exploding_queries(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    return _query_ids(query_history, operators, as_of, top_n, "exploding_join")


def spill_counts(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    """Operators that spill to local or remote storage, per window."""
    return _counts(query_history, operators, as_of, top_n, "queries_too_large_memory")


def spill_queries(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    return _query_ids(query_history, operators, as_of, top_n, "queries_too_large_memory")


def pruning_counts(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    """Operators that scan most partitions of a large table, per window."""
    return _counts(query_history, operators, as_of, top_n, "inefficient_pruning")


def pruning_queries(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    return _query_ids(query_history, operators, as_of, top_n, "inefficient_pruning")


def union_distinct_counts(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    """Unions that remove duplicates, per window."""
    return _counts(query_history, operators, as_of, top_n, "union_without_all")


def union_distinct_queries(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str, top_n: int = 100
) -> DataFrame:
    return _query_ids(query_history, operators, as_of, top_n, "union_without_all")


def operator_metric_summary(
    query_history: DataFrame, operators: DataFrame, as_of: dt.date | str,
    windows: list[str] = tuple(WINDOWS), top_n: int = 100,
) -> DataFrame:
    """Counts of all four flags per query and window; queries without statistics drop out."""
    ids = _slowest_ids(query_history, as_of, top_n, list(windows))
    selected = _selected(operators, ids, as_of, list(windows), top_n * len(windows))
    flagged = _flags_per_query(selected, list(FLAGS))
    return (
        flagged.join(ids, "query_id")  # one row per slow query on both sides
        .select("query_id", "window", *FLAGS, F.lit(to_day(as_of)).alias("load_date"))
    )


def load_metric_summary(
    store: str, query_history: DataFrame, operators: DataFrame, as_of: dt.date | str,
    keep_days: int = 2, top_n: int = 100,
) -> DataFrame:
    """Daily load of the summary: once per day, older days expired first."""
    spark, day = query_history.sparkSession, to_day(as_of)
    loaded, oldest = partition_days(spark, store), day - dt.timedelta(days=keep_days)
    if not loaded or max(loaded) != day:
        drop_partitions(spark, store, [old for old in loaded if old < oldest])
        summary = operator_metric_summary(query_history, operators, day, top_n=top_n)
        overwrite_periods(summary, store, "load_date")
    return read_dated(spark, store)
