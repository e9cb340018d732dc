"""Digest of failed tasks and the alert condition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import moment, second_number
from meterlens.operators.ordering import BLOCK, with_row_number

PAGE_ROWS = 1000


def recent_failures(tasks: DataFrame, now: dt.datetime, hours: int = 1) -> DataFrame:
    """Tasks that failed in the last hours, both ends included."""
    start = now - dt.timedelta(hours=hours)
    started = F.col("query_start_time")
    return tasks.where(
        (started >= moment(start))
        & (started <= moment(now))
        & (F.col("state") == "FAILED")
    )


def _cells(tag: str, cells) -> list:
    parts = []
    for cell in cells:
        parts += [F.lit(f"<{tag}>"), cell, F.lit(f"</{tag}>")]
    return [F.lit("<tr>"), *parts, F.lit("</tr>")]


def failure_digest(
    tasks: DataFrame, now: dt.datetime, hours: int = 1, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """The digest as complete HTML bodies of at most ``page_rows`` failures each.

    A usual hour gives one page, which is the whole digest. A flood of failures becomes
    further pages, so none is left out and no task concatenates more than a page. A value
    that is null shows as an empty cell. Rows are ordered by start time; without failures
    there is one page saying so.
    """
    error = F.left("error_message", F.lit(fixed.DIGEST_ERROR_LENGTH))
    shown_time = F.date_format("query_start_time", "yyyy-MM-dd HH:mm:ss")
    shown = [F.col("name"), F.col("database_name"), F.col("schema_name"), error, shown_time]
    cells = [F.coalesce(cell, F.lit("")) for cell in shown]
    rows = (
        recent_failures(tasks, now, hours)
        .withColumn("html", F.concat(*_cells("td", cells)))
        .withColumn("_second", second_number("query_start_time"))
    )
    # Many scheduled tasks start at one instant: ids split even that into small slots.
    slots, order = ["_second", "query_start_time"], ["html"]
    if "event_id" in tasks.columns:
        rows = rows.withColumn("_ids", F.expr(f"coalesce(event_id div {BLOCK}, 0)"))
        slots, order = [*slots, "_ids"], ["event_id", "html"]
    numbered = with_row_number(rows, slots, order, "_n")
    page = (F.floor((F.col("_n") - 1) / page_rows) + 1).cast("bigint").alias("page")
    heading = "".join(f"<th>{title}</th>" for title in fixed.DIGEST_HEADINGS)
    opening = f"{fixed.DIGEST_INTRO}{fixed.DIGEST_TABLE}<tr>{heading}</tr>"
    pages = numbered.groupBy(page).agg(
        F.count(F.lit(1)).alias("failures"),
        F.expr("listagg(html, '') within group (order by _n)").alias("html"),
    ).withColumn("html", F.concat(F.lit(opening), "html", F.lit("</table>")))
    nothing = (
        rows.agg(F.count(F.lit(1)).alias("failures"))
        .where(F.col("failures") == 0)
        .select(F.lit(1).cast("bigint").alias("page"), "failures",
                F.lit(fixed.DIGEST_NONE).alias("html"))
    )
    return pages.unionByName(nothing).orderBy("page")


def has_failures(tasks: DataFrame, now: dt.datetime, hours: int = 1) -> DataFrame:
    """One row: did any task fail in the last hours? Stops at the first failure found."""
    found = recent_failures(tasks, now, hours).limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("has_failures"))
