"""Unused tables, retention, column comments, tags, masking and cost by tag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed
from meterlens.functions.dates import last_days, moment, to_day
from meterlens.operators.arrays import explode_once
from meterlens.operators.joins import spread_by
from meterlens.plans.query_log import credits_per_query

TABLE_KEY = ["table_catalog", "table_schema", "table_name"]
OBJECT_KEY = ["object_database", "object_schema", "object_name"]
COLUMN_KEY = ["database_name", "schema_name", "table_name", "column_name"]


def accessed_objects(access: DataFrame, *columns: str) -> DataFrame:
    """One row per accessed object: catalog, schema and name with the kept columns."""
    objects = F.from_json("base_objects_accessed", "array<struct<objectName: string>>")
    exploded = explode_once(access, list(columns), objects, "_object")
    parts = F.split("_object.objectName", r"\.")
    return exploded.select(
        *columns, *[F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(TABLE_KEY)]
    )


def unused_tables(
    tables: DataFrame, access: DataFrame, as_of: dt.date | str, days: int = 180
) -> DataFrame:
    """Live base tables neither altered nor read by anyone within the given days.

    Accesses are reduced to distinct names in each task before the shuffle; only their
    absence matters, so no access row needs ranking.
    """
    day = to_day(as_of)
    cutoff = day - dt.timedelta(days=days)
    candidates = tables.where(
        F.col("deleted").isNull()
        & (F.col("table_type") == "BASE TABLE")
        & (F.col("last_altered") < F.lit(cutoff))
    )
    recent = access.where(last_days("query_start_time", day, days - 1))
    used = accessed_objects(recent).distinct()
    return (
        candidates.join(used, TABLE_KEY, "left_anti")
        .select(
            *TABLE_KEY, "row_count", (F.col("bytes") / 1000 / 1000).alias("size_in_mb"),
            "last_altered", "table_owner",
        )
        .orderBy(F.desc_nulls_last("size_in_mb"), *TABLE_KEY)
    )


def retention_inventory(
    tables: DataFrame, min_days: int | None = 3, exclude_like: str | None = None
) -> DataFrame:
    """Live tables kept longer than ``min_days`` (None: all), flagged for a change."""
    listed = tables.where(F.col("deleted").isNull())
    if exclude_like is not None:
        listed = listed.where(~F.col("table_catalog").like(exclude_like))
    if min_days is not None:
        listed = listed.where(F.col("retention_time") > min_days)
    return listed.select(
        *TABLE_KEY,
        F.col("bytes").alias("storage_bytes"),
        "row_count",
        F.col("table_owner").alias("owner"),
        F.coalesce("retention_time", F.lit(0)).alias("current_time_travel_duration"),
        F.lit("Y").alias("change_tt"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated"),
        F.lit("").alias("comments"),
    )


def apply_retention_outcome(
    inventory: DataFrame, outcomes: DataFrame, as_of: dt.datetime
) -> DataFrame:
    """Inventory after the attempts: ``outcomes`` has the table key and ``succeeded``.

    Of several attempts on a table the latest by ``attempted_at`` counts; without that
    column, a success among them. Only flagged rows change. A success clears the flag and sets the new duration, a
    failure leaves both; both note a comment and the time.
    """
    latest = F.max("succeeded")
    if "attempted_at" in outcomes.columns:
        latest = F.max_by("succeeded", "attempted_at")
    attempted = outcomes.groupBy(*TABLE_KEY).agg(latest.alias("_succeeded"))
    joined = inventory.join(attempted, TABLE_KEY, "left")
    tried = (F.col("change_tt") == "Y") & F.col("_succeeded").isNotNull()
    changed = tried & F.col("_succeeded")
    note = F.when(F.col("_succeeded"), fixed.RETENTION_CHANGED).otherwise(fixed.RETENTION_FAILED)
    return joined.select(
        *TABLE_KEY, "storage_bytes", "row_count", "owner",
        F.when(changed, F.lit(fixed.RETENTION_TARGET_DAYS))
        .otherwise(F.col("current_time_travel_duration"))
        .alias("current_time_travel_duration"),
        F.when(changed, F.lit("N")).otherwise(F.col("change_tt")).alias("change_tt"),
        F.when(tried, moment(as_of))
        .otherwise(F.col("last_updated"))
        .alias("last_updated"),
        F.when(tried, note).otherwise(F.col("comments")).alias("comments"),
    )


def retention_audit(inventory: DataFrame, outcomes: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One audit row per attempt, with the duration before it."""
    attempts = inventory.where(F.col("change_tt") == "Y").join(
        outcomes.select(*TABLE_KEY, "succeeded"), TABLE_KEY
    )
    note = F.when(F.col("succeeded"), fixed.RETENTION_CHANGED_AUDIT).otherwise(
        fixed.RETENTION_FAILED
    )
    return attempts.select(
        *TABLE_KEY, "row_count", "owner",
        F.col("current_time_travel_duration").alias("time_travel_duration"),
        moment(as_of).alias("last_updated"),
        note.alias("comments"),
    )


def comment_plan(
    catalog: DataFrame, columns: DataFrame, db: str | None = None, schema: str | None = None,
    table: str | None = None,
) -> DataFrame:
    """Comment statements for known columns (``apply``) and rows without one (``failed``).

    A schema counts only with a database and a table only with a schema.
    """
    wanted = catalog
    for column, value in zip(COLUMN_KEY, (db, schema, table)):
        if value is None:
            break
        wanted = wanted.where(F.col(column) == value)
    known = columns.select(*COLUMN_KEY).distinct().withColumn("_known", F.lit(True))
    quoted = F.replace(F.col("comments"), F.lit("'"), F.lit("''"))
    statement = F.format_string(fixed.COMMENT_STATEMENT, *COLUMN_KEY, quoted)
    return wanted.join(known, COLUMN_KEY, "left").select(
        *COLUMN_KEY,
        F.when(F.col("_known"), "apply").otherwise("failed").alias("status"),
        F.when(F.col("_known"), statement).alias("statement"),
    )


def tagged_objects(
    tag_references: DataFrame, db: str, schema: str, name: str, value: str
) -> DataFrame:
    """Objects carrying a tag value."""
    return tag_references.where(
        (F.col("tag_database") == db) & (F.col("tag_schema") == schema)
        & (F.col("tag_name") == name) & (F.col("tag_value") == value)
    ).select("domain", "object_name")


def mask_by_tag(
    df: DataFrame, column_tags: DataFrame, tag: str = fixed.MASKED_TAG,
    value: str = fixed.MASKED_TAG_VALUE, table: str | None = None,
) -> DataFrame:
    """Replace the values of columns whose tag has the masked class.

    Names are compared without regard to case, as both catalogs do. With ``table``, only
    tags whose ``object_name`` is that table count. Only names of this table's columns are
    fetched, so the fetch is bounded by its width.
    """
    tagged = column_tags.where(
        (F.upper("tag_name") == tag.upper()) & (F.col("tag_value") == value)
        & F.upper("column_name").isin([c.upper() for c in df.columns])
    )
    if table is not None:
        tagged = tagged.where(F.upper("object_name") == table.upper())
    upper = tagged.select(F.upper("column_name").alias("name")).distinct()
    names = {row.name for row in upper.collect()}
    return df.select(
        *[
            F.lit(fixed.MASK).alias(c) if c.upper() in names else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def _cost_per_object(
    access: DataFrame, query_history: DataFrame, attribution: DataFrame,
    as_of: dt.date | str | None, days: int,
) -> DataFrame:
    """Credits and uses per table, warehouse and user: each query's credits split evenly over
    the distinct tables it reads.

    The tables of a query are counted and joined in partitions of a bounded number of
    queries, so a task's memory does not grow with the logs.
    """
    if as_of is not None:
        access = access.where(last_days("query_start_time", as_of, days))
        query_history = query_history.where(last_days("start_time", as_of, days))
        attribution = attribution.where(last_days("start_time", as_of, days))
    objects = accessed_objects(access, "query_id")
    objects = objects.where(F.col("query_id").isNotNull() & F.col("table_name").isNotNull())
    objects = spread_by(objects.distinct(), "query_id", query_history.count())
    of_query = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    share = F.round(F.col("credits").cast("double") / F.col("_objects"), 8)
    queries = query_history.select("query_id", "warehouse_name", "user_name").join(
        credits_per_query(attribution), "query_id"
    )
    keys = ["warehouse_name", "user_name"]
    per_object = (
        objects.withColumn("_objects", of_query)
        .join(queries, "query_id")
        .withColumn("_share", share.cast("decimal(28,8)"))
        .groupBy(*[F.col(c).alias(name) for c, name in zip(TABLE_KEY, OBJECT_KEY)], *keys)
        .agg(F.sum("_share").alias("_share"), F.count(F.lit(1)).alias("_uses"))
    )
    return per_object


def cost_by_tag(
    access: DataFrame, query_history: DataFrame, attribution: DataFrame,
    tag_references: DataFrame, tag: str = "DEPARTMENT", as_of: dt.date | str | None = None,
    days: int = 30,
) -> DataFrame:
    """Credits and uses per tag value, object, warehouse and user.

    Tags belong to an object by database, schema and name. With ``as_of`` only the last
    ``days`` of all three logs count. A query's credits are split evenly over the distinct
    tables it reads (objects with a three-part name). The shares are summed per table,
    warehouse and user before the tags are joined, so a table that much of the log reads
    meets the tag list as a few rows.
    """
    per_object = _cost_per_object(access, query_history, attribution, as_of, days)
    keys = ["warehouse_name", "user_name"]
    tags = tag_references.where(
        (F.col("tag_name") == tag) & (F.col("domain") == "TABLE")
    ).select(*OBJECT_KEY, "tag_value")
    return (
        per_object.join(tags, OBJECT_KEY)
        .groupBy("tag_value", *OBJECT_KEY, *keys)
        .agg(F.sum("_share").alias("credits"), F.sum("_uses").alias("object_uses"))
    )


def cost_by_inherited_tag(
    access: DataFrame, query_history: DataFrame, attribution: DataFrame,
    tag_references: DataFrame, tag: str = "DEPARTMENT", as_of: dt.date | str | None = None,
    days: int = 30,
) -> DataFrame:
    """Credits and uses per tag value, with tags that containers pass on.

    A table takes the value of its nearest tagged container: itself, its schema, its
    database, the account (``tag_level``; null for none, so costs add up to those of all
    tables). Warehouses carry the tag apart, as ``warehouse_tag``. Of several values of one
    object the least counts. Costs are summed per table, warehouse and user before one left
    join per level, none of them a forced broadcast.
    """
    per_object = _cost_per_object(access, query_history, attribution, as_of, days)
    tags = tag_references.where(F.col("tag_name") == tag)

    def values(domain: str, columns: dict[str, str], name: str) -> DataFrame:
        of_domain = tags.where(F.col("domain") == domain)
        return of_domain.groupBy(*[F.col(c).alias(as_) for c, as_ in columns.items()]).agg(
            F.min("tag_value").alias(name)
        )

    database, schema = "object_database", "object_schema"
    levels = [
        ("TABLE", {c: c for c in OBJECT_KEY}),
        ("SCHEMA", {database: database, "object_name": schema}),
        ("DATABASE", {"object_name": database}),
    ]
    found = per_object
    for domain, columns in levels:
        found = found.join(values(domain, columns, f"_{domain}"), list(columns.values()), "left")
    found = found.join(
        values("WAREHOUSE", {"object_name": "warehouse_name"}, "warehouse_tag"),
        "warehouse_name", "left",
    )
    account = tags.where(F.col("domain") == "ACCOUNT").agg(F.min("tag_value")).scalar()
    found = found.withColumn("_ACCOUNT", account)
    names = [domain for domain, _ in levels] + ["ACCOUNT"]
    level = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), F.lit(n.lower())) for n in names])
    return (
        found.groupBy(
            F.coalesce(*[F.col(f"_{n}") for n in names]).alias("tag_value"),
            level.alias("tag_level"), "warehouse_tag", "user_name",
        )
        .agg(F.sum("_share").alias("credits"), F.sum("_uses").alias("object_uses"))
    )
