"""Saved pages of a paged web service.

A page is one text: a bare JSON list of records or an object with a ``results`` list.
Pages form a table ``(endpoint, page_no, payload)``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlens.functions import fixed_values as fixed
from meterlens.sources.workdir import work_folder

PAGE_SCHEMA = "payload string, endpoint string, page_no bigint"
OBJECT = "map<string, variant>"


def read_saved_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages saved as text files below ``endpoint=.../page_no=.../``."""
    saved = spark.read.text(folder, wholetext=True).withColumnRenamed("value", "payload")
    return saved.select("endpoint", F.col("page_no").cast("bigint").alias("page_no"), "payload")


def _sized(pages: DataFrame) -> DataFrame:
    """Pages with their list of records as one text (``listed``) and its length.

    ``size`` is the number of records of the page, null where it cannot be read. An empty
    object, ``null`` and a ``results`` without a value are empty pages.
    """
    wrapped = F.get_json_object("payload", "$.results")
    bare = F.when(F.ltrim("payload").startswith("["), F.col("payload"))
    bodiless = F.col("payload").rlike(r"^\s*(\{\s*\}|null)\s*$") | (
        wrapped.isNull() & F.array_contains(F.json_object_keys("payload"), "results")
    )
    listed = F.coalesce(wrapped, bare, F.when(bodiless, F.lit("[]")))
    return pages.select("endpoint", "page_no", listed.alias("listed")).select(
        "endpoint", "page_no", F.json_array_length("listed").alias("size"), "listed"
    )


def _entries(sized: DataFrame) -> DataFrame:
    """One row per record of every page, and one for a page without any.

    The size stands in the page's row before the list is taken apart: worked out beside the
    records it would read the whole page once for each of them. ``record`` is the record as
    a variant if it is an object; anything else stands in ``other`` as text.
    """
    # Parsed before the list is taken apart, so that no later column parses once more.
    entries = F.transform(
        F.from_json("listed", "array<string>"),
        lambda text: F.struct(text.alias("text"), F.try_parse_json(text).alias("parsed")),
    )
    parsed = sized.select(
        "endpoint", "page_no", "size", F.posexplode_outer(entries).alias("position", "_entry")
    ).select("endpoint", "page_no", "size", "position", "_entry.*")
    is_object = F.try_variant_get("parsed", "$", OBJECT).isNotNull()
    # A null in the list has no text, but it has a position.
    other = F.when(F.col("position").isNotNull() & ~is_object, F.coalesce("text", F.lit("null")))
    return parsed.select(
        "endpoint", "page_no", "size", "position",
        F.when(is_object, F.col("parsed")).alias("record"), other.alias("other"),
    )


def _served(paged: DataFrame, page_size: int) -> DataFrame:
    """Pages or entries up to and including each endpoint's first short page.

    An empty page is a short page. A missing or unreadable one ends nothing: saved pages
    behind it are kept. The last page numbers are broadcast, one short row per endpoint: by
    a shuffle, all pages of an endpoint would meet in one task.
    """
    last = paged.where(F.col("size") < page_size).groupBy("endpoint").agg(
        F.min("page_no").alias("_last")
    )
    joined = paged.alias("e").join(
        F.broadcast(last.alias("l")), F.col("e.endpoint").eqNullSafe(F.col("l.endpoint")), "left"
    )
    kept = joined.where(F.col("_last").isNull() | (F.col("page_no") <= F.col("_last")))
    return kept.select("e.*")


def page_entries(pages: DataFrame, page_size: int) -> DataFrame:
    """The entries of the served pages; pages that are not served are not parsed."""
    return _entries(_served(_sized(pages), page_size))


def page_records(pages: DataFrame, page_size: int = fixed.PAGE_SIZE) -> DataFrame:
    """One JSON text per record of the served pages, also of records that are no objects."""
    text = F.coalesce(F.to_json("record"), "other").alias("record")
    served = page_entries(pages, page_size).where(F.col("position").isNotNull())
    return served.select("endpoint", "page_no", text)


def left_out(pages: DataFrame, page_size: int = fixed.PAGE_SIZE) -> DataFrame:
    """What an export of the pages cannot take: unreadable pages and records that are no
    objects, one row each (endpoint, page_no, position, reason, text)."""
    served = page_entries(pages, page_size)
    unreadable = F.col("size").isNull()
    return served.where(unreadable | F.col("other").isNotNull()).select(
        "endpoint", "page_no", "position",
        F.when(unreadable, "unreadable page").otherwise("no readable object").alias("reason"),
        F.col("other").alias("text"),
    )


# A quoted name, or a word where a type stands: names never follow ": " or "ARRAY<".
_TYPE_WORDS = re.compile(r"`(?:[^`]|``)*`|(?:(?<=: )|(?<=ARRAY<))(OBJECT(?=<)|VARIANT|VOID)(?=[<>,])")
_SPARK_TYPES = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}


def _as_struct(merged: str | None) -> T.StructType | None:
    """The merged schema of objects as Spark names it; None for no object."""
    if merged is None or not merged.startswith("OBJECT<"):
        return None
    ddl = _TYPE_WORDS.sub(lambda m: _SPARK_TYPES.get(m[1], m[0]), merged)
    return T.StructType.fromDDL(ddl[len("OBJECT<"):-1])


def _merged_schema() -> Column:
    """Merged in the executors; as wide as the export will be."""
    return F.schema_of_variant_agg("record")


def _flattened(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Nested objects as dotted columns, lists as JSON text.

    Objects become maps under numbered names, level by level: their keys are looked up as
    they are, whatever their case, dots or quotes. Where two paths have one dotted name the
    more deeply nested value counts, and the other where it is null.
    """
    columns: dict[str, list[tuple[int, Column]]] = {}
    objects, number = [("_o0", schema, ())], 1
    found = records.select(F.try_variant_get("record", "$", OBJECT).alias("_o0"))
    while objects:
        inner = {}
        for name, kind, path in objects:
            for field in kind.fields:
                value, there = F.col(name)[field.name], (*path, field.name)
                if isinstance(field.dataType, T.StructType) and field.dataType.fields:
                    inner[f"_o{number}"] = (F.try_variant_get(value, "$", OBJECT), field.dataType, there)
                    number += 1
                    continue
                nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
                kept = "string" if nested else field.dataType.simpleString()
                leaf = F.try_variant_get(value, "$", kept)
                columns.setdefault(".".join(there), []).append((-len(there), leaf))
        found = found.withColumns({name: column for name, (column, _, _) in inner.items()})
        objects = [(name, kind, path) for name, (_, kind, path) in inner.items()]
    return found.select(
        *[
            F.coalesce(*[leaf for _, leaf in sorted(leaves, key=lambda found: found[0])]).alias(name)
            for name, leaves in columns.items()
        ]
    )


def flatten_pages(
    pages: DataFrame, endpoint: str, page_size: int = fixed.PAGE_SIZE
) -> DataFrame | None:
    """All records of an endpoint with nested objects as dotted columns.

    None if no record is an object; ``left_out`` lists what is not part of the result. The
    columns come from the merged schema, so objects keyed by ids make a wide result.
    """
    records = page_entries(pages.where(F.col("endpoint") == endpoint), page_size)
    records = records.where(F.col("record").isNotNull()).select("record")
    schema = _as_struct(records.agg(_merged_schema()).first()[0])
    return None if schema is None else _flattened(records, schema)


def endpoint_file(endpoint: str) -> str:
    return endpoint.strip("/").replace("/", "_") + ".csv"


def write_endpoint_csv(df: DataFrame | None, endpoint: str, folder: str) -> str | None:
    """Write one CSV data set per endpoint with a header; nothing for an empty one."""
    if df is None or df.isEmpty():
        return None
    path = f"{folder.rstrip('/')}/{endpoint_file(endpoint)}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


EXPORT_SUMMARY = (
    "endpoint string, pages bigint, records bigint, skipped bigint, unreadable bigint, file string"
)


def export_endpoints(
    pages: DataFrame, folder: str, page_size: int = fixed.PAGE_SIZE
) -> DataFrame:
    """Write every endpoint's records as CSV and say what was written.

    Payloads are read and parsed once: the records of the served pages are kept as variants
    in a work table partitioned by endpoint. One aggregate finds all schemas and counts, and each endpoint
    is flattened from its own partition. The summary has a row per endpoint: pages read,
    records written, records skipped because they are no objects, unreadable pages, and
    the data set's name (null if nothing was written). Endpoints whose names lead to the
    same file get numbered ones. Column names may differ in case only.
    """
    spark = pages.sparkSession.newSession()
    spark.conf.set("spark.sql.caseSensitive", "true")
    staged = work_folder(pages.sparkSession, "endpoint-records")
    page_entries(pages, page_size).write.partitionBy("endpoint").parquet(staged)
    served = spark.read.schema(
        "page_no bigint, size int, position int, record variant, other string, endpoint string"
    ).parquet(staged)
    first = F.coalesce("position", F.lit(0)) == 0  # one of each page
    found = (
        served.groupBy("endpoint")
        .agg(
            _merged_schema().alias("schema"),
            F.count_if(first & F.col("size").isNotNull()).alias("pages"),
            F.count("record").alias("records"),
            F.count("other").alias("skipped"),
            F.count_if(F.col("size").isNull()).alias("unreadable"),
        )
        .orderBy("endpoint")
        .collect()
    )
    summary, taken = [], set()
    for row in found:
        name, schema = None, _as_struct(row.schema)
        if schema is not None:
            own = F.col("endpoint").eqNullSafe(F.lit(row.endpoint))
            name = plain = endpoint_file(row.endpoint or "")
            while name in taken:
                name = f"{plain.removesuffix('.csv')}-{len(taken)}.csv"
            taken.add(name)
            records = served.where(own).where(F.col("record").isNotNull())
            flat = _flattened(records, schema)
            flat.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}")
        summary.append((row.endpoint, row.pages, row.records, row.skipped, row.unreadable, name))
    return pages.sparkSession.createDataFrame(summary, EXPORT_SUMMARY)
