"""Exact deduplication by sorting content."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import documents, stored, whole_text

# The characters that equality ignores.
BLANKS = r"[\x20\x09-\x0D]+"
# A text's copies are dealt over this many sorted runs.
SALTS = 1024
# Leading characters that order texts before their hash does; bounds what the sampling of
# splitters sends to the driver.
PREFIX = 16


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical without blanks; null counts as empty. The row
    with the most code points stays, then the smallest id (null ids last); of repeated
    rows one stays. Other columns are not read. An empty table gives no rows.

    Content sort: sampled splitters range-partition the normalised texts by leading
    characters, hash and salt. Sorting inside the ranges places equal texts side by
    side, the row that stays first, and each is compared in full with its neighbours: a
    run of equal texts begins and ends where they differ. The salt, of the id and the
    input partition, cuts a text with very many copies into at most ``SALTS`` runs. One
    row of each run, with its size and first row, meets those of the same digest; a
    group's size and the row that stays go back to the rows by their run.
    """
    source = docs.select(
        F.col(id_col).alias("id"),
        F.regexp_replace(whole_text(F.col(text_col)), BLANKS, "").alias("norm"),
        F.char_length(whole_text(F.col(text_col))).cast("long").alias("length"),
    )
    keyed = source.select(
        "*",
        F.substring("norm", 1, PREFIX).alias("prefix"),
        F.xxhash64("norm").alias("hash"),
        F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(SALTS)).alias("salt"),
    )
    place = ["prefix", "hash", "salt"]
    in_order = Window.partitionBy(*place).orderBy(
        "norm", F.desc("length"), F.asc_nulls_last("id")
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before, after = F.lag("norm").over(in_order), F.lead("norm").over(in_order)
    first = F.when(F.col("head"), F.struct("row", "number", "length", "id"))
    compared = (
        keyed.repartitionByRange(*place)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("head", before.isNull() | (before != F.col("norm")))
        .withColumn("tail", after.isNull() | (after != F.col("norm")))
        .withColumn("number", F.row_number().over(in_order))
        .withColumn("first", F.last(first, ignorenulls=True).over(so_far))
        .select(
            "id", "row", F.col("first.row").alias("run"),
            F.when(
                F.col("tail"),
                F.struct(
                    (F.col("number") - F.col("first.number") + 1).alias("size"),
                    F.unhex(F.sha2("norm", 256)).alias("digest"),
                    F.struct(
                        (-F.col("first.length")).alias("l"), F.isnull("first.id").alias("n"),
                        F.col("first.id").alias("id"), F.col("first.row").alias("row"),
                    ).alias("best"),
                ),
            ).alias("whole"),
        )
    )
    rows = stored(compared, "exact-rows")
    runs = rows.filter("whole is not null").select("run", "whole.*")
    groups = runs.groupBy("digest").agg(
        F.sum("size").alias("group_size"), F.min("best").alias("best")
    )
    merged = runs.select("run", "digest").join(groups, "digest")
    return rows.select("id", "row", "run").join(merged, "run").select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup_query(spark, folder: str) -> DataFrame:
    """Exact copies among all ``documents``."""
    return exact_dedup(documents(spark, folder))


EXACT_DEDUP_SQL = r"""
with texts as (
  select doc_id, length(coalesce(text, '')) as n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as digest
  from documents)
select doc_id,
  first_value(doc_id) over (partition by digest order by n desc, doc_id) as keep_id,
  count(*) over (partition by digest) as group_size,
  row_number() over (partition by digest order by n desc, doc_id) = 1 as kept,
  digest as text_sha256
from texts
"""
