"""Shards of near-equal bytes from a k-d tree over document metadata."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlens.llm.common import documents, number_rows, stored, whole_text

CODE_BITS = 31  # of a dimension's code; a key adds 32 bits of the text's hash
DIGIT_BITS = (16, 16, 16, 15)  # of a 63-bit key, highest first


def category(value: Column) -> Column:
    """Code of a label: equal labels get equal codes; null is a label too."""
    return F.shiftrightunsigned(F.xxhash64(value), 64 - CODE_BITS)


def amount(value: Column) -> Column:
    """Code of a count: itself, up to the largest code; null counts as 0."""
    return F.least(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)), F.lit(2**CODE_BITS - 1)).cast("long")


def _node_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of a few driver rows as literals, so that no Python runs for it."""
    names = [field.split() for field in schema.split(", ")]
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, names, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _weighted_medians(units: DataFrame, goals: DataFrame) -> list:
    """For each node of ``goals`` (node, dim, goal, bounded by the leaves) the key at which
    its running weight first reaches the goal, and the weights before and with that key.

    Digit by digit: a pass sums weights by digit, so no node is ever sorted as a whole.
    """
    state = goals.select("node", "dim", "goal", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("below"))
    spark, low = units.sparkSession, sum(DIGIT_BITS)
    for bits in DIGIT_BITS:
        low -= bits
        key = F.element_at("keys", F.col("dim") + 1)
        sums = (
            units.join(F.broadcast(state), "node")
            .filter(F.shiftright(key, low + bits) == F.col("high"))
            .groupBy("node", "dim", "goal", "high", "below", F.shiftright(key, low).alias("digit"))
            .agg(F.sum("weight").alias("weight"))
        )
        running = Window.partitionBy("node").orderBy("digit")
        found = (
            sums.withColumn("upto", F.col("below") + F.sum("weight").over(running))
            .filter(F.col("upto") >= F.col("goal"))
            .groupBy("node", "dim", "goal")
            .agg(F.min(F.struct("digit", "upto", "weight")).alias("first"))
            .select(
                "node", "dim", "goal", F.col("first.digit").alias("high"),
                (F.col("first.upto") - F.col("first.weight")).alias("below"),
                F.col("first.upto").alias("upto"),
            )
        )
        rows = found.collect()  # one per node
        state = _node_table(
            spark,
            [(r.node, r.dim, r.goal, r.high, r.below) for r in rows],
            "node int, dim int, goal long, high long, below long",
        )
    return rows


def kd_shards(
    docs: DataFrame,
    target_bytes: int | None = None,
    leaves: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    labels: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    A document's size is its UTF-8 bytes (null: none) plus 1. Rows of equal text go to
    one shard. Dimensions are the label columns and the text's length; a text seen with
    several labels takes the smallest code. From one node with all texts, each level
    splits every node along its widest dimension (extent relative to the whole table's)
    at the weighted median, ties ordered by the text's hash, until the wanted number of
    leaves is reached: ``leaves``, or as many as make ``target_bytes`` each. A node with
    an odd number of leaves is split in that proportion. Shards differ by the size of the
    largest group of equal texts at most per level. ``slot`` counts a shard's rows from 0.
    Null ids and labels and repeated rows are ordinary; an empty table gives no rows.

    The driver holds one row per node, bounded by the number of leaves.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(whole_text(F.col(text_col)).cast("binary")).alias("crc"),
            F.unhex(F.sha2(whole_text(F.col(text_col)), 256)).alias("digest"),
            *[category(F.col(c)).alias(f"d{i}") for i, c in enumerate(labels)],
            amount(F.char_length(text_col)).alias(f"d{len(labels)}"),
        ),
        "shard-rows",
    )
    dims = [f"d{i}" for i in range(len(labels) + 1)]
    tie = F.shiftrightunsigned(F.xxhash64("digest"), 32)
    units = stored(
        rows.groupBy("digest")
        .agg(F.sum("size").alias("weight"), *[F.min(d).alias(d) for d in dims])
        .select(
            "digest", "weight", F.lit(0).alias("node"),
            F.array(*[F.shiftleft(d, 32).bitwiseOR(tie) for d in dims]).alias("keys"),
        ),
        "shard-units",
    )
    spark = docs.sparkSession
    total = units.agg(F.sum("weight")).first()[0] or 0
    if leaves is None:
        leaves = max(1, math.ceil(total / target_bytes))
    sizes, whole, placed = {0: leaves}, None, units
    while any(n > 1 for n in sizes.values()):
        codes = [F.shiftright(F.element_at("keys", i + 1), 32) for i in range(len(dims))]
        stats = (
            placed.groupBy("node")
            .agg(
                F.sum("weight").alias("weight"),
                *[F.min(c).alias(f"a{i}") for i, c in enumerate(codes)],
                *[F.max(c).alias(f"z{i}") for i, c in enumerate(codes)],
            )
            .collect()
        )
        extents = {
            r.node: [r[f"z{i}"] - r[f"a{i}"] for i in range(len(dims))] for r in stats
        }
        whole = whole or extents.get(0, [1] * len(dims))
        goals = []
        for r in stats:
            if (n := sizes[r.node]) > 1:
                wide = [e / max(w, 1) for e, w in zip(extents[r.node], whole, strict=True)]
                goals.append((r.node, wide.index(max(wide)), -(-r.weight * ((n + 1) // 2) // n)))
        if not goals:
            break
        found = _weighted_medians(
            placed, _node_table(spark, goals, "node int, dim int, goal long")
        )
        splits = []
        for r in found:
            nearer_below = r.goal - r.below < r.upto - r.goal
            splits.append((r.node, r.dim, r.high - 1 if nearer_below else r.high, r.node + (sizes[r.node] + 1) // 2))
        sizes = {
            node: part
            for node, n in sizes.items()
            for node, part in ([(node, n)] if n == 1 else [(node, (n + 1) // 2), (node + (n + 1) // 2, n // 2)])
        }
        cut = _node_table(spark, splits, "node int, dim int, last long, right int")
        goes_right = F.element_at("keys", F.col("dim") + 1) > F.col("last")
        placed = placed.join(F.broadcast(cut), "node", "left").select(
            "digest", "weight", "keys",
            F.when(goes_right, F.col("right")).otherwise(F.col("node")).alias("node"),
        )
    sharded = stored(
        rows.join(placed.select("digest", "node"), "digest").select(
            "id", "size", "crc", F.col("node").alias("shard")
        ),
        "shard-placed",
    )
    numbered = number_rows(sharded, ["shard"], ["id", "crc", "size"], "slot")
    return numbered.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    )


def kd_shards_query(spark, folder: str) -> DataFrame:
    """All ``documents`` in 8 shards of near-equal bytes."""
    return kd_shards(documents(spark, folder), leaves=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
