"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm.common import documents, whole_text

SAMPLES = 64
BLANKS = r"[\x20\x09-\x0D]+"
CHUNK = 4
REACH = 16.0
BLOCK_IDS = 512  # ids of one block of neighbouring documents
_PART = 2**21


def _uniform(bits: Column, at: int) -> Column:
    """A number in (0, 1) from 21 of the bits."""
    part = F.shiftrightunsigned(bits, at).bitwiseAND(F.lit(_PART - 1))
    return (part + F.lit(0.5)) * F.lit(1.0 / _PART)


def sample(term: Column, weight: Column, total: Column, k: Column) -> Column:
    """The k-th draw for a term of a weight (null: absent), as a number whose smallest
    over a document's terms is its sample.

    r and c are gamma(2, 1) and b is uniform, all from the term and k alone. With
    t = floor(ln w / r + b) the draw is ln c - r (t - b + 1), and the smallest draw with
    its t is the sample: two weighted sets draw the same with their generalised Jaccard
    similarity as probability. The upper bits hold the draw in order, the lower ones a
    tag of term and t.

    exp(draw) is at least c exp(-r) / w, and the smallest of a document of total weight
    W is exponential with rate W. Draws beyond ``REACH`` / W, which are the smallest with
    a chance of exp(-REACH), are told without a logarithm and left out.
    """
    one, two = F.xxhash64(term, k), F.xxhash64(k, term)
    r_product = _uniform(one, 0) * _uniform(one, 21)
    c_product = _uniform(one, 42) * _uniform(two, 0)
    r, ln_c, b = -F.ln(r_product), F.ln(-F.ln(c_product)), _uniform(two, 21)
    t = F.floor(F.ln(weight) / r + b)
    draw = F.least(F.greatest(ln_c - r * (t - b + 1), F.lit(-100.0)), F.lit(100.0))
    place = F.floor((draw + 100) * F.lit(2.0**24)).cast("long")
    tag = two.bitwiseXOR(t.cast("long") * F.lit(2654435761)).bitwiseAND(F.lit(2**30 - 1))
    near = (1 - c_product) * r_product * total <= weight * REACH
    return F.when(near, F.shiftleft(place, 30).bitwiseOR(tag))


def fingerprints(terms: DataFrame, keys: list[str], weights: dict[str, str], samples: int = SAMPLES):
    """One row per ``keys`` with an array of ``samples`` numbers for each weight column.

    ``terms`` has a row per key and ``term`` (a number) with weights above 0 or null;
    ``weights`` names for each weight column the column of its total over the key. A key
    without any weighted term has no row or an array of nulls. Samples are drawn in
    chunks, which keeps the generated code small enough to be compiled.
    """
    some = terms.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(samples // CHUNK - 1))))
    number = lambda i: (F.col("chunk") * CHUNK + i).cast("long")
    drawn = some.groupBy(*keys, "chunk").agg(
        *[
            F.min(sample(F.col("term"), F.col(w).cast("double"), F.col(total), number(i))).alias(f"{w}_{i}")
            for i in range(CHUNK)
            for w, total in weights.items()
        ]
    )
    parts = [F.array(*[F.col(f"{w}_{i}") for i in range(CHUNK)]).alias(w) for w in weights]
    gathered = drawn.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("chunk", *parts))).alias("parts")
    )
    return gathered.select(*keys, *[F.flatten(F.col(f"parts.{w}")).alias(w) for w in weights])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples: estimates the generalised Jaccard similarity. Two documents
    without terms are alike."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x)
    return F.size(same) / F.size(a)


def as_text(fingerprint: Column) -> Column:
    """The samples' tags as one string of 8 hexadecimal digits each."""
    tag = lambda x: F.lpad(F.hex(F.coalesce(x, F.lit(0)).bitwiseAND(F.lit(2**32 - 1))), 8, "0")
    return F.lower(F.array_join(F.transform(fingerprint, tag), ""))


def _following_blocks(blocks: DataFrame) -> DataFrame:
    """Rows (block, next_block): the next lower block that exists, the highest after the
    last. Blocks of blocks keep any one sort small."""
    group = F.coalesce(F.expr("block div 4096"), F.lit(-(2**62)))
    grouped = blocks.withColumn("group", group)
    inside = Window.partitionBy("group").orderBy(F.desc_nulls_last("block"))
    tops = grouped.groupBy("group").agg(F.max("block").alias("top"))
    across = Window.orderBy(F.desc("group"))
    tops = tops.select(
        "group",
        F.lead("top").over(across).alias("next_top"),
        F.first("top").over(across).alias("highest"),
        F.lead("group").over(across).isNull().alias("last_group"),
    )
    led = grouped.select(
        "group", "block", F.lead("block").over(inside).alias("next"),
        (F.row_number().over(inside) == F.count("*").over(Window.partitionBy("group"))).alias("end"),
    )
    return led.join(tops, "group").select(
        "block",
        F.when(~F.col("end"), F.col("next")).when(F.col("last_group"), F.col("highest"))
        .otherwise(F.col("next_top")).alias("next_block"),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    Terms are the lower-case words between blanks, weighted by how often they occur. The
    edited text has its last half (floor) of code points replaced by as many of the next
    document in descending id order (after the last: the first). Null texts count as
    empty; null ids come last and rows of one id are ordered by their text. One row per
    input row; a single document is its own next one; an empty table gives no rows.

    Texts are shuffled once, by blocks of neighbouring ids: the next document, word
    counts and samples are all found inside that partitioning, and only the first
    document of each block is passed on to the block before.
    """
    base = docs.select(
        F.coalesce(F.expr(f"cast(`{id_col}` as bigint) div {BLOCK_IDS}"), F.lit(-(2**53))).alias("block"),
        F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"),
    ).repartition("block")
    order = Window.partitionBy("block").orderBy(F.desc_nulls_last("id"), "text")
    numbered = base.select(
        "*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"),
        F.lead("block").over(order).isNull().alias("end"),
    )
    blocks = docs.select(
        F.coalesce(F.expr(f"cast(`{id_col}` as bigint) div {BLOCK_IDS}"), F.lit(-(2**53))).alias("block")
    ).distinct()
    following = _following_blocks(blocks)
    heads = numbered.filter("place = 1").select(F.col("block").alias("next_block"), F.col("text").alias("head_text"))
    passed = following.join(heads, "next_block").select("block", "head_text")
    half = F.floor(F.char_length("text") / 2).cast("int")
    after = F.when(F.col("end"), F.col("head_text")).otherwise(F.col("next_text"))
    texts = numbered.join(passed, "block", "left").select(
        "block", "place", "id", "text", "end",
        F.concat(
            F.substring("text", F.lit(1), F.char_length("text") - half),
            F.substring(after, F.lit(1), half),
        ).alias("edited"),
    )
    words = lambda text: F.split(F.lower(text), BLANKS)
    own, other = words(F.col("text")), words(F.col("edited"))
    null = F.lit(None).cast("int")
    both = F.array(
        F.struct(F.lit(1).alias("own"), null.alias("other"), F.col("own_words").alias("words")),
        F.struct(null.alias("own"), F.lit(1).alias("other"), F.col("other_words").alias("words")),
    )
    counted = (
        texts.select("block", "place", own.alias("own_words"), other.alias("other_words"))
        .select(
            "block", "place", F.size("own_words").alias("own_total"),
            F.size("other_words").alias("other_total"), F.inline(both),
        )
        .select("block", "place", "own_total", "other_total", "own", "other", F.explode("words").alias("word"))
        .filter("word <> ''")
        .groupBy("block", "place", "own_total", "other_total", F.xxhash64("word").alias("term"))
        .agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    )
    prints = fingerprints(counted, ["block", "place"], {"own": "own_total", "other": "other_total"})
    none = F.array_repeat(F.lit(None).cast("long"), SAMPLES)
    rows = texts.select(
        "block", "place", "id", "end",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    rows = rows.join(prints, ["block", "place"], "left").select(
        "block", "place", "id", "end", "n_chars", "edited_sha256",
        F.coalesce("own", none).alias("own"), F.coalesce("other", none).alias("other"),
    )
    in_block = Window.partitionBy("block").orderBy("place")
    head_words = (
        numbered.filter("place = 1").select("block", words(F.col("text")).alias("words"))
        .select("block", F.size("words").alias("total"), F.explode("words").alias("word"))
        .filter("word <> ''")
        .groupBy("block", "total", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("head"))
    )
    head_prints = (
        following.join(
            fingerprints(head_words, ["block"], {"head": "total"}).withColumnRenamed("block", "next_block"),
            "next_block", "left",
        ).select("block", F.coalesce("head", none).alias("head"))
    )
    return (
        rows.withColumn("following", F.lead("own").over(in_block))
        .join(head_prints, "block", "left")
        .select(
            F.col("id").alias(id_col), "n_chars", "edited_sha256",
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("other")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("other")).alias("near_edited"),
            likeness(F.col("own"), F.when(F.col("end"), F.col("head")).otherwise(F.col("following"))).alias("near_next"),
        )
    )


def fingerprints_query(spark, folder: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their edited texts."""
    return edited_fingerprints(documents(spark, folder))
