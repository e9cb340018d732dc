"""Toxicity scores from boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches, stored

# Insults that hold in any corpus, and words of the second person.
INSULTS = (
    "idiot idiots moron morons stupid dumb loser losers trash scum pathetic worthless clown "
    "disgusting garbage fool jerk imbecile vermin filth"
).split()
YOU = (
    "you your yours yourself u ur du dich dir dein deine euch tu te toi ton tes vous votre vos "
    "usted ustedes vosotros tus"
).split()

TRAIN_ROWS = 40_000  # bound of the labelled sample that is learned from
LEXICON = 200  # bound of the words learned as a lexicon
LEXICON_DOCS, LEXICON_SHARE = 4, 0.6  # a learned word's documents, and share of toxic ones
THRESHOLD = 0.7
SPREAD = str.maketrans("013457@$!|", "oieastasil")  # letters that such characters stand for
WORD = re.compile(r"[^\W\d_]+")
CHUNK = re.compile(r"\S+")
FEATURES = 16


def least_distance(left: list[int], right: list[int], default: int) -> int:
    """The least distance of two places in sorted lists, by one merge; ``default`` if a
    list is empty."""
    least, i, j = default, 0, 0
    while i < len(left) and j < len(right):
        gap = left[i] - right[j]
        if abs(gap) < least:
            least = abs(gap)
        if gap < 0:
            i += 1
        else:
            j += 1
    return least


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """Dense features of a text: lexicon densities (plain, weighted, distinct, disguised),
    nearness to the second person, capitals, punctuation and length."""
    lower = text.lower()
    words = WORD.findall(lower)
    n, size = max(len(words), 1), max(len(text), 1)
    hits = [i for i, w in enumerate(words) if w in lexicon]
    near = [i for i, w in enumerate(words) if w in _YOU] if hits else []
    distance = least_distance(hits, near, n)
    disguised = 0
    if any(c in lower for c in "013457@$!|*._-"):
        for chunk in CHUNK.findall(lower):
            if not chunk.isalpha():
                plain = WORD.findall(chunk)
                joined = "".join(WORD.findall(chunk.translate(SPREAD)))
                bare = "".join(plain)
                if (joined in lexicon or bare in lexicon) and not any(p in lexicon for p in plain):
                    disguised += 1
    known = [lexicon[words[i]] for i in hits]
    upper = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    marks = len(lower) - sum(map(len, words)) - lower.count(" ") - lower.count("\n")
    return [
        float(len(hits)), len(hits) / n, sum(known), sum(known) / n, max(known, default=0.0),
        float(len({words[i] for i in hits})), float(disguised), disguised / n,
        1 / (1 + distance), len(near) / n, upper / size, shouted / n,
        marks / size, text.count("!") / n, text.count("?") / n, math.log1p(len(words)),
    ]


_YOU = frozenset(YOU)


def learned_lexicon(train: DataFrame, text_col: str, most: int = LEXICON) -> dict[str, float]:
    """Words with the log odds of toxic documents among those that hold them: at most
    ``most``, those in the most toxic documents first."""
    # Both classes' documents per word combine in the map tasks; a bounded list comes back.
    words = train.select(
        "toxic", F.explode(F.array_distinct(F.split(F.lower(F.coalesce(text_col, F.lit(""))), r"[^\p{L}]+"))).alias("word")
    )
    rows = (
        words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
        .filter((F.length("word") > 2) & (F.col("n") >= LEXICON_DOCS) & (F.col("bad") >= LEXICON_SHARE * F.col("n")))
        .orderBy(F.desc("bad"), "word").limit(most).collect()
    )
    lexicon = dict.fromkeys(INSULTS, 1.0)
    return lexicon | {r.word: math.log((r.bad + 1) / (r.n - r.bad + 1)) + 1 for r in rows}


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    key_col: str | None = None, lexicon_words: int = LEXICON,
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score`` in [0, 1], ``predicted``.

    ``labels`` has the id and ``toxic`` (0 or 1; null is no label). Ids whose crc32, as
    text, leaves the remainder 1 modulo 3 are held out: their labels are never used. Of
    the others a hashed sample of about ``TRAIN_ROWS`` is learned from, so the sample's
    ids are small enough to broadcast and texts are never shuffled: a lexicon (the insults
    given and at most ``lexicon_words`` learned words) and boosted trees from four fifths,
    the isotonic calibration from the fifth that neither has seen. Without training rows of
    both classes every score is the share of toxic ones (0 without labels). Null texts
    count as empty; null ids are scored and not held out; repeated rows get a row each.
    ``key_col`` names a column that is handed on as the last one.
    """
    handed = [F.col(key_col).alias("key")] if key_col else []
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *handed)
    handed = ["key"] if key_col else []
    rest = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 3, F.lit(0))
    usable = (
        labels.select(F.col(id_col).alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("label_id is not null and toxic is not null").filter(rest("label_id") != 1)
        .groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, TRAIN_ROWS / max(usable.count(), 1))
    draw = F.pmod(F.xxhash64("label_id", F.lit("train")), F.lit(2**20))
    chosen = stored(usable.filter(draw < math.ceil(share * 2**20)), "toxic-labels")
    train = docs.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5))
    lexicon = learned_lexicon(train.filter(fold != 0), "text", lexicon_words)

    def run(batches):
        for batch in batches:
            rows = [features(t or "", lexicon) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(rows, pa.list_(pa.float64()))],
                names=["id", *handed, "features"],
            )

    kinds = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in ["id", *handed])
    dense = stored(map_batches(docs, run, f"{kinds}features array<double>"), "toxic-features")
    known = dense.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select(
        "id", "toxic", array_to_vector("features").alias("features")
    )
    grown = known.filter(fold != 0)
    classes = {r.toxic: r["count"] for r in grown.groupBy("toxic").count().collect()}
    held_out = (rest("id") == 1).alias("held_out")
    if len(classes) < 2:
        score = float(max(classes, default=0))
        scored = dense.select("id", *handed, F.lit(score).alias("score"))
    else:
        weighted = grown.withColumn("label", F.col("toxic").cast("double"))
        trees = GBTClassifier(
            featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2,
            minInstancesPerNode=5, seed=7, cacheNodeIds=False,
        ).fit(weighted)
        margin = vector_to_array("rawPrediction")[1]
        checked = known.filter(fold == 0)
        if checked.select("toxic").distinct().count() < 2:
            checked = known
        isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
            trees.transform(checked).select(margin.alias("margin"), F.col("toxic").cast("double").alias("label"))
        )
        raw = trees.transform(dense.select("id", *handed, array_to_vector("features").alias("features")))
        scored = isotonic.transform(raw.select("id", *handed, margin.alias("margin")))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select(
        F.col("id").alias(id_col), held_out, score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
        *[F.col(c).alias(key_col) for c in handed],
    )


def toxicity_query(spark, folder: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from ``labels``."""
    return toxicity_scores(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
