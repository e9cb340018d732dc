"""Five stages from raw documents to packed token sequences, each on one text operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlens.llm.common import documents, stored
from meterlens.llm.exact_dedup import exact_dedup
from meterlens.llm.ngram_join import ngram_components
from meterlens.llm.packing import pack_documents
from meterlens.llm.secrets import without_secrets
from meterlens.llm.toxicity import toxicity_scores


KEY = "_row_key"


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of id and text. A stage decides alike on rows that repeat
    both, and on each other row alone. Keys sort by id, rows without one last."""
    digest = F.unhex(F.sha2("text", 256))
    return docs.withColumn(
        KEY, F.struct(F.isnull("doc_id").alias("n"), F.col("doc_id").alias("id"), digest.alias("text"))
    )


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose key is in ``kept``, with their own columns."""
    kept = kept.select(F.col(f"{KEY}.id").alias("kept_id"), F.col(f"{KEY}.text").alias("kept_text")).distinct()
    digest = "_digest"
    while digest in {c.lower() for c in docs.columns}:
        digest = f"_{digest}"
    keyed = docs.withColumn(digest, F.unhex(F.sha2("text", 256)))
    same = keyed["doc_id"].eqNullSafe(kept["kept_id"]) & keyed[digest].eqNullSafe(kept["kept_text"])
    return keyed.join(kept, same, "left_semi").drop(digest)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity_scores(_keyed(docs), labels, key_col=KEY)
    return _only(docs, scores.filter("predicted = 0"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts. Rows that repeat id and text are one."""
    return _only(docs, exact_dedup(_keyed(docs), KEY).filter("kept")).dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-equal texts. Rows that
    repeat id and text, which the stage before makes one, stay or go together."""
    return _only(docs, ngram_components(_keyed(docs), KEY).filter(F.col("component_id") == F.col(KEY)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their text replaced and ``n_chars`` set anew."""
    return without_secrets(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Trained scores and a tokenizer have no SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
