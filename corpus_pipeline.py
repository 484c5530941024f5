"""Corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residualkit.llm.catalog import MIX_EPOCHS, MIX_PERCENT, MIX_SEED, MIX_WEIGHTS
from residualkit.llm.frames import table
from residualkit.llm.minhash import without_near_duplicates
from residualkit.llm.mixing import mix
from residualkit.llm.packing import pack
from residualkit.llm.pii import redact
from residualkit.llm.toxicity import without_toxic
from residualkit.staging import delete_staged, staged_folder, staging_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier rejects by their text go, all others stay, also those without an id or a text."""
    return without_toxic(docs.select(COLUMNS), table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id. Documents without an id stay."""
    return without_near_duplicates(docs.select(COLUMNS), k=5, percent=80)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts becomes a placeholder; ``n_chars`` is that of the new text, NULL for a NULL text."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, one row for each time one is taken, whole. NULL languages and sources become empty texts."""
    taken = mix(docs, MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED, keep=COLUMNS)
    return taken.select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in the training sequences; a NULL or empty text is one piece."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next.

    What a stage staged for itself is deleted when its result is written, and so is the result
    before the last one. An empty table of documents gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{staged_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    done: str | None = None
    for name, function in STAGES[:-1]:
        with staging_scope(spark):
            function(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done is not None:
            delete_staged(spark, done)
        done = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
