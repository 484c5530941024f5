"""Labelled rows for the classifiers: a fold by document id and a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns

FOLDS = 5


def held_out(id_column: Column) -> Column:
    """True for the fifth of the ids whose crc32 of the id as text is divisible by 5; NULL ids are not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_ids(labels: DataFrame, label: str, at_most: int, id_column: str = "doc_id") -> DataFrame:
    """``(id, y)`` of at most ``at_most`` labelled ids that are not held out, in hash order.

    Rows without an id or with a label other than 0 and 1 are passed over; an id
    labelled more than once takes its largest label.
    """
    rows = first_columns(labels, [id_column, label]).toDF("id", "y").withColumn("id", F.col("id").cast("long"))
    usable = rows.filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
    single = usable.groupBy("id").agg(F.max("y").cast("int").alias("y"))
    return single.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(at_most)


def training_rows(texts: DataFrame, labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """``(id, text, y)`` of the sample. ``texts`` has columns ``id`` and ``text``.

    The sample is broadcast: ``at_most`` bounds it, at 16 bytes a row.
    """
    return texts.join(F.broadcast(training_ids(labels, label, at_most)), "id")
