"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residualkit.staging import arrow_rows, stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage_python(df: DataFrame, label: str, rows: int = 256) -> DataFrame:
    """Write a table whose rows Python makes, in batches of bounded size."""
    with arrow_rows(df.sparkSession, rows):
        return stage(df, label)


def first_columns(df: DataFrame, names: Sequence[str], reserved: Sequence[str] = ()) -> DataFrame:
    """Only the named columns. Columns of other names never reach an operator, so they cannot clash."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing} in {df.columns}")
    return df.select(*[F.col(f"`{c}`") for c in names])


def known(column: Column | str) -> Column:
    """A text column without NULL: NULL is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
