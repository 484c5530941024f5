"""Tables in CSV, Parquet and whatever else Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residualkit.functions.scalars import nan_to_null
from residualkit.operators.ordering import row_index
from residualkit.staging import stage

# Texts that mean "missing" in a CSV file.
MISSING_TEXTS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """Read a table so that a missing value is always NULL, never NaN.

    Only float columns are wrapped for that, and text columns of CSV files; keys
    and dates stay bare, so filters on them still reach the scan. A CSV read
    wants a schema: inferring one costs a pass over the file.
    """
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return missing_to_null(reader.options(**options).load(path), texts=format == "csv")


def read_in_order(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    format: str = "csv",
    name: str = "row_id",
    start: int = 0,
    **options: str,
) -> DataFrame:
    """Read a table whose row order matters and number its rows in file order.

    The order is file path, position of the split in the file, row in the split.
    ``start`` lets the numbers of several files follow each other.
    """
    rows = read_table(spark, path, schema, format, **options)
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_row"),
    )
    numbered = row_index(stage(placed, "in_order"), ["_file", "_split", "_row"], name)
    return numbered.drop("_file", "_split", "_row").withColumn(name, F.col(name) + start)


def missing_to_null(df: DataFrame, texts: bool = False) -> DataFrame:
    """NaN becomes NULL in float columns; with ``texts`` so do missing markers in text columns."""
    changed = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            changed[field.name] = nan_to_null(field.name)
        elif texts and isinstance(field.dataType, T.StringType):
            column = F.col(field.name)
            changed[field.name] = F.when(~column.isin(*MISSING_TEXTS), column)
    return df.withColumns(changed) if changed else df


def bool_to_text(df: DataFrame) -> DataFrame:
    """Boolean columns as the texts ``True`` and ``False``.

    A yes-or-nothing column that was inferred as boolean becomes the text category it is.
    """
    changed = {
        f.name: F.when(F.col(f.name), F.lit("True")).when(~F.col(f.name), F.lit("False"))
        for f in df.schema.fields
        if isinstance(f.dataType, T.BooleanType)
    }
    return df.withColumns(changed) if changed else df


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write Parquet, by default replacing what is there."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def submission_name(model_type: str, seed: int) -> str:
    return f"submission_{model_type}_{seed}"


def write_submission(
    submission: DataFrame, folder: str, model_type: str, seed: int, single_file: bool = False
) -> str:
    """Write a submission as CSV with a header and return its folder.

    The files are written in parallel. ``single_file`` merges them and is meant
    for submissions that fit one task.
    """
    path = f"{folder.rstrip('/')}/{submission_name(model_type, seed)}"
    out = submission.coalesce(1) if single_file else submission
    out.write.mode("overwrite").option("header", True).csv(path)
    return path
