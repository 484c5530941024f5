"""Reading text files that hold damaged rows: good rows go on, damaged ones are set aside with a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residualkit.sources.tables import missing_to_null
from residualkit.staging import stage

RAW = "_damaged_text"


@dataclass(frozen=True)
class Quarantined:
    """``rows`` that could be read, ``rejected`` (``file``, ``reason``, ``text``), and how many of each there are."""

    rows: DataFrame
    rejected: DataFrame
    good: int
    bad: int

    def checked(self, most_bad_share: float) -> DataFrame:
        """The good rows, or an error if more than the given share of all rows was rejected."""
        if self.bad > most_bad_share * (self.good + self.bad):
            raise ValueError(f"{self.bad} of {self.good + self.bad} rows were rejected")
        return self.rows


def read_quarantined(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    rejected_path: str | None = None,
    required: Sequence[str] = (),
    format: str = "csv",
    **options: str,
) -> Quarantined:
    """Read text rows by a schema and set damaged ones aside.

    Damaged is a row with a field that is not of its type, with too few or too many fields, or without one of the
    ``required`` columns. An empty field that is not required is missing, not damaged. Rejected rows are written as Parquet to
    ``rejected_path``, or to the staging folder. The files are parsed once; both counts are observed while the rows are
    staged, and a task that runs twice is counted twice, so they are at least the true ones.
    """
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    unknown = [c for c in required if c not in fields.names]
    if unknown:
        raise ValueError(f"required columns {unknown} are not in the schema")
    optional = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.fields])
    reader = spark.read.schema(optional.add(RAW, T.StringType())).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", RAW)
    if format == "csv":
        options = {"header": "true", "dateFormat": "yyyy-MM-dd", "enforceSchema": "true"} | options
    parsed = reader.options(**options).format(format).load(path)
    missing = F.coalesce(*[F.when(F.col(f"`{c}`").isNull(), F.lit(f"no {c}")) for c in required], F.lit(None).cast("string"))
    reason = F.when(F.col(RAW).isNotNull(), F.lit("malformed")).otherwise(missing)
    marked = parsed.select("*", F.col("_metadata.file_name").alias("_file"), reason.alias("_reason"))
    seen = Observation()
    counted = marked.observe(seen, F.count(F.when(F.col("_reason").isNull(), 1)).alias("good"), F.count("_reason").alias("bad"))
    staged = stage(counted, "parsed")
    rows = missing_to_null(staged.filter("_reason is null").select(*[F.col(f"`{c}`") for c in fields.names]), texts=True)
    values = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields.names])
    bad = staged.filter("_reason is not null").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), F.coalesce(F.col(RAW), values).alias("text")
    )
    if rejected_path is None:
        rejected = stage(bad, "rejected")
    else:
        bad.write.mode("overwrite").parquet(rejected_path)
        rejected = spark.read.schema(bad.schema).parquet(rejected_path)
    return Quarantined(rows, rejected, seen.get["good"], seen.get["bad"])
