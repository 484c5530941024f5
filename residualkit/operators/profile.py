"""Column profiles: value ranges, skew, target distribution, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residualkit.functions.scalars import inside

INTEGRAL = (
    ("tinyint", 8),
    ("smallint", 16),
    ("int", 32),
    ("bigint", 64),
)


def integral_ranges(df: DataFrame) -> dict[str, tuple[int, int]]:
    """Smallest and largest value of every integer column that has one, in one pass."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    if not names:
        return {}
    bounds = [b for c in names for b in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))]
    row = df.agg(*bounds).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(names) if row[2 * i] is not None}


def narrow_type(low: int, high: int) -> str:
    """Smallest integer type whose limits lie strictly outside ``[low, high]``."""
    for name, bits in INTEGRAL:
        if -(1 << (bits - 1)) < low and high < (1 << (bits - 1)) - 1:
            return name
    return "bigint"


def narrow_types(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cast integer columns to the smallest type that holds them. No value changes."""
    chosen = {c: narrow_type(*r) for c, r in integral_ranges(df).items() if c not in keep}
    return df.select(*[F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns])


def skew_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its population skewness, from one aggregation."""
    row = df.agg(*[F.skewness(c).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column_name", "skewness")


def target_profile(df: DataFrame, target: str, bound: float = 0.2) -> DataFrame:
    """Count, mean, spread, extremes, and the share strictly inside ``(-bound, bound)``."""
    x = F.col(target)
    return df.agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
        F.avg(F.when(x.isNotNull(), (F.abs(x) < bound).cast("double"))).alias("share_inside"),
    )


def target_histogram(df: DataFrame, target: str, low: float, high: float, buckets: int) -> DataFrame:
    """Rows per equal-width bucket; bucket 0 is below ``low``, ``buckets + 1`` from ``high`` on."""
    bucket = F.width_bucket(F.col(target), F.lit(float(low)), F.lit(float(high)), F.lit(buckets))
    return (
        df.filter(F.col(target).isNotNull())
        .groupBy(bucket.cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def trim(df: DataFrame, column: str | Column, bound: float = 1.0) -> DataFrame:
    """Drop rows whose value lies outside ``[-bound, bound]``; missing values go too."""
    return df.filter(inside(column, bound))
