"""The scoring job: predictions per key and month, and the submission table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.scalars import round_half_even
from residualkit.operators.models import VectorPrep, ensemble_predict
from residualkit.operators.snapshots import union_by_name

# History columns that exist once per month, and the digits of a submission.
MONTHLY_COLUMNS = ("prev_month", "prev_logerror", "month_interval", "has_history")
SUBMISSION_DIGITS = 4


def horizon_rows(
    score: DataFrame,
    year: int,
    months: Sequence[int],
    base_year: int,
    monthly: Sequence[str] = MONTHLY_COLUMNS,
) -> DataFrame:
    """One row per scoring row and month, with that month's calendar and history columns.

    ``prev_month_10`` and its like become ``prev_month``. Rows are expanded in
    place: no join and no shuffle.
    """
    dated = {f"{c}_{m}" for c in monthly for m in months}
    shared = [c for c in score.columns if c not in dated]
    rows = [
        F.struct(
            F.lit(year).alias("year"),
            F.lit(m).alias("month"),
            F.lit(m + 12 * (year - base_year)).alias("month_block"),
            F.lit(f"{year}{m:02d}").alias("yyyymm"),
            *[F.col(f"{c}_{m}").alias(c) for c in monthly if f"{c}_{m}" in score.columns],
        )
        for m in months
    ]
    return score.select(*shared, F.inline(F.array(*rows)))


def forecast(
    score: DataFrame,
    models: Sequence[Model],
    prep: VectorPrep,
    key: str,
    year: int,
    months: Sequence[int],
    base_year: int,
) -> DataFrame:
    """Key, ``yyyymm`` and the ensemble's mean prediction for every month of the year."""
    rows = prep.apply(horizon_rows(score, year, months, base_year))
    return ensemble_predict(rows, models).select(key, "yyyymm", "prediction")


def submission(
    predictions: Sequence[DataFrame] | DataFrame,
    key: str,
    periods: Sequence[str],
    prediction: str = "prediction",
    digits: int = SUBMISSION_DIGITS,
) -> DataFrame:
    """One row per key and one rounded column per ``yyyymm``, joined by key.

    The periods are given, so no pass is needed to discover them, and a key's rows
    become one row in a single shuffle. A prediction for a period that is not listed
    is an error at run time.
    """
    frames = [predictions] if isinstance(predictions, DataFrame) else list(predictions)
    period = F.col("yyyymm")
    unlisted = F.concat(F.lit("a prediction for an unlisted period: "), F.coalesce(period, F.lit("missing")))
    listed = F.when(period.isin(list(periods)), period).otherwise(F.raise_error(unlisted).cast("string"))
    rows = union_by_name(frames).withColumn("yyyymm", listed)
    wide = rows.groupBy(key).agg(*[F.first(F.when(period == p, F.col(prediction)), True).alias(p) for p in periods])
    return wide.select(key, *[round_half_even(F.col(f"`{p}`"), digits).alias(p) for p in periods])
