"""Error metrics of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.operators.lookup import keyed_join

METRICS = ("mae", "mse", "rmse")


def regression_metrics(
    df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows, MAE, MSE and RMSE, overall or per group. Rows missing either side are left out."""
    error = F.col(label) - F.col(prediction)
    scored = df.filter(error.isNotNull())
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def fold_summary(fold_metrics: DataFrame, metric: str = "mae", by: Sequence[str] = ("split",)) -> DataFrame:
    """Mean and population standard deviation of a metric over the folds."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric}")
    return fold_metrics.groupBy(*by).agg(
        F.avg(metric).alias(f"{metric}_mean"), F.stddev_pop(metric).alias(f"{metric}_std")
    )


def score_sold_only(
    predictions: DataFrame, actuals: DataFrame, on: Sequence[str], label: str, prediction: str = "prediction"
) -> DataFrame:
    """Metrics over the keys and periods in which a sale happened; other predictions are ignored.

    ``predictions`` has one row per key and period; ``actuals`` may repeat one.
    """
    sold = keyed_join(actuals.select(*on, label), predictions.select(*on, prediction), on)
    return regression_metrics(sold, label, prediction)


def mean_importance(importance: DataFrame) -> DataFrame:
    """Mean importance of each feature over the folds."""
    return importance.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_features(importance: DataFrame, limit: int = 50) -> DataFrame:
    """Per-fold importance rows of the features with the highest mean importance.

    The list has ``limit`` rows at most, which bounds its broadcast.
    """
    best = mean_importance(importance).orderBy(F.desc("importance"), "feature").limit(limit)
    return importance.join(F.broadcast(best.select("feature")), "feature", "left_semi")


def best_prefix(losses: Sequence[float], patience: int) -> int:
    """Number of trees at the lowest loss seen before ``patience`` trees in a row
    brought no improvement."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1
