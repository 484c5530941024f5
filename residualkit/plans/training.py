"""The training job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.scalars import winsorize
from residualkit.operators.boosting import MedianBoostedTrees
from residualkit.operators.folds import group_folds, shuffled_folds
from residualkit.operators.models import (
    CrossValidation,
    VectorPrep,
    boosted_trees,
    cross_validate,
    fit_vector_prep,
)
from residualkit.sources.config import TrainConfig

# Which sales are trained on and how far the target may reach.
FIRST_PERIOD_AFTER = 3
TARGET_LOW = -1.0
TARGET_HIGH = 1.0

# Configuration names of other boosters and the Spark parameter each stands for.
PARAMETER_NAMES = {
    "learning_rate": "stepSize",
    "eta": "stepSize",
    "max_depth": "maxDepth",
    "depth": "maxDepth",
    "max_bin": "maxBins",
    "min_data_in_leaf": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode",
    "bagging_fraction": "subsamplingRate",
    "subsample": "subsamplingRate",
    "feature_fraction": "featureSubsetStrategy",
    "colsample_bytree": "featureSubsetStrategy",
}
OBJECTIVES = {
    "mae": "absolute",
    "l1": "absolute",
    "regression_l1": "absolute",
    "mse": "squared",
    "l2": "squared",
    "regression": "squared",
}
# Entries that change nothing in what is learned here.
WITHOUT_EFFECT = ("verbosity", "verbose", "silent", "metric", "eval_metric", "n_jobs", "nthread", "num_threads", "device")
BOOSTERS = ("gbt", "lgb", "xgb", "cat")
#: Boosting for absolute loss with medians in the leaves, see :mod:`residualkit.operators.boosting`.
MEDIAN_BOOSTER = "median"


@dataclass(frozen=True)
class Trained:
    """A configuration, the vector preparation learned for it, and its fold models."""

    config: TrainConfig
    prep: VectorPrep
    result: CrossValidation


def estimator_for(config: TrainConfig) -> Estimator:
    """The estimator a configuration describes.

    The model type ``median`` means boosting for absolute loss; every other booster name means Spark's boosted trees.
    """
    if config.model_type == MEDIAN_BOOSTER:
        return _median_estimator(config)
    if config.model_type not in BOOSTERS:
        raise ValueError(f"model type {config.model_type} needs an estimator of its own")
    params = {}
    for name, value in config.model_params.items():
        if name in ("objective", "lossType"):
            params["lossType"] = OBJECTIVES.get(str(value), value)
        elif name not in WITHOUT_EFFECT:
            spark_name = PARAMETER_NAMES.get(name, name)
            if not GBTRegressor().hasParam(spark_name):
                raise ValueError(f"parameter {name} has no counterpart in Spark's boosted trees")
            if spark_name == "maxDepth" and int(value) < 0:
                raise ValueError(f"{name}={value}: Spark's trees need a depth limit of 0 to 30")
            params[spark_name] = str(value) if spark_name == "featureSubsetStrategy" else value
    return boosted_trees(params, config.n_estimators, config.seed)


def _median_estimator(config: TrainConfig) -> MedianBoostedTrees:
    made = MedianBoostedTrees(maxIter=config.n_estimators, seed=config.seed)
    if config.early_stopping_rounds is None:
        made.set(made.holdout, 0.0)
    else:
        made.set(made.patience, config.early_stopping_rounds)
    for name, value in config.model_params.items():
        if name in ("objective", "lossType"):
            if OBJECTIVES.get(str(value), value) != "absolute":
                raise ValueError(f"model type {MEDIAN_BOOSTER} is for absolute loss, not {value}")
        elif name not in WITHOUT_EFFECT:
            spark_name = PARAMETER_NAMES.get(name, name)
            if not made.hasParam(spark_name):
                raise ValueError(f"parameter {name} has no counterpart in boosting for absolute loss")
            made.set(made.getParam(spark_name), value)
    return made


def train(
    rows: DataFrame,
    config: TrainConfig,
    estimator: Estimator | None = None,
    row_id: str = "row_id",
    label: str = "logerror",
    period: str = "month_block",
    groups: str | None = None,
    flag_missing: bool = False,
    parallelism: int = 1,
) -> Trained:
    """Filter to the later periods, clip the target, assign seeded folds, cross-validate.

    ``groups`` keeps all rows of a group in one fold. ``estimator`` replaces the
    one the configuration describes.
    """
    chosen = rows.filter(F.col(period) > FIRST_PERIOD_AFTER)
    chosen = chosen.withColumn(label, winsorize(label, TARGET_LOW, TARGET_HIGH))
    chosen = chosen.filter(F.col(label).isNotNull())
    if groups is None:
        folded = shuffled_folds(chosen, row_id, config.n_splits, config.seed)
    else:
        folded = group_folds(chosen, groups, config.n_splits, config.seed, row_key=row_id)
    prep = fit_vector_prep(folded, config.features, flag_missing)
    result = cross_validate(
        prep.apply(folded),
        estimator or estimator_for(config),
        config.n_splits,
        label,
        row_id,
        feature_names=prep.names,
        eval_metric=config.eval_metric,
        early_stopping_rounds=config.early_stopping_rounds,
        parallelism=parallelism,
    )
    return Trained(config, prep, result)
