"""Cross-validated regression on Spark ML, out-of-fold predictions, ensembles, blends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.functions.scalars import balanced_sum
from residualkit.operators import binned
from residualkit.operators.folds import checked_fold
from residualkit.operators.metrics import best_prefix, regression_metrics
from residualkit.staging import checkpoint_root, stage

FIRST_TREES = 32
EVALUATION_LOSS = {"mae": "absolute", "mse": "squared", "rmse": "squared"}


@dataclass(frozen=True)
class VectorPrep:
    """Learned fill values that turn feature columns into a vector without missing entries."""

    features: tuple[str, ...]
    fills: Mapping[str, float]
    flags: tuple[str, ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return (*self.features, *[f"{c}_missing" for c in self.flags])

    def apply(self, df: DataFrame, output: str = "features") -> DataFrame:
        filled = [F.coalesce(F.col(c).cast("double"), F.lit(self.fills[c])) for c in self.features]
        filled += [F.col(c).isNull().cast("double") for c in self.flags]
        inputs = [f"_f{i}" for i in range(len(filled))]
        wide = df.select("*", *[c.alias(n) for c, n in zip(filled, inputs, strict=True)])
        return VectorAssembler(inputCols=inputs, outputCol=output).transform(wide).drop(*inputs)


def fit_vector_prep(
    df: DataFrame, features: Sequence[str], flag_missing: bool = False, default_fill: float = -1.0
) -> VectorPrep:
    """Learn ``min - 1`` per feature in one aggregation. Spark trees take no missing
    values; a value below all others lets a split set them apart."""
    lows = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in features]).first()
    fills = {c: default_fill if lows[c] is None else lows[c] - 1.0 for c in features}
    return VectorPrep(tuple(features), fills, tuple(features) if flag_missing else ())


@dataclass(frozen=True)
class CrossValidation:
    """``oof``: row id, fold, label, prediction. ``fold_metrics``: one row per fold and
    split. ``importance``: feature, importance, fold (trees only). ``models``: one per fold."""

    oof: DataFrame
    fold_metrics: DataFrame
    importance: DataFrame | None
    models: list[Model]


def cross_validate(
    df: DataFrame,
    estimator: Estimator,
    k: int,
    label: str,
    row_id: str,
    fold: str = "fold",
    features: str = "features",
    feature_names: Sequence[str] = (),
    eval_metric: str = "mae",
    early_stopping_rounds: int | None = None,
    parallelism: int = 1,
) -> CrossValidation:
    """Fit one model per fold on the other folds and score it on its own.

    The vectors are staged once, in one folder per fold, so that a fold's training
    and validation scans read just their files. Boosted trees of all folds are fitted together where
    :mod:`residualkit.operators.binned` covers them; of other models ``parallelism`` folds are fitted
    at a time. A missing fold, or one that is not between 0 and ``k`` - 1, is an error.
    """
    checkpoint_root(df.sparkSession)
    checked = df.withColumn(fold, checked_fold(fold, k))
    vectors = stage(checked.select(row_id, fold, label, features), "vectors", partition_by=fold)
    prepared = estimator.copy({estimator.labelCol: label, estimator.featuresCol: features})

    def fit(i: int) -> Model:
        others, own = vectors.filter(F.col(fold) != i), vectors.filter(F.col(fold) == i)
        if early_stopping_rounds is not None and isinstance(prepared, GBTRegressor):
            return fit_with_patience(prepared, others, own, early_stopping_rounds, eval_metric)
        return prepared.fit(others)

    if binned.covers(prepared, vectors, k):
        loss = evaluation_loss(eval_metric) if early_stopping_rounds is not None else "absolute"
        models = binned.fit_folds(vectors, prepared, k, fold, early_stopping_rounds, loss)
    elif parallelism > 1:
        with ThreadPool(min(parallelism, k)) as pool:
            models = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(k))
    else:
        models = [fit(i) for i in range(k)]

    held_out = [
        model.transform(vectors.filter(F.col(fold) == i)).select(row_id, fold, label, "prediction")
        for i, model in enumerate(models)
    ]
    return CrossValidation(
        reduce(DataFrame.unionByName, held_out),
        fold_metrics(vectors, models, label, fold, features),
        importance_table(df, models, feature_names),
        models,
    )


def fold_metrics(
    df: DataFrame, models: Sequence[Model], label: str, fold: str = "fold", features: str = "features"
) -> DataFrame:
    """Metrics of every fold's model on its own fold and on the others, in one pass over the rows."""
    names = [f"_p{i}" for i in range(len(models))]
    scored = with_predictions(df, models, names, features)
    rows = [
        F.struct(
            F.lit(i).alias("fold"),
            F.when(F.col(fold) == i, F.lit("valid")).otherwise(F.lit("train")).alias("split"),
            F.col(name).alias("prediction"),
        )
        for i, name in enumerate(names)
    ]
    return regression_metrics(scored.select(label, F.inline(F.array(*rows))), label, by=["fold", "split"])


def importance_table(df: DataFrame, models: Sequence[Model], names: Sequence[str]) -> DataFrame | None:
    """Feature, importance and fold; as many rows as features times folds."""
    if not names or not all(hasattr(m, "featureImportances") for m in models):
        return None
    rows = [
        (name, float(value), i)
        for i, model in enumerate(models)
        for name, value in zip(names, model.featureImportances.toArray(), strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, fold int")


def fit_with_patience(
    estimator: GBTRegressor,
    rows: DataFrame,
    holdout: DataFrame,
    patience: int,
    metric: str = "mae",
    first: int = FIRST_TREES,
) -> GBTRegressionModel:
    """Boost until ``patience`` trees in a row bring no improvement on ``holdout``.

    The estimator's number of trees is only the limit. A fit of few trees is
    tried first, see :func:`fit_lengths`, and a longer one while its best tree is
    still close to its end. Trees depend on the earlier ones and the seed alone, so
    a longer fit begins with the shorter one and the result is the same as from a
    fit of all trees.
    """
    limit = estimator.getMaxIter()
    for trees in fit_lengths(limit, max(first, 2 * patience)):
        model = estimator.copy({estimator.maxIter: trees}).fit(rows)
        kept = stop_early(model, holdout, patience, metric)
        if trees == limit or trees - kept.getNumTrees >= patience:
            return kept


def fit_lengths(limit: int, first: int) -> list[int]:
    """Numbers of trees to try, each about half of the next, the last one ``limit``.

    The smallest is at least ``first``, or ``limit`` where that is less. A fit starts anew,
    so the lengths are halved from the limit: all of them together are about twice the limit at most,
    and a limit below twice ``first`` is reached by a single fit.
    """
    lengths = [limit]
    while lengths[0] >= 2 * max(1, first):
        lengths.insert(0, -(-lengths[0] // 2))
    return lengths


def evaluation_loss(metric: str) -> str:
    if metric not in EVALUATION_LOSS:
        raise ValueError(f"metric {metric} is none of {sorted(EVALUATION_LOSS)}")
    return EVALUATION_LOSS[metric]


def stop_early(model: GBTRegressionModel, holdout: DataFrame, patience: int, metric: str = "mae") -> GBTRegressionModel:
    """Keep the trees up to the best one on ``holdout``.

    Spark's own early stopping has no patience: it ends at the first tree without
    improvement. Here all trees are fitted, one pass gives the loss after each of
    them, and the tail is dropped.
    """
    count = best_prefix(model.evaluateEachIteration(holdout, evaluation_loss(metric)), patience)
    if count == model.getNumTrees:
        return model
    return first_trees(model, count, holdout.sparkSession.sparkContext)


def first_trees(
    model: GBTRegressionModel, count: int, context: SparkContext | None = None
) -> GBTRegressionModel:
    """The boosted model made of the first ``count`` trees."""
    context = context or SparkContext.getOrCreate()
    regression = context._jvm.org.apache.spark.ml.regression
    whole = model._java_obj
    trees = context._gateway.new_array(regression.DecisionTreeRegressionModel, count)
    weights = context._gateway.new_array(context._jvm.double, count)
    for i in range(count):
        trees[i] = whole.trees()[i]
        weights[i] = whole.treeWeights()[i]
    return GBTRegressionModel(regression.GBTRegressionModel(whole.uid(), trees, weights))


def with_predictions(df: DataFrame, models: Sequence[Model], names: Sequence[str], features: str = "features") -> DataFrame:
    """Append one prediction column per model; the models share one pass over the rows."""
    for model, name in zip(models, names, strict=True):
        df = model.copy({model.featuresCol: features, model.predictionCol: name}).transform(df)
    return df


def ensemble_predict(df: DataFrame, models: Sequence[Model], output: str = "prediction", features: str = "features") -> DataFrame:
    """Mean of the models' predictions, computed in one pass over the rows."""
    if not models:
        raise ValueError("an ensemble needs at least one model")
    names = [f"_p{i}" for i in range(len(models))]
    scored = with_predictions(df, models, names, features)
    mean = balanced_sum([F.col(n) for n in names]) / F.lit(float(len(models)))
    return scored.withColumn(output, mean).drop(*names)


@dataclass(frozen=True)
class Blend:
    """A linear combination of prediction columns."""

    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        terms = [F.col(c) * F.lit(w) for c, w in zip(self.columns, self.coefficients, strict=True)]
        return balanced_sum([F.lit(self.intercept), *terms])

    def apply(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.column())


def fit_blend(df: DataFrame, columns: Sequence[str], label: str) -> Blend:
    """Least-squares weights for prediction columns, solved from one pass of moments."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_blend").transform(df.select(*columns, label))
    fitted = LinearRegression(featuresCol="_blend", labelCol=label, solver="normal").fit(vectors)
    return Blend(tuple(columns), tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def simplex_weights(gram: Sequence[Sequence[float]], cross: Sequence[float]) -> list[float]:
    """Weights of at least 0 that add up to 1 and minimise w' G w - 2 c' w, by an active-set search.

    Starts from the best single model. The weights that are not 0 solve the problem without bounds; a
    step that would make one negative stops where it reaches 0, and a weight of 0 comes back while
    its gradient says that the loss would fall.
    """
    n = len(cross)
    scale = max(1.0, *(abs(gram[i][i]) for i in range(n)))

    def gradient(w: Sequence[float]) -> list[float]:
        return [sum(gram[i][j] * w[j] for j in range(n)) - cross[i] for i in range(n)]

    best = min(range(n), key=lambda i: (gram[i][i] - 2 * cross[i], i))
    weights, active = [float(i == best) for i in range(n)], [best]
    for _ in range(50 * n):
        target = _equality_weights(gram, cross, active)
        if all(target[i] >= 0 for i in active):
            weights = target
            slope = gradient(weights)
            level = sum(slope[i] for i in active) / len(active)
            falling = [i for i in range(n) if i not in active and slope[i] < level - 1e-12 * scale]
            if not falling:
                return weights
            active = sorted([*active, min(falling, key=lambda i: (slope[i], i))])
        else:
            steps = {i: weights[i] / (weights[i] - target[i]) for i in active if target[i] < 0}
            leaving = min(steps, key=lambda i: (steps[i], i))
            t = steps[leaving]
            weights = [w + t * (v - w) for w, v in zip(weights, target, strict=True)]
            weights[leaving] = 0.0
            active = [i for i in active if i != leaving]
    return weights


def _equality_weights(gram: Sequence[Sequence[float]], cross: Sequence[float], active: Sequence[int]) -> list[float]:
    """The best weights on ``active`` that add up to 1, of any sign; the smallest such where models are copies."""
    import numpy as np

    m = len(active)
    system = np.zeros((m + 1, m + 1))
    system[:m, :m] = [[gram[i][j] for j in active] for i in active]
    system[:m, m] = system[m, :m] = 1.0
    solved = np.linalg.lstsq(system, np.array([*[cross[i] for i in active], 1.0]), rcond=1e-12)[0]
    weights = [0.0] * len(cross)
    for place, i in enumerate(active):
        weights[i] = float(solved[place])
    return weights


def join_predictions(
    predictions: Mapping[str, DataFrame], keys: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    """One row per key with one column for each model, named as in ``predictions``.

    A row that a model did not predict has NULL there; a key that a model predicts twice is an error at run time.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [df.select(*keys, F.lit(name).alias("_model"), F.col(prediction).cast("double").alias("_p")) for name, df in predictions.items()],
    )
    twice = F.concat(F.lit("two predictions by one model for "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))

    def of(name: str) -> Column:
        mine = F.col("_model") == name
        many = F.count(F.when(mine, 1)) > 1
        return F.when(many, F.raise_error(F.first(twice)).cast("double")).otherwise(F.max(F.when(mine, F.col("_p")))).alias(name)

    return stacked.groupBy(*keys).agg(*[of(name) for name in predictions])


def fit_simplex_blend(
    out_of_fold: Mapping[str, DataFrame], truth: DataFrame, key: str, label: str, prediction: str = "prediction"
) -> Blend:
    """Weights of at least 0 that add up to 1, with the least squared error of the blended out-of-fold predictions.

    ``out_of_fold`` has for each model ``key`` and its prediction; they and ``truth`` meet by ``key``. Rows that lack the
    label or a prediction do not count. One pass gives the products of all pairs of models; what reaches the driver is one row.
    """
    names = list(out_of_fold)
    joined = join_predictions({n: df.filter(F.col(key).isNotNull()) for n, df in out_of_fold.items()}, [key], prediction)
    rows = joined.join(truth.select(key, F.col(label).cast("double").alias("_y")), key).dropna(subset=[*names, "_y"])
    errors = [F.col(n) - F.col("_y") for n in names]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = rows.agg(*[F.avg(errors[i] * errors[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    if not pairs or sums[0] is None:
        raise ValueError("no row has a label and a prediction of every model")
    # On the simplex the squared error is w' E w with the products of the errors themselves.
    gram = [[sums[f"g{min(i, j)}_{max(i, j)}"] for j in range(len(names))] for i in range(len(names))]
    return Blend(tuple(names), tuple(simplex_weights(gram, [0.0] * len(names))), 0.0)


def blend_predictions(
    blend: Blend, predictions: Mapping[str, DataFrame], keys: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    """``keys`` and the blended prediction; NULL where a model of the blend with a weight has none."""
    used = {n: w for n, w in zip(blend.columns, blend.coefficients, strict=True) if w != 0}
    kept = Blend(tuple(used), tuple(used.values()), blend.intercept)
    joined = join_predictions({n: predictions[n] for n in used}, keys, prediction)
    return kept.apply(joined, prediction).select(*keys, prediction)


def boosted_trees(params: Mapping[str, object], trees: int, seed: int) -> GBTRegressor:
    """Gradient-boosted regression trees; ``params`` are Spark parameter names."""
    estimator = GBTRegressor(maxIter=trees, seed=seed)
    for name, value in params.items():
        estimator.set(estimator.getParam(name), value)
    return estimator
