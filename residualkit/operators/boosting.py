"""Boosted trees for absolute loss: leaves are medians, and boosting goes on from stored margins.

A round fits one regression tree of Spark ML to the signs of the residuals, which is the
negative gradient of absolute loss. Its leaf values are then replaced by the exact median of the residuals in
each leaf (:mod:`residualkit.operators.quantiles`), scaled by the step. The rows are written
with their current prediction, the margin, every ``storeEvery`` rounds; in
between, the few trees since then are applied on the fly. So a round never depends on how many
rounds there were before, and a fit can be continued without starting anew.

A part of the rows, chosen by a hash of their features and label, is held out of the fit. Boosting ends
when ``patience`` trees in a row bring no improvement on it, and the best prefix of the trees is kept. The
rows a model is judged on in cross-validation are therefore never those that chose its length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from residualkit.operators.models import best_prefix
from residualkit.operators.quantiles import exact_quantiles
from residualkit.staging import stage

HOLDOUT_BUCKETS = 1 << 20


@dataclass(frozen=True)
class MedianTree:
    """A tree and what each of its leaves, by index, adds to the prediction."""

    tree: DecisionTreeRegressionModel
    values: tuple[float, ...]


def leaf_indices(trees: Sequence[MedianTree], features: str, df: DataFrame, name: str) -> DataFrame:
    """Add the leaf of every tree as an array; all trees share one pass over the features."""
    context = df.sparkSession.sparkContext
    regression = context._jvm.org.apache.spark.ml.regression
    java_trees = context._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    weights = context._gateway.new_array(context._jvm.double, len(trees))
    for i, t in enumerate(trees):
        java_trees[i], weights[i] = t.tree._java_obj, 1.0
    every = GBTRegressionModel(regression.GBTRegressionModel(f"{trees[0].tree.uid}_all", java_trees, weights))
    finder = every.setFeaturesCol(features).setPredictionCol("").setLeafCol("_leaves")
    return finder.transform(df).withColumn(name, vector_to_array("_leaves")).drop("_leaves")


def _numbers(values: Sequence[float]) -> str:
    return ", ".join(f"{v!r}D" for v in values)


def added_values(trees: Sequence[MedianTree], leaves: str) -> Column:
    """What each tree adds, as an array in the order of the trees."""
    table = ", ".join(f"array({_numbers(t.values)})" for t in trees)
    return F.expr(f"zip_with(`{leaves}`, array({table}), (leaf, own) -> own[int(leaf)])")


class MedianTreesModel(Model, HasFeaturesCol, HasPredictionCol):
    """``base`` plus the leaf values of all trees."""

    def __init__(self, base: float, trees: Sequence[MedianTree], losses: Sequence[tuple[float, float | None]] = ()) -> None:
        super().__init__()
        self.base, self.trees, self.losses = base, tuple(trees), tuple(losses)
        self._setDefault(featuresCol="features", predictionCol="prediction")

    def first(self, count: int) -> MedianTreesModel:
        """The model made of the first ``count`` trees."""
        kept = self.copy()
        kept.trees, kept.losses = self.trees[:count], self.losses[:count]
        return kept

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        output = self.getOrDefault(self.predictionCol)
        if not self.trees:
            return dataset.withColumn(output, F.lit(self.base))
        found = leaf_indices(self.trees, self.getOrDefault(self.featuresCol), dataset, "_leaf_of")
        total = F.aggregate(added_values(self.trees, "_leaf_of"), F.lit(self.base), lambda a, v: a + v)
        return found.withColumn(output, total).drop("_leaf_of")


@dataclass(frozen=True)
class Boosting:
    """A fit that can go on.

    ``rows`` are written with ``_margin``, the prediction of the first ``stored`` trees. ``losses`` has, after each
    round, the mean absolute error on the fitted rows and on those held out (None without such).
    ``leaves`` has a row for each round and leaf: ``round, leaf, rows, value``.
    """

    estimator: MedianBoostedTrees
    rows: DataFrame
    base: float
    trees: tuple[MedianTree, ...] = ()
    stored: int = 0
    losses: tuple[tuple[float, float | None], ...] = ()
    leaves: tuple[tuple[int, int, int, float], ...] = ()

    def model(self) -> MedianTreesModel:
        """The best prefix on the held-out rows; all trees where none are held out."""
        made = MedianTreesModel(self.base, self.trees, self.losses)
        made._set(featuresCol=self.estimator.getFeaturesCol(), predictionCol=self.estimator.getPredictionCol())
        held = [h for _, h in self.losses]
        if not held or held[0] is None:
            return made
        return made.first(best_prefix(held, self.estimator.getOrDefault("patience")))

    def finished(self) -> bool:
        """Whether ``patience`` trees in a row brought no improvement."""
        held = [h for _, h in self.losses]
        if not held or held[0] is None:
            return False
        return len(held) - best_prefix(held, self.estimator.getOrDefault("patience")) >= self.estimator.getOrDefault("patience")

    def _scored(self, trees: Sequence[MedianTree]) -> DataFrame:
        """Rows with ``_steps``, the margins after the stored trees and after each tree since then."""
        if not trees:
            return self.rows.withColumn("_steps", F.array("_margin"))
        found = leaf_indices(trees, "_features", self.rows, "_leaf_of")
        running = F.aggregate(
            added_values(trees, "_leaf_of"),
            F.array("_margin"),
            lambda seen, v: F.concat(seen, F.array(F.element_at(seen, -1) + v)),
        )
        return found.withColumn("_steps", running).drop("_leaf_of")

    def more(self, rounds: int) -> Boosting:
        """Fit up to ``rounds`` more trees, fewer if boosting is finished."""
        current, left = self, rounds
        while left > 0 and not current.finished():
            count = min(left, max(1, current.estimator.getOrDefault("storeEvery")))
            current = current._chunk(count)
            left -= count
        return current

    def _chunk(self, count: int) -> Boosting:
        new: list[MedianTree] = []
        leaves: list[tuple[int, int, int, float]] = []
        for _ in range(count):
            fitted, sizes = self._round(new)
            number = len(self.trees) + len(new) + 1
            leaves += [(number, leaf, n, fitted.values[leaf]) for leaf, n in sizes]
            new.append(fitted)
        scored = self._scored(new)
        errors = [F.abs(F.col("_label") - F.col("_steps")[i + 1]) for i in range(count)]
        means = scored.groupBy("_fit").agg(*[F.avg(e).alias(f"e{i}") for i, e in enumerate(errors)]).collect()
        by_part = {r["_fit"]: r for r in means}
        losses = [(by_part[True][f"e{i}"], by_part[False][f"e{i}"] if False in by_part else None) for i in range(count)]
        kept = scored.withColumn("_margin", F.element_at("_steps", -1)).drop("_steps")
        return replace(
            self,
            rows=stage(kept, "margins"),
            trees=(*self.trees, *new),
            stored=len(self.trees) + count,
            losses=(*self.losses, *losses),
            leaves=(*self.leaves, *leaves),
        )

    def _round(self, pending: Sequence[MedianTree]) -> tuple[MedianTree, list[tuple[int, int]]]:
        """One tree with medians in its leaves, and how many rows each leaf was learned from."""
        own = self.estimator
        residual = F.col("_label") - F.element_at("_steps", -1)
        rows = self._scored(pending).filter("_fit").select("_features", residual.alias("_residual"))
        signs = rows.withColumn("_sign", F.signum("_residual"))
        number = len(self.trees) + len(pending)
        learner = DecisionTreeRegressor(
            featuresCol="_features",
            labelCol="_sign",
            maxDepth=own.getOrDefault("maxDepth"),
            maxBins=own.getOrDefault("maxBins"),
            minInstancesPerNode=own.getOrDefault("minInstancesPerNode"),
            seed=own.getOrDefault("seed") + number,
        )
        tree = learner.fit(signs)
        finder = tree.copy({tree.predictionCol: "", tree.leafCol: "_leaf"})
        placed = finder.transform(rows).select(F.col("_leaf").cast("int").alias("_leaf"), "_residual")
        medians = exact_quantiles(placed, ["_leaf"], "_residual", [0.5], own.getOrDefault("rowsAtMost")).collect()
        step = own.getOrDefault("stepSize")
        found = {r["_leaf"]: step * r["quantiles"][0] for r in medians}
        values = tuple(found.get(i, 0.0) for i in range(max(found, default=0) + 1))
        return MedianTree(tree, _padded(values, tree)), sorted((r["_leaf"], r["n"]) for r in medians)


def _padded(values: tuple[float, ...], tree: DecisionTreeRegressionModel) -> tuple[float, ...]:
    """A value for every leaf; one that no row reaches adds nothing."""
    leaves = (tree.numNodes + 1) // 2
    return (*values, *[0.0] * (leaves - len(values)))


class MedianBoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize, HasSeed):
    """Boosting for absolute loss; can be passed wherever a Spark ML regressor can."""

    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a leaf", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "trees without improvement before boosting ends", TypeConverters.toInt)
    holdout = Param(Params._dummy(), "holdout", "share of the rows held out to choose the length; 0 for none", TypeConverters.toFloat)
    storeEvery = Param(Params._dummy(), "storeEvery", "rounds between two writes of the margins", TypeConverters.toInt)
    rowsAtMost = Param(Params._dummy(), "rowsAtMost", "rows of a leaf above which its median is bracketed first", TypeConverters.toInt)

    def __init__(self, **params: object) -> None:
        super().__init__()
        self._setDefault(
            featuresCol="features",
            labelCol="label",
            predictionCol="prediction",
            maxIter=100,
            stepSize=0.1,
            seed=42,
            maxDepth=5,
            maxBins=32,
            minInstancesPerNode=1,
            patience=20,
            holdout=0.1,
            storeEvery=4,
            rowsAtMost=1 << 20,
        )
        self._set(**params)

    def start(self, dataset: DataFrame) -> Boosting:
        """Write the rows with the median label as their margin. Rows without a label are left out."""
        label = F.col(self.getLabelCol()).cast("double")
        share = int(round(self.getOrDefault("holdout") * HOLDOUT_BUCKETS))
        chosen = F.pmod(F.xxhash64(label, vector_to_array(self.getFeaturesCol()), F.lit(self.getSeed())), F.lit(HOLDOUT_BUCKETS))
        rows = dataset.select(
            F.col(self.getFeaturesCol()).alias("_features"), label.alias("_label"), (chosen >= share).alias("_fit")
        ).filter("_label is not null")
        placed = stage(rows, "boosting")
        middle = exact_quantiles(placed.filter("_fit"), [], "_label", [0.5], self.getOrDefault("rowsAtMost")).first()
        if middle is None:
            raise ValueError("there are no rows with a label to fit")
        base = float(middle["quantiles"][0])
        return Boosting(self, placed.withColumn("_margin", F.lit(base)), base)

    def _fit(self, dataset: DataFrame) -> MedianTreesModel:
        return self.start(dataset).more(self.getMaxIter()).model()


def loss_rows(spark: SparkSession, boosting: Boosting) -> DataFrame:
    """``round, split, mae``: the mean absolute error after each round."""
    rows = [
        (i + 1, split, float(loss))
        for i, pair in enumerate(boosting.losses)
        for split, loss in zip(("fit", "holdout"), pair, strict=True)
        if loss is not None
    ]
    return spark.createDataFrame(rows, "round int, split string, mae double")


def leaf_rows(spark: SparkSession, boosting: Boosting) -> DataFrame:
    """``round, leaf, rows, value``: what each leaf adds, and how many rows its median is of."""
    return spark.createDataFrame([(r, leaf, n, float(v)) for r, leaf, n, v in boosting.leaves], "round int, leaf int, rows long, value double")
