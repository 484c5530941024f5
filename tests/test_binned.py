"""Trees of all folds fitted together, against Spark's own."""

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from residualkit.operators import binned, models


@pytest.fixture(scope="module")
def data(spark):
    """Noisy rows of three folds; features with many values, five values, and one."""
    df = spark.range(0, 900, 1, 3).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 3).cast("int").alias("fold"),
        (F.col("id") * 7919 % 1009 / 1009).alias("a"),
        (F.col("id") * 104729 % 5).cast("double").alias("b"),
        F.lit(1.0).alias("c"),
        (F.col("id") * 31 % 613 / 613).alias("d"),
    )
    y = F.sin(F.col("a") * 6) * F.col("b") / 4 + F.col("d") / 3 + (F.col("row_id") * 15485863 % 997) / 1994
    return models.fit_vector_prep(df, ["a", "b", "c", "d"]).apply(df.withColumn("y", y)).cache()


def tree_lines(tree):
    return [line for line in tree.toDebugString.split("\n")[1:] if "Predict" not in line]


@pytest.mark.parametrize("patience", [None, 2])
def test_trees_are_those_of_spark(data, patience):
    estimator = GBTRegressor(labelCol="y", maxIter=10, maxDepth=3, stepSize=0.6, minInstancesPerNode=5, seed=5)
    found = models.cross_validate(data, estimator, 3, "y", "row_id", early_stopping_rounds=patience).models
    for i, model in enumerate(found):
        plain = estimator.fit(data.filter(F.col("fold") != i))
        if patience is not None:
            plain = models.stop_early(plain, data.filter(F.col("fold") == i), patience)
        assert model.getNumTrees == plain.getNumTrees and list(model.treeWeights) == list(plain.treeWeights)
        assert [tree_lines(t) for t in model.trees] == [tree_lines(t) for t in plain.trees]
        gap = models.with_predictions(data, [model, plain], ["p", "q"]).agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
        assert gap < 1e-9
        # Spark's prefix forgets features behind the last one that is used.
        assert model.featureImportances.size == 4
        assert all(abs(model.featureImportances[j] - v) < 1e-9 for j, v in enumerate(plain.featureImportances.toArray()))


def test_boosting_of_folds_does_not_start_spark_s_fit(data, monkeypatch):
    def fit(*_):
        raise AssertionError("a fold was fitted alone")

    monkeypatch.setattr(GBTRegressor, "fit", fit)
    monkeypatch.setattr(binned, "STORE", 2)
    monkeypatch.setattr(binned, "BLOCK_ROWS", 50)
    estimator = GBTRegressor(labelCol="y", maxIter=5, maxDepth=2, seed=5)
    result = models.cross_validate(data, estimator, 3, "y", "row_id", early_stopping_rounds=3)
    assert all(0 < m.getNumTrees <= 5 for m in result.models)
    assert {(r["fold"], r["split"]): r["n"] for r in result.fold_metrics.collect()}[0, "train"] == 600


def test_what_is_not_covered_is_left_to_spark(data):
    trees = GBTRegressor(labelCol="y", maxIter=2, maxDepth=2)
    assert binned.covers(trees, data, 3) and not binned.covers(trees, data, 1)
    for changed in ({"subsamplingRate": 0.5}, {"featureSubsetStrategy": "0.5"}, {"maxDepth": 9}, {"weightCol": "d"}):
        other = trees.copy({trees.getParam(n): v for n, v in changed.items()})
        assert not binned.covers(other, data, 3)
