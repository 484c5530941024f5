import pytest
from conftest import rows
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from residualkit.operators import models
from residualkit.operators.folds import shuffled_folds
from residualkit.plans import scoring, training
from residualkit.sources.config import TrainConfig


@pytest.fixture(scope="module")
def signal(spark):
    """A target with a steep step in ``x``; ``z`` is noise and misses often."""
    df = spark.range(600).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 10).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, (F.col("id") * 7919 % 13).cast("double")).alias("z"),
        (F.col("id") % 24 + 1).cast("int").alias("month_block"),
    )
    noise = (F.col("row_id") * 104729 % 101 - 50) / 1000
    return df.withColumn("logerror", F.when(F.col("x") > 5, 0.8).otherwise(-0.4) + noise)


def test_vector_prep_fills_below_the_minimum_and_flags(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    prep = models.fit_vector_prep(df, ["a", "b"], flag_missing=True)
    assert prep.fills == {"a": 0.0, "b": -1.0}
    assert prep.names == ("a", "b", "a_missing", "b_missing")
    got = [tuple(r["features"]) for r in prep.apply(df).collect()]
    assert got == [(1.0, -1.0, 0.0, 1.0), (0.0, -1.0, 1.0, 1.0), (3.0, -1.0, 0.0, 1.0)]
    assert prep.apply(df).columns == ["a", "b", "features"]


def test_best_prefix_has_patience():
    assert models.best_prefix([5, 4, 4.5, 3, 3.5, 3.6, 1], patience=3) == 7
    assert models.best_prefix([5, 4, 4.5, 4.6, 3], patience=2) == 2
    assert models.best_prefix([1], patience=1) == 1


def test_first_trees_are_a_prefix(spark, signal):
    prep = models.fit_vector_prep(signal, ["x", "z"])
    data = prep.apply(signal)
    six = GBTRegressor(labelCol="logerror", maxIter=6, maxDepth=2, seed=1).fit(data)
    two = GBTRegressor(labelCol="logerror", maxIter=2, maxDepth=2, seed=1).fit(data)
    cut = models.first_trees(six, 2)
    assert cut.getNumTrees == 2 and six.getNumTrees == 6
    names = ["cut", "two"]
    gap = models.with_predictions(data, [cut, two], names).agg(F.max(F.abs(F.col("cut") - F.col("two")))).first()[0]
    assert gap < 1e-12
    losses = six.evaluateEachIteration(data, "absolute")
    assert models.stop_early(six, data, 1, "mae").getNumTrees == models.best_prefix(losses, 1)


def test_doubling_finds_the_same_trees_as_one_long_fit(spark, signal):
    data = models.fit_vector_prep(signal, ["x", "z"]).apply(signal)
    rows_, holdout = data.filter("row_id % 3 > 0"), data.filter("row_id % 3 = 0")
    estimator = GBTRegressor(labelCol="logerror", maxIter=20, maxDepth=2, stepSize=0.6, seed=4)
    whole = models.stop_early(estimator.fit(rows_), holdout, 1)
    grown = models.fit_with_patience(estimator, rows_, holdout, 1, first=2)
    assert grown.getNumTrees == whole.getNumTrees
    names = ["a", "b"]
    gap = models.with_predictions(holdout, [grown, whole], names).agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]
    assert gap < 1e-12


def test_fit_lengths_halve_from_the_limit():
    assert models.fit_lengths(48, 32) == [48]
    assert models.fit_lengths(64, 32) == [32, 64]
    assert models.fit_lengths(20, 2) == [3, 5, 10, 20]
    assert models.fit_lengths(2000, 400) == [500, 1000, 2000]
    assert models.fit_lengths(1, 1) == [1] and models.fit_lengths(3, 32) == [3] and models.fit_lengths(0, 32) == [0]


def test_a_limit_close_to_the_first_length_is_fitted_once(spark, signal):
    fitted = []

    class Counted(GBTRegressor):
        def fit(self, dataset, params=None):
            fitted.append(self.getMaxIter())
            return super().fit(dataset, params)

    data = models.fit_vector_prep(signal, ["x", "z"]).apply(signal)
    estimator = Counted(labelCol="logerror", maxIter=6, maxDepth=2, stepSize=0.1, seed=4)
    kept = models.fit_with_patience(estimator, data, data, 1, first=4)
    assert kept.getNumTrees == 6
    assert fitted == [6]


def test_cross_validation_covers_every_row_once_and_beats_the_median(spark, signal):
    config = TrainConfig(
        n_splits=3,
        features=("x", "z"),
        model_type="lgb",
        model_params={"learning_rate": 0.5, "max_depth": 3, "objective": "mse"},
        early_stopping_rounds=2,
        n_estimators=5,
        seed=1,
    )
    trained = training.train(signal, config, parallelism=3)
    result = trained.result
    later = signal.filter("month_block > 3")
    ids = [r[0] for r in rows(result.oof.select("row_id"))]
    assert ids == [r[0] for r in rows(later.select("row_id"))]
    assert len(result.models) == 3
    metrics = {(r["fold"], r["split"]): r for r in result.fold_metrics.collect()}
    assert set(metrics) == {(i, s) for i in range(3) for s in ("train", "valid")}
    assert sum(metrics[i, "valid"]["n"] for i in range(3)) == len(ids)
    median = later.select(F.percentile("logerror", 0.5)).first()[0]
    baseline = later.agg(F.avg(F.abs(F.col("logerror") - median))).first()[0]
    assert all(metrics[i, "valid"]["mae"] < baseline / 2 for i in range(3))
    importance = {(r["feature"], r["fold"]): r["importance"] for r in result.importance.collect()}
    assert len(importance) == 6 and all(importance["x", i] > importance["z", i] for i in range(3))
    again = training.train(signal, config)
    assert rows(again.result.oof.select("row_id", F.round("prediction", 9))) == rows(
        result.oof.select("row_id", F.round("prediction", 9))
    )


def test_any_estimator_and_group_folds(spark, signal):
    config = TrainConfig(n_splits=2, features=("x",), model_type="own", seed=1)
    for estimator in (LinearRegression(), RandomForestRegressor(numTrees=2, maxDepth=2, seed=1)):
        trained = training.train(signal, config, estimator=estimator, groups="x")
        folds = trained.result.oof.join(signal.select("row_id", "x"), "row_id").groupBy("x")
        assert folds.agg(F.countDistinct("fold").alias("n")).agg(F.max("n")).first()[0] == 1
    with pytest.raises(ValueError, match="estimator"):
        training.estimator_for(config)


def test_target_is_clipped_before_training(spark, signal):
    config = TrainConfig(n_splits=2, features=("x",), seed=1)
    wild = signal.withColumn("logerror", F.col("logerror") * 100)
    trained = training.train(wild, config, estimator=LinearRegression())
    low, high = trained.result.oof.agg(F.min("logerror"), F.max("logerror")).first()
    assert (low, high) == (-1.0, 1.0)


def test_configuration_parameters_reach_spark():
    params = {"learning_rate": 0.05, "max_depth": 4, "feature_fraction": 0.5, "objective": "mae", "min_child_samples": 9}
    made = training.estimator_for(TrainConfig(n_splits=5, features=("x",), model_type="xgb", model_params=params, n_estimators=7, seed=3))
    assert (made.getStepSize(), made.getMaxDepth(), made.getFeatureSubsetStrategy()) == (0.05, 4, "0.5")
    assert (made.getLossType(), made.getMinInstancesPerNode(), made.getMaxIter(), made.getSeed()) == ("absolute", 9, 7, 3)


def test_ensemble_is_the_mean_of_its_models(spark, signal):
    prep = models.fit_vector_prep(signal, ["x"])
    data = prep.apply(shuffled_folds(signal, "row_id", 2, 1))
    result = models.cross_validate(data, LinearRegression(), 2, "logerror", "row_id")
    both = models.with_predictions(data, result.models, ["a", "b"])
    gap = models.ensemble_predict(both, result.models).agg(
        F.max(F.abs(F.col("prediction") - (F.col("a") + F.col("b")) / 2))
    )
    assert gap.first()[0] < 1e-12
    with pytest.raises(ValueError, match="at least one"):
        models.ensemble_predict(data, [])


def test_blend_finds_the_weights(spark, signal):
    made = signal.select("x", F.coalesce("z", F.lit(2.0)).alias("z")).withColumn("y", 3 * F.col("x") - F.col("z") + 5)
    blend = models.fit_blend(made, ["x", "z"], "y")
    assert blend.coefficients == (pytest.approx(3), pytest.approx(-1)) and blend.intercept == pytest.approx(5)
    assert blend.apply(made).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1e-6


def test_horizon_rows_take_their_month(spark):
    df = spark.createDataFrame([(1, 5, 6, "s")], "k long, prev_month_10 int, prev_month_11 int, shared string")
    got = scoring.horizon_rows(df, 2017, (10, 11), 2016)
    assert got.columns == ["k", "shared", "year", "month", "month_block", "yyyymm", "prev_month"]
    assert rows(got, "month") == [(1, "s", 2017, 10, 22, "201710", 5), (1, "s", 2017, 11, 23, "201711", 6)]


def test_submission_joins_by_key(spark):
    a = spark.createDataFrame([(1, "201610", 0.12345), (2, "201610", 0.5)], "k long, yyyymm string, prediction double")
    b = spark.createDataFrame([(2, "201710", -0.00004)], "k long, yyyymm string, prediction double")
    got = scoring.submission([a, b], "k", ["201610", "201710"])
    assert got.columns == ["k", "201610", "201710"]
    assert rows(got, "k")[0][:2] == (1, pytest.approx(0.1234, abs=1e-12))
    assert rows(got, "k")[1][1:] == (0.5, 0.0)
    with pytest.raises(Exception, match="unlisted period: 201710"):
        scoring.submission([a, b], "k", ["201610"]).collect()


def test_submission_takes_one_shuffle_and_keeps_missing_predictions(spark):
    schema = "k long, yyyymm string, prediction double"
    a = spark.createDataFrame([(1, "201610", 0.00125), (2, "201610", None), (None, "201610", 0.5)], schema)
    b = spark.createDataFrame([(1, "201710", -0.5), (2, "201710", float("nan")), (1, "201710", None)], schema)
    got = scoring.submission([a, b], "k", ["201610", "201612", "201710"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    found = {r["k"]: tuple(r)[1:] for r in got.collect()}
    assert found[1] == (0.0012, None, -0.5) and found[None] == (0.5, None, None)
    assert found[2][:2] == (None, None) and found[2][2] != found[2][2]
