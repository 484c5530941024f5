import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from residualkit.operators import metrics, profile


@pytest.mark.parametrize(
    ("low", "high", "expected"),
    [
        (0, 126, "tinyint"),
        (0, 127, "smallint"),
        (-127, 0, "tinyint"),
        (-128, 0, "smallint"),
        (0, 32767, "int"),
        (0, 2**31 - 1, "bigint"),
        (-(2**63), 2**63 - 1, "bigint"),
    ],
)
def test_narrow_type_limits_are_strict(low, high, expected):
    assert profile.narrow_type(low, high) == expected


def test_narrow_types_lose_nothing(spark):
    df = spark.createDataFrame([(1, 5, 70000, None, 0.5), (2, -5, 3, None, None)], "id long, a long, b long, c int, x double")
    narrow = profile.narrow_types(df, keep=["id"])
    assert dict(narrow.dtypes) == {"id": "bigint", "a": "tinyint", "b": "int", "c": "int", "x": "double"}
    assert rows(narrow, "id") == rows(df, "id")


def test_target_profile_and_histogram(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (-0.1,), (5.0,), (None,)], "y double")
    row = profile.target_profile(df, "y").first()
    assert (row["n"], row["share_inside"], row["low"], row["high"]) == (5, 0.6, -0.1, 5.0)
    got = rows(profile.target_histogram(df, "y", -0.25, 0.25, 2), "bucket")
    assert got == [(1, 1), (2, 3), (3, 1)]
    assert sorted(r[0] for r in profile.trim(df, "y", 0.2).collect()) == [-0.1, 0.0, 0.1, 0.2]


def test_skew_profile(spark):
    df = spark.createDataFrame([(float(x), float(-x)) for x in (1, 1, 1, 10)], "a double, b double")
    got = dict(map(tuple, profile.skew_profile(df, ["a", "b"]).collect()))
    assert got["a"] == pytest.approx(1.1547, abs=1e-4) and got["b"] == pytest.approx(-got["a"])


def test_metrics_by_fold_and_summary(spark):
    data = [(0, 1.0, 2.0), (0, 1.0, -1.0), (1, 0.0, 3.0), (1, None, 3.0), (1, 1.0, None)]
    df = spark.createDataFrame(data, "fold int, y double, prediction double")
    got = rows(metrics.regression_metrics(df, "y", by=["fold"]), "fold")
    assert got == [(0, 2, 1.5, 2.5, math.sqrt(2.5)), (1, 1, 3.0, 9.0, 3.0)]
    table = metrics.regression_metrics(df, "y", by=["fold"]).withColumn("split", F.lit("valid"))
    assert rows(metrics.fold_summary(table, "mae")) == [("valid", 2.25, 0.75)]
    with pytest.raises(ValueError, match="metric"):
        metrics.fold_summary(table, "r2")


def test_score_sold_only_ignores_unsold_and_keeps_repeats(spark):
    predictions = spark.createDataFrame([(1, 10, 0.0), (2, 10, 1.0), (3, 10, 9.0)], "k long, m int, prediction double")
    actuals = spark.createDataFrame([(1, 10, 1.0), (1, 10, 3.0), (2, 10, 1.0), (2, 11, 5.0), (8, 10, 7.0)], "k long, m int, y double")
    row = metrics.score_sold_only(predictions, actuals, ["k", "m"], "y").first()
    assert (row["n"], row["mae"]) == (3, pytest.approx(4 / 3))


def test_top_features(spark):
    data = [("a", 0.5, 0), ("a", 0.7, 1), ("b", 0.1, 0), ("b", 0.3, 1), ("c", 0.4, 0), ("c", 0.3, 1)]
    table = spark.createDataFrame(data, "feature string, importance double, fold int")
    assert dict(map(tuple, metrics.mean_importance(table).collect()))["a"] == pytest.approx(0.6)
    assert {r["feature"] for r in metrics.top_features(table, 2).collect()} == {"a", "c"}
    assert metrics.top_features(table, 2).count() == 4
