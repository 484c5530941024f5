import random

import pytest
from conftest import no_broadcast, rows
from pyspark.sql import functions as F

from residualkit.operators.folds import contiguous_folds
from residualkit.operators.group_stats import fit_group_stats
from residualkit.operators.target_encoding import fit_target_encodings


def test_group_stats_values(spark):
    data = [(1, "a", "u", 1.0), (2, "a", "v", 3.0), (3, "a", "v", None), (4, None, "u", 5.0), (5, "z", None, 0.0)]
    df = spark.createDataFrame(data, "id long, k string, j string, x double")
    got = fit_group_stats(df, [["k"], ["k", "j"]], ["x"]).apply(df)
    assert got.columns[4:] == ["k_x_mean", "k_x_dif", "k_x_ratio", "k_j_x_mean", "k_j_x_dif", "k_j_x_ratio"]
    assert [r[4:] for r in rows(got, "id")] == [
        (2.0, 1.0, 0.5, 1.0, 0.0, 0.0),
        (2.0, -1.0, -0.5, 3.0, 0.0, 0.0),
        (2.0, None, None, 3.0, None, None),
        (None, None, None, None, None, None),
        (0.0, 0.0, None, None, None, None),
    ]


def test_group_stats_come_from_the_base_frame_and_its_year(spark):
    base = spark.createDataFrame([(2016, "a", 1.0), (2016, "a", 3.0), (2017, "a", 10.0)], "y int, k string, x double")
    sale = spark.createDataFrame([(2016, "a", 0.0), (2017, "a", 0.0), (2018, "a", 0.0)], "y int, k string, x double")
    got = fit_group_stats(base, [["k"]], ["x"], within=["y"]).apply(sale)
    assert [r["k_x_mean"] for r in sorted(got.collect())] == [2.0, 10.0, None]


def test_full_statistic_set_is_one_aggregation_and_broadcast_joins(spark):
    keys = ["a", "b", "c", "d", "e", "f"]
    df = spark.range(200).select(
        "id",
        *[(F.col("id") % (i + 2)).alias(k) for i, k in enumerate(keys)],
        *[(F.col("id") * (i + 1)).cast("double").alias(f"v{i}") for i in range(8)],
    )
    sets = [[k] for k in keys[:4]] + [[k, j] for k in keys[:4] for j in keys[4:]]
    stats = fit_group_stats(df, sets, [f"v{i}" for i in range(8)])
    got = stats.apply(df)
    assert len(got.columns) == len(df.columns) + 288
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 12
    assert "Aggregate" not in plan and "hashpartitioning" not in plan and "PythonUDF" not in plan
    with no_broadcast(spark):
        few = fit_group_stats(df, [["a"], ["b", "e"]], ["v0"]).apply(df)
        expected = got.select(few.columns)
        assert rows(few, "id") == rows(expected, "id")


@pytest.fixture
def encoded(spark):
    random.seed(11)
    data = [
        (i, random.randrange(4), random.choice(["p", "q", None]), None if i % 13 == 0 else random.gauss(0, 1), i % 5)
        for i in range(300)
    ]
    data += [(1000, 99, "only", 5.0, 2)]
    return spark.createDataFrame(data, "id long, a int, b string, y double, fold int"), data


def direct_mean(data, keep):
    values = [r[3] for r in data if keep(r) and r[3] is not None]
    return sum(values) / len(values) if values else None


def test_out_of_fold_means_equal_the_direct_means(encoded):
    df, data = encoded
    pair, single = fit_target_encodings(df, [("a", "b"), "b"], "y", "fold", 5)
    assert (pair.name, single.name) == ("a_b_y_enc", "b_y_enc")
    got = single.apply_train(pair.apply_train(df, "fold"), "fold")
    for r, values in zip(rows(got, "id"), sorted(data), strict=True):
        _, a, b, _, fold = values
        expected = direct_mean(data, lambda o: o[4] != fold and (o[1], o[2]) == (a, b))
        assert r[5] == (None if expected is None else pytest.approx(expected))
        expected = None if b is None else direct_mean(data, lambda o: o[4] != fold and o[2] == b)
        assert r[6] == (None if expected is None else pytest.approx(expected))


def test_own_fold_never_enters(encoded):
    df, _ = encoded
    changed = df.withColumn("y", F.when(F.col("fold") == 3, F.col("y") * 1000 + 7).otherwise(F.col("y")))
    before = fit_target_encodings(df, ["b"], "y", "fold", 5)[0].apply_train(df, "fold")
    after = fit_target_encodings(changed, ["b"], "y", "fold", 5)[0].apply_train(changed, "fold")
    assert rows(before.filter("fold = 3").select("id", "b_y_enc")) == rows(after.filter("fold = 3").select("id", "b_y_enc"))


def test_applied_means_fall_back_to_the_global_mean(spark, encoded):
    df, data = encoded
    pair, single = fit_target_encodings(df, [("a", "b"), "b"], "y", "fold", 5)
    keys = spark.createDataFrame([(1, 0, None), (2, 99, "only"), (3, 5, "unseen")], "id long, a int, b string")
    got = rows(single.apply(pair.apply(keys)), "id")
    overall = direct_mean(data, lambda o: True)
    assert got[0][3] == pytest.approx(direct_mean(data, lambda o: o[1] == 0 and o[2] is None))
    assert got[0][4] == pytest.approx(overall)
    assert got[1][3] == pytest.approx(5.0)
    assert got[2][3:] == (pytest.approx(overall), pytest.approx(overall))


def test_encoding_by_shuffle_join_is_the_same(spark, encoded):
    df, _ = encoded
    df = contiguous_folds(df.drop("fold"), 5, ["id"])
    small = fit_target_encodings(df, [("a", "b")], "y", "fold", 5)[0].apply_train(df, "fold")
    with no_broadcast(spark):
        large = fit_target_encodings(df, [("a", "b")], "y", "fold", 5)[0].apply_train(df, "fold")
        assert rows(small, "id") == rows(large, "id")
