"""Ridge regression from moments, balanced group folds and permutation importance, against numpy and plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from residualkit.operators.folds import fit_balanced_folds
from residualkit.operators.importance import bijection, permutation_importance, permuted_features
from residualkit.operators.moments import Line, cross_validate_ridge, fold_moments


def data(n=300, k=4, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 3)) * [1, 10, 0.1] + [1e6, 0, 5]
    y = x @ [0.5, -0.2, 3] + rng.standard_normal(n)
    return x, y, rng.integers(0, k, n)


def frame(spark, x, y, folds):
    rows = [(i, *map(float, x[i]), float(y[i]), int(folds[i])) for i in range(len(y))]
    rows += [(9000, None, 1.0, 1.0, 2.0, 0), (9001, 1.0, 1.0, 1.0, None, 1)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, fold int")


def solved(x, y, penalty):
    m, centred = x.mean(0), x - x.mean(0)
    w = np.linalg.solve(centred.T @ centred / len(y) + penalty * np.eye(3), centred.T @ (y - y.mean()) / len(y))
    return w, y.mean() - w @ m


def test_every_fold_and_penalty_from_one_pass(spark, monkeypatch):
    monkeypatch.setattr("residualkit.operators.moments.AGGREGATES", 5)
    x, y, folds = data()
    df = frame(spark, x, y, folds)
    found = cross_validate_ridge(df, ["a", "b", "c"], "y", "fold", 4, [0.0, 0.3])
    totals = []
    for i, penalty in enumerate((0.0, 0.3)):
        totals.append(0)
        for f in range(4):
            w, base = solved(x[folds != f], y[folds != f], penalty)
            assert found.lines[i][f].coefficients == pytest.approx(w, rel=1e-6)
            assert found.lines[i][f].intercept == pytest.approx(base, rel=1e-6)
            error = (y[folds == f] - x[folds == f] @ w - base) ** 2
            assert found.valid_error[i][f] == pytest.approx(error.mean(), rel=1e-5)
            totals[i] += error.sum()
    assert found.best() == int(np.argmin(totals))
    oof = {r.id: r.prediction for r in found.out_of_fold(df, "fold", 0).collect()}
    w, base = solved(x[folds != folds[7]], y[folds != folds[7]], 0.0)
    assert oof[7] == pytest.approx(x[7] @ w + base, rel=1e-9) and oof[9000] is None


def test_moments_of_empty_folds_and_dependent_features(spark):
    df = spark.createDataFrame([(i, float(i), 2.0 * i, 3.0 * i + 1, i % 2) for i in range(20)], "id long, a double, b double, y double, fold int")
    found = cross_validate_ridge(df, ["a", "b"], "y", "fold", 3)
    assert found.sizes == (10, 10, 0) and found.valid_error[0][2] is None
    assert found.valid_error[0][0] == pytest.approx(0, abs=1e-9)
    with pytest.raises(ValueError):
        cross_validate_ridge(df.limit(0), ["a"], "y", "fold", 2)
    with pytest.raises(Exception, match="fold must be 0 to 0"):
        fold_moments(df, ["a"], "y", "fold", 1)


def test_balanced_folds_keep_groups_whole(spark):
    random.seed(1)
    rows = [(i, random.choice(["hot"] * 3 + [f"g{j}" for j in range(30)])) for i in range(900)] + [(1000 + i, None) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, g string")
    folds = fit_balanced_folds(df, "g", 4, seed=3, row_key="id", buckets=64)
    got = folds.apply(df, row_key="id").collect()
    by_group, sizes = {}, [0] * 4
    for r in got:
        by_group.setdefault(r.g if r.g is not None else r.id, set()).add(r.fold)
        sizes[r.fold] += 1
    assert all(len(f) == 1 for f in by_group.values())
    assert tuple(sizes) == folds.sizes and max(sizes) - min(sizes) <= folds.largest
    assert len({next(iter(by_group[i])) for i in range(1000, 1100)}) > 1
    with pytest.raises(Exception, match="name a row_key"):
        fit_balanced_folds(df, "g", 4, seed=3)


def test_few_rows_in_balanced_folds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, g string")
    folds = fit_balanced_folds(df, "g", 3, seed=0)
    assert {r.fold for r in folds.apply(df).collect()} == {0, 1}
    assert fit_balanced_folds(df.limit(0), "g", 3, seed=0).sizes == (0, 0, 0)


@pytest.mark.parametrize("n", [1, 2, 97, 1000])
def test_bijections_hit_every_position(n):
    for i in range(3):
        factor, offset = bijection(n, 5, i)
        assert sorted((factor * p + offset) % n for p in range(n)) == list(range(n))


def test_permuted_columns_and_importance(spark):
    x, y, folds = data(200)
    df = frame(spark, x, y, folds).filter("id < 9000")
    line = Line(("a", "b", "c"), (0.5, -0.2, 3.0), 0.0)
    moved = {r["_position"]: r for r in permuted_features(df, ["a", "b"], ["id"], 4).collect()}
    for i in range(2):
        factor, offset = bijection(200, 4, i)
        assert all(moved[(factor * p + offset) % 200][f"_permuted_{i}"] == x[p, i] for p in range(200))
    got = {r.feature: r for r in permutation_importance(df, lambda d, name: line.apply(d, name), ["a", "b", "c"], "y", ["id"], 4, "mse").collect()}
    base = np.mean((y - x @ [0.5, -0.2, 3]) ** 2)
    for i, c in enumerate("abc"):
        factor, offset = bijection(200, 4, i)
        swapped = x.copy()
        swapped[(factor * np.arange(200) + offset) % 200, i] = x[:, i]
        worse = np.mean((y - swapped @ [0.5, -0.2, 3]) ** 2)
        assert got[c].loss == pytest.approx(base, rel=1e-6)
        assert got[c].permuted_loss == pytest.approx(worse, rel=1e-6)
    assert got["b"].importance > got["c"].importance
    nothing = permutation_importance(df.limit(0), lambda d, name: line.apply(d, name), ["a"], "y", ["id"]).collect()
    assert nothing[0].importance is None
    with pytest.raises(ValueError):
        permutation_importance(df, lambda d, name: d, ["a"], "y", ["id"], loss="rmse")
