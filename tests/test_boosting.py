"""Boosting for absolute loss against plain medians."""

import random
from statistics import median

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from residualkit.operators.boosting import MedianBoostedTrees, leaf_rows, loss_rows
from residualkit.operators.models import cross_validate, ensemble_predict


def frame(spark, n=600, seed=3):
    random.seed(seed)
    rows = []
    for i in range(n):
        a, b = random.randrange(2), random.randrange(2)
        rows.append((i, float(a), float(b), 3.0 * a - 2.0 * b + random.expovariate(1)))
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    return rows, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def cells(rows):
    found = {}
    for _, a, b, y in rows:
        found.setdefault((a, b), []).append(y)
    return found


@pytest.fixture(scope="module")
def boosted(spark):
    rows, df = frame(spark)
    learner = MedianBoostedTrees(labelCol="y", maxDepth=2, stepSize=0.5, holdout=0.0, storeEvery=2, rowsAtMost=100)
    return rows, df, learner, learner.start(df).more(3)


def test_leaves_are_medians_and_the_loss_falls(spark, boosted):
    rows, _, _, fit = boosted
    base, own = median(y for *_, y in rows), cells(rows)
    assert fit.base == pytest.approx(base)
    want = sorted((r, len(ys), 0.5 * (median(ys) - base) * 0.5 ** (r - 1)) for r in (1, 2, 3) for ys in own.values())
    got = sorted((r["round"], r["rows"], r["value"]) for r in leaf_rows(spark, fit).collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in sorted(got)] == pytest.approx([w[2] for w in sorted(want)])
    losses = [r.mae for r in loss_rows(spark, fit).orderBy("round").collect()]
    assert losses == sorted(losses, reverse=True) and len(set(losses)) == 3


def test_a_continued_fit_equals_a_longer_one(boosted):
    _, df, learner, fit = boosted
    longer, whole = fit.more(1), learner.start(df).more(4)
    for a, b in zip(longer.trees, whole.trees, strict=True):
        assert a.values == pytest.approx(b.values)
    assert longer.trees[:3] == fit.trees
    assert [e for e, _ in longer.losses] == pytest.approx([e for e, _ in whole.losses])


def test_predictions_and_prefix(boosted):
    rows, df, _, fit = boosted
    base, own = fit.base, {k: median(v) for k, v in cells(rows).items()}
    for count, model in ((3, fit.model()), (1, fit.model().first(1)), (0, fit.model().first(0))):
        got = {r.id: r.p for r in model.copy({model.predictionCol: "p"}).transform(df).select("id", "p").collect()}
        for i, a, b, _ in rows:
            assert got[i] == pytest.approx(own[a, b] + (base - own[a, b]) * 0.5**count)


def test_length_is_chosen_on_rows_held_out(spark):
    _, df = frame(spark, 300, seed=8)
    noise = df.withColumn("y", F.rand(5)).cache()
    learner = MedianBoostedTrees(labelCol="y", maxDepth=1, stepSize=1.0, holdout=0.3, patience=2, storeEvery=1)
    fit = learner.start(noise).more(12)
    held = [h for _, h in fit.losses]
    best = held.index(min(held)) + 1
    assert fit.model().getNumTrees == best
    assert len(held) < 12 and len(held) - best >= 2
    assert 30 < fit.rows.filter("not _fit").count() < 150
    noise.unpersist()


def test_cross_validation_takes_it_as_any_estimator(spark):
    rows, df = frame(spark, 200)
    folded = df.withColumn("fold", (F.col("id") % 2).cast("int"))
    learner = MedianBoostedTrees(maxIter=2, maxDepth=2, stepSize=1.0, holdout=0.0)
    result = cross_validate(folded, learner, 2, "y", "id")
    got = {r.id: r.prediction for r in result.oof.collect()}
    for fold in (0, 1):
        own = {k: median(v) for k, v in cells([r for r in rows if r[0] % 2 != fold]).items()}
        for i, a, b, _ in rows:
            if i % 2 == fold:
                assert got[i] == pytest.approx(own[a, b])
    assert ensemble_predict(df, result.models).filter("prediction is null").count() == 0


def test_no_labels(spark):
    _, df = frame(spark, 5)
    with pytest.raises(ValueError):
        MedianBoostedTrees(labelCol="y").start(df.withColumn("y", F.lit(None).cast("double")))
