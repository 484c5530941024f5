"""Deduplication against the last kept sale, packed orders, and blends with constrained weights."""

import datetime
import itertools
import random

import numpy as np
import pytest
from conftest import many_blocks, no_broadcast
from pyspark.sql import functions as F

from residualkit.operators.history import asof_history, keep_spaced, packed_order
from residualkit.operators.models import blend_predictions, fit_simplex_blend, join_predictions, simplex_weights

DAY = datetime.date(2016, 1, 1)


def spaced(rows, days):
    kept = []
    groups = {}
    for i, key, day in rows:
        if key is None or day is None:
            kept.append(i)
        else:
            groups.setdefault(key, []).append((day, i))
    for own in groups.values():
        last = None
        for day, i in sorted(own):
            if last is None or day - last > days:
                kept.append(i)
                last = day
    return sorted(kept)


def sales(spark, rows):
    data = [(i, k, None if d is None else DAY + datetime.timedelta(d), i) for i, k, d in rows]
    return spark.createDataFrame(data, "row long, key string, dt date, _key long").repartition(4)


def test_dropped_sales_do_not_count(spark):
    rows = [(i, "a", d) for i, d in enumerate((0, 20, 40, 60))]
    assert sorted(r.row for r in keep_spaced(sales(spark, rows), "key", "dt", ["dt", "row"]).collect()) == [0, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_spaced_sales_equal_a_plain_walk(spark, seed):
    random.seed(seed)
    rows = [(i, "hot", random.randrange(3000)) for i in range(600)]
    rows += [(1000 + i, random.choice([None, *"abcdefgh"]), random.choice([None, *range(200)])) for i in range(300)]
    rows += [(5000 + i, "daily", i) for i in range(500)] + [(6000 + i, "same", 7) for i in range(20)]
    with many_blocks(spark), no_broadcast(spark):
        got = keep_spaced(sales(spark, rows), "key", "dt", ["dt", "row"], days=10).collect()
    assert sorted(r.row for r in got) == spaced(rows, 10)
    assert got[0].asDict().keys() == {"row", "key", "dt", "_key"}


def test_spaced_needs_an_order_by_date(spark):
    df = sales(spark, [(1, "a", 1)])
    with pytest.raises(ValueError):
        keep_spaced(df, "key", "dt", ["row"])
    assert keep_spaced(df.limit(0), "key", "dt", ["dt", "row"]).count() == 0
    assert keep_spaced(df, "key", "dt", ["dt", "row"], reasonable=F.col("row") > 1).count() == 0


def test_packed_order_is_the_order_of_the_columns(spark):
    days = [None, datetime.date(1901, 1, 1), datetime.date(1969, 12, 31), datetime.date(2016, 2, 29), datetime.date(9999, 1, 1)]
    longs = [None, -(2**63), -1, 0, 1, 2**63 - 1]
    rows = list(itertools.product(days, longs))
    df = spark.createDataFrame(rows, "dt date, n long")
    got = df.withColumn("p", packed_order(df, ["dt", "n"])).orderBy("p").collect()
    key = lambda r: tuple((v is not None, v or 0) if not isinstance(v, datetime.date) else (True, v.toordinal()) for v in r)
    assert [(r.dt, r.n) for r in got] == sorted(rows, key=key)
    assert packed_order(df.withColumn("t", F.lit("x")), ["dt", "t"]) is None
    assert packed_order(df.withColumn("m", F.col("n")), ["n", "m"]) is None


def test_last_sales_by_two_columns_need_no_sort(spark):
    df = sales(spark, [(i, "ab"[i % 2], i) for i in range(9)]).withColumns({"month_block": F.col("row").cast("int"), "logerror": F.rand(1)})
    plan = asof_history(df.select("key").distinct(), df, "key", [3, 6], ["dt", "row"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("seed", range(6))
def test_weights_are_optimal(seed):
    rng = np.random.default_rng(seed)
    n = 2 + seed % 5
    errors = rng.standard_normal((200, n)) @ rng.standard_normal((n, n)) + rng.standard_normal(n)
    if seed == 5:
        errors[:, 1] = errors[:, 0]
    gram = errors.T @ errors / len(errors)
    w = np.array(simplex_weights(gram.tolist(), [0.0] * n))
    assert w.min() >= 0 and w.sum() == pytest.approx(1)
    slope = gram @ w
    level = float(w @ slope)
    assert np.all(slope >= level - 1e-9)
    assert np.allclose(slope[w > 0], level)


def test_blend_by_key(spark):
    rng = np.random.default_rng(3)
    y = rng.standard_normal(300)
    columns = {"a": y + rng.standard_normal(300), "b": y + rng.standard_normal(300) * 0.7, "bad": y * 0 + 50.0}
    frames = {n: spark.createDataFrame([(i, float(v)) for i, v in enumerate(p) if i != 7 or n != "a"], "id long, prediction double") for n, p in columns.items()}
    truth = spark.createDataFrame([(i, float(v) if i != 9 else None) for i, v in enumerate(y)], "id long, y double")
    weights = fit_simplex_blend(frames, truth, "id", "y")
    keep = [i for i in range(300) if i not in (7, 9)]
    e = np.stack([columns[n][keep] - y[keep] for n in columns], axis=1)
    g = e.T @ e / len(keep)
    wa = (g[1, 1] - g[0, 1]) / (g[0, 0] + g[1, 1] - 2 * g[0, 1])
    assert weights.coefficients == pytest.approx((wa, 1 - wa, 0.0), abs=1e-9)
    got = {r.id: r.prediction for r in blend_predictions(weights, frames, ["id"]).collect()}
    assert got[7] is None and got[3] == pytest.approx(wa * columns["a"][3] + (1 - wa) * columns["b"][3])


def test_a_model_predicts_a_key_once(spark):
    one = spark.createDataFrame([(1, 0.5), (1, 0.6)], "id long, prediction double")
    with pytest.raises(Exception, match="two predictions by one model for 1"):
        join_predictions({"m": one}, ["id"]).collect()
    with pytest.raises(ValueError):
        fit_simplex_blend({"m": one.limit(0)}, one.withColumnRenamed("prediction", "y"), "id", "y")
