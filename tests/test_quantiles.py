"""Exact quantiles against numpy, with and without brackets."""

import random

import numpy as np
import pytest
from conftest import no_broadcast

from residualkit.operators.quantiles import exact_quantiles, quantile_profile, trim_to_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def frame(spark):
    random.seed(4)
    rows = [("hot", random.gauss(0, 1)) for _ in range(3000)]
    rows += [("ties", float(random.choice([1, 1, 1, 2, 5]))) for _ in range(900)]
    rows += [("few", float(i)) for i in range(4)] + [("one", 2.5), (None, 3.0), (None, 4.0), ("empty", None), ("hot", None)]
    random.shuffle(rows)
    return rows, spark.createDataFrame(rows, "kind string, amount double").repartition(5)


def expected(rows):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    return {k: (len(v), np.quantile(v, PROBABILITIES)) for k, v in groups.items()}


@pytest.mark.parametrize("rows_at_most", [1 << 20, 50])
def test_groups_equal_numpy(spark, rows_at_most):
    rows, df = frame(spark)
    want = expected(rows)
    got = {r.kind: (r.n, r.quantiles) for r in exact_quantiles(df, ["kind"], "amount", PROBABILITIES, rows_at_most).collect()}
    assert got.keys() == want.keys()
    for k, (n, values) in want.items():
        assert got[k][0] == n
        assert got[k][1] == pytest.approx(values.tolist(), abs=1e-12), k


def test_brackets_without_broadcast_and_without_groups(spark):
    rows, df = frame(spark)
    values = [v for _, v in rows if v is not None]
    with no_broadcast(spark):
        got = exact_quantiles(df, [], "amount", PROBABILITIES, 100).collect()
    assert len(got) == 1 and got[0].n == len(values)
    assert got[0].quantiles == pytest.approx(np.quantile(values, PROBABILITIES).tolist(), abs=1e-12)


def test_nothing_and_wrong_probabilities(spark):
    df = spark.createDataFrame([(None,)], "amount double")
    assert exact_quantiles(df, [], "amount", [0.5]).count() == 0
    assert trim_to_quantiles(df, "amount", 0.1, 0.9).count() == 0
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "amount", [1.5])


@pytest.mark.parametrize("groups", [[], ["kind"]])
def test_trim_and_profile(spark, groups):
    rows, df = frame(spark)
    keyed = {}
    for k, v in rows:
        if v is not None:
            keyed.setdefault(k if groups else "", []).append(v)
    want = sorted(v for own in keyed.values() for lo, hi in [np.quantile(own, [0.1, 0.9])] for v in own if lo <= v <= hi)
    assert sorted(r.amount for r in trim_to_quantiles(df, "amount", 0.1, 0.9, groups, 200).collect()) == want
    profile = quantile_profile(df, "amount", [0.5], groups).collect()
    assert {r.n for r in profile} == {len(v) for v in keyed.values()}
