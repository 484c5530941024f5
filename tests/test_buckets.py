"""Bucketed tables: no exchange for the property join and the history window, hot keys apart."""

import random

import pytest
from conftest import no_broadcast

from residualkit.sources.buckets import drop_bucketed, join_bucketed, number_bucketed, write_bucketed


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(3)
    rows = [(i, "hot" if random.random() < 0.3 else random.choice([None, *[f"k{j}" for j in range(2500)]]), random.random()) for i in range(4000)]
    sales = spark.createDataFrame(rows, "row long, key string, worth double").repartition(3)
    listed = spark.createDataFrame([(f"k{j}", j) for j in range(0, 2500, 2)] + [("hot", -1)], "key string, size long")
    made = write_bucketed(sales, "key", 4, ["row"]), write_bucketed(listed, "key", 4, split_heavy=False)
    yield rows, sales, *made
    for table in made:
        drop_bucketed(table, spark)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_written_apart(spark, tables):
    rows, _, sold, _ = tables
    assert "hot" in sold.heavy
    assert {r.key for r in sold.hot.select("key").distinct().collect()} == {None, *sold.heavy}
    assert sorted(r.row for r in sold.rows(spark).collect()) == [r[0] for r in rows]


def test_property_join_without_exchange(spark, tables):
    rows, _, sold, listed = tables
    joined = join_bucketed(sold, listed, spark)
    sizes = {f"k{j}": j for j in range(0, 2500, 2)} | {"hot": -1}
    assert sorted((r.row, r["size"]) for r in joined.collect()) == [(i, sizes.get(k)) for i, k, _ in rows]
    with no_broadcast(spark):
        plan = executed(join_bucketed(sold, listed, spark))
    assert "SortMergeJoin" in plan
    assert all("BroadcastExchange" in line for line in plan.split("\n") if "Exchange" in line)


def test_history_window_without_exchange(spark, tables):
    rows, _, sold, _ = tables
    numbered = number_bucketed(sold, ["row"], {"before": "worth"}, "n", spark)
    seen, want = {}, {}
    for i, k, w in rows:
        own = seen.setdefault(k, [])
        want[i] = (None, None) if k is None else (len(own) + 1, own[-1] if own else None)
        own.append(w)
    assert {r.row: (r.n, r.before) for r in numbered.collect()} == want
    plan = executed(number_bucketed(sold.__class__(sold.key, sold.buckets, sold.even, None), ["row"], {"before": "worth"}, "n", spark))
    assert "Window" in plan and "Exchange" not in plan


def test_buckets_must_match_and_may_be_empty(spark, tables):
    _, sales, sold, _ = tables
    other = write_bucketed(sales.select("key").filter("key = 'hot'").distinct(), "key", 8, split_heavy=False)
    with pytest.raises(ValueError, match="same key"):
        join_bucketed(sold, other, spark)
    empty = write_bucketed(sales.limit(0), "key", 2)
    assert empty.hot is None and empty.rows(spark).count() == 0
    drop_bucketed(other, spark)
    drop_bucketed(empty, spark)
