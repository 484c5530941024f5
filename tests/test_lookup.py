import random

import pytest
from conftest import no_broadcast, rows, settings
from pyspark.sql import functions as F

from residualkit.operators import lookup


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, another third has no key."""
    random.seed(5)
    keys = [1] * 300 + [None] * 300 + [random.randrange(2, 200) for _ in range(300)]
    left = spark.createDataFrame(list(enumerate(keys)), "id long, k long")
    right = spark.createDataFrame([(k, f"v{k}", k * 0.5) for k in range(1, 150)], "k long, v string, w double")
    return left, right


def test_broadcast_limit_units(spark):
    for text, expected in (("10485760b", 10485760), ("10MB", 10 << 20), ("2k", 2048), ("1g", 1 << 30), ("-1", -1), ("512", 512)):
        with settings(spark, spark__sql__autoBroadcastJoinThreshold=text):
            assert lookup.broadcast_limit(spark) == expected


def test_heavy_keys_are_those_with_a_share(skewed):
    left, _ = skewed
    heavy = lookup.heavy_keys(left, ["k"], share=9)
    assert {r[0] for r in heavy} == {1, None}
    assert lookup.heavy_keys(left.select("id"), ["id"]) == []
    assert lookup.heavy_keys(left.limit(0), ["k"]) == []


def test_heavy_keys_of_several_sets_come_from_one_pass(spark, skewed):
    left, _ = skewed
    both = left.withColumn("p", F.col("id") % 2)
    single, pair, other = lookup.heavy_keys_of(both, [["k"], ["k", "p"], ["id"]], share=9)
    assert {tuple(r) for r in single} == {(1,), (None,)}
    assert {tuple(r) for r in pair} == {(1, 0), (1, 1), (None, 0), (None, 1)}
    assert other == []


@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, skewed, null_safe):
    left, right = skewed
    if null_safe:
        right = right.union(spark.createDataFrame([(None, "none", 0.0)], right.schema))
    plain = lookup.left_join(left, right, ["k"], null_safe)
    with no_broadcast(spark):
        salted = lookup.keyed_join(left, right, ["k"], null_safe)
    assert salted.columns == plain.columns
    assert rows(salted, "id") == rows(plain, "id")


def test_lookup_join_same_result_on_both_ways(spark, skewed):
    left, right = skewed
    small = lookup.lookup_join(left, right, ["k"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    with no_broadcast(spark):
        large = lookup.lookup_join(left, right, ["k"])
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert rows(large, "id") == rows(small, "id")


def test_table_bytes_counts_texts_and_arrays(spark):
    short = spark.createDataFrame([(1, "a", [1.0])], "k long, s string, a array<double>")
    long = spark.createDataFrame([(1, "a" * 1000, [1.0] * 100)], "k long, s string, a array<double>")
    assert lookup.table_bytes(long) - lookup.table_bytes(short) == 999 + 99 * 9


@pytest.mark.parametrize("null_safe", [False, True])
def test_rows_of_hot_keys_are_answered_apart(spark, null_safe):
    left = [(i, "hot" if i % 3 else (None if i % 2 else f"k{i}")) for i in range(300)]
    df = spark.createDataFrame(left, "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2), ("k6", 3), (None, 4)], "k string, v int")
    with no_broadcast(spark):
        got = lookup.keyed_join(df, table, ["k"], null_safe, apart=True)
        plan = got._jdf.queryExecution().executedPlan().toString()
        values = dict(table.collect())
        want = [(i, k, values.get(k) if k is not None or null_safe else None) for i, k in left]
        assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    # Only the light rows, and their side of the table, are exchanged.
    assert plan.count("Exchange hashpartitioning") == 2
