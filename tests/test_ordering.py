import random

import pytest
from conftest import many_blocks, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from residualkit.operators import folds, ordering


@pytest.fixture
def shuffled_sales(spark):
    """One key holds a third of the rows; some rows have no key, some no target."""
    random.seed(3)
    data = []
    for i in range(600):
        key = 7 if i % 3 == 0 else random.choice([None, *range(1, 60)])
        data.append((i, key, random.randrange(20), None if i % 11 == 0 else random.random()))
    random.shuffle(data)
    return spark.createDataFrame(data, "id long, k long, day int, y double").repartition(7)


def test_row_index_is_the_sorted_position(spark, shuffled_sales):
    with many_blocks(spark):
        got = ordering.row_index(shuffled_sales, ["day", "id"]).select("row_index", "day", "id")
        data = rows(got, "row_index")
    assert [r[0] for r in data] == list(range(600))
    assert [r[1:] for r in data] == sorted(r[1:] for r in data)


def test_blocks_are_several(spark, shuffled_sales):
    with many_blocks(spark):
        blocks = ordering.ordered_blocks(shuffled_sales, ["k", "day", "id"])
        assert len(ordering.block_starts(blocks)) > 2
        assert blocks.filter("k = 7").select("_block").distinct().count() > 1


def test_number_and_previous_equals_windows(spark, shuffled_sales):
    w = Window.partitionBy("k").orderBy("day", "id")
    expected = shuffled_sales.filter("k is not null").select(
        "id", F.row_number().over(w).cast("long"), F.lag("y").over(w), F.lag("day").over(w)
    )
    with many_blocks(spark):
        got = ordering.number_and_previous(
            shuffled_sales, "k", ["day", "id"], {"before": "y", "day_before": "day"}, "n"
        )
        data = rows(got.filter("k is not null").select("id", "n", "before", "day_before"), "id")
        unkeyed = got.filter("k is null").select("n", "before", "day_before").distinct().collect()
        assert got.count() == 600
    assert data == rows(expected, "id")
    assert [tuple(r) for r in unkeyed] == [(None, None, None)]


def test_order_is_demanded(shuffled_sales):
    with pytest.raises(ValueError, match="order"):
        ordering.ordered_blocks(shuffled_sales, [])
    with pytest.raises(ValueError, match="nothing"):
        ordering.ordered_blocks(shuffled_sales, ["nothing"])


@pytest.mark.parametrize("n", [3, 7, 10, 23, 101])
def test_contiguous_fold_sizes(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 1009).alias("at"), "id")
    with many_blocks(spark):
        got = folds.contiguous_folds(df, 5, ["at", "id"])
        ordered = [r["fold"] for r in sorted(got.collect(), key=lambda r: (r["at"], r["id"]))]
    sizes = [n // 5 + (1 if i < n % 5 else 0) for i in range(5)]
    assert ordered == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_contiguous_folds_refuse_ties_at_a_cut(spark):
    df = spark.createDataFrame([(1,)] * 10, "d int")
    with pytest.raises(ValueError, match="total order"):
        folds.contiguous_folds(df, 5, ["d"])


def test_contiguous_folds_with_missing_order_values(spark):
    df = spark.createDataFrame([(None, i) for i in range(6)] + [(1, i) for i in range(4)], "d int, id long")
    got = folds.contiguous_folds(df, 2, ["d", "id"])
    first = {(r["d"], r["id"]) for r in got.collect() if r["fold"] == 0}
    assert first == {(None, i) for i in range(5)}


def test_folds_do_not_depend_on_partitioning(spark, shuffled_sales):
    for make in (
        lambda df: folds.contiguous_folds(df, 4, ["day", "id"]),
        lambda df: folds.shuffled_folds(df, "id", 4, 1),
        lambda df: folds.shuffled_folds(df, "id", 4, 1, exact=True),
        lambda df: folds.group_folds(df, "k", 4, 1, row_key="id"),
    ):
        a = rows(make(shuffled_sales).select("id", "fold"), "id")
        assert a == rows(make(shuffled_sales.repartition(3)).select("id", "fold"), "id")
        assert {f for _, f in a} <= {0, 1, 2, 3}


def test_exact_shuffle_sizes_and_group_integrity(spark, shuffled_sales):
    exact = folds.shuffled_folds(shuffled_sales, "id", 7, 1, exact=True).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in exact) == [85, 85, 86, 86, 86, 86, 86]
    spread = folds.group_folds(shuffled_sales.filter("k is not null"), "k", 5, 1).groupBy("k").agg(F.countDistinct("fold").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1


def test_rows_without_group_need_a_row_key(spark, shuffled_sales):
    with pytest.raises(Exception, match="row_key"):
        folds.group_folds(shuffled_sales, "k", 5, 1).collect()
    placed = folds.group_folds(shuffled_sales, "k", 5, 1, row_key="id")
    assert placed.filter("fold is null").count() == 0 and placed.count() == 600
    assert placed.filter("k is null").select("fold").distinct().count() == 5


@pytest.mark.parametrize("fold", ["cast(null as int)", "7", "-1"])
def test_a_wrong_fold_is_an_error(spark, fold):
    df = spark.range(4).selectExpr("id", f"if(id = 2, {fold}, 1) as fold")
    with pytest.raises(Exception, match="fold must be 0 to 2"):
        df.select(folds.checked_fold("fold", 3)).collect()


def test_groups_without_a_heavy_one_take_one_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "id % 500 as k", "id as day")
    got = ordering.number_and_previous(df, "k", ["day"], {"before": "id"}, "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "rangepartitioning" not in plan
    assert rows(got.groupBy("n").count()) == [(1, 500), (2, 500)]
