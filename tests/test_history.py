import datetime as dt

import pytest
from conftest import many_blocks, rows
from pyspark.sql import functions as F

from residualkit.operators import history

START = dt.date(2016, 1, 1)


@pytest.fixture
def sales(spark):
    """Parcels sold once, twice and three times, twice on one day, and with missing targets."""
    data = [
        (1, 10, 0, 0.1),
        (2, 20, 5, 0.2),
        (3, 20, 35, 0.3),
        (4, 30, 0, None),
        (5, 30, 31, 0.5),
        (6, 30, 63, 0.6),
        (7, 40, 9, 0.7),
        (8, 40, 9, None),
        (9, 50, 0, 0.9),
        (10, 50, 32, None),
        (11, None, 3, 1.1),
        (12, 60, 400, 1.2),
    ]
    df = spark.createDataFrame([(i, k, START + dt.timedelta(d), y) for i, k, d, y in data], "row_id long, k long, d date, logerror double")
    return df.withColumn("month_block", (F.year("d") - 2016) * 12 + F.month("d")).repartition(5)


def test_sale_history(spark, sales):
    with many_blocks(spark):
        got = history.sale_history(sales, "k", ["d", "row_id"], number="n")
        data = {r["row_id"]: (r["n"], r["prev_month"], r["prev_logerror"], r["month_interval"], r["has_history"]) for r in got.collect()}
    assert data[1] == (1, None, None, None, 0)
    assert data[3] == (2, 1, 0.2, 1, 1)
    # The previous sale counts although its target is missing.
    assert data[5] == (2, 1, None, 1, 0)
    assert data[6] == (3, 2, 0.5, 1, 1)
    assert data[8] == (2, 1, 0.7, 0, 1)
    assert data[11] == (None, None, None, None, 0)
    assert "n" not in history.sale_history(sales, "k", ["d", "row_id"]).columns


def test_asof_never_reads_the_horizon_or_later(spark, sales):
    keys = spark.createDataFrame([(10,), (30,), (40,), (60,), (70,)], "k long")
    got = history.asof_history(keys, sales, "k", [1, 2, 3, 20], ["d", "row_id"])
    data = {(r["k"], r["horizon"]): tuple(r)[2:] for r in got.collect()}
    assert len(data) == 20
    assert data[10, 1] == (None, None, None, 0)
    assert data[10, 2] == (1, 0.1, 1, 1)
    assert data[30, 2] == (1, None, 1, 0)
    assert data[30, 3] == (2, 0.5, 1, 1)
    assert data[30, 20] == (3, 0.6, 17, 1)
    # Of two sales on one day the later row is the last one, even with a missing target.
    assert data[40, 3] == (1, None, 2, 0)
    assert data[60, 20] == (14, 1.2, 6, 1)
    assert data[70, 20] == (None, None, None, 0)
    assert all(m is None or m < h for (_, h), (m, *_) in data.items())


def test_asof_by_month_is_the_long_form_side_by_side(spark, sales):
    keys = spark.createDataFrame([(10,), (30,), (40,), (60,)], "k long")
    wide = history.asof_history_wide(
        keys, sales, "k", {2016: {2: 2, 3: 3}, 2017: {2: 14, 3: 15}}, ["d", "row_id"], "y"
    )
    long = history.asof_history(keys, sales, "k", [2, 3, 14, 15], ["d", "row_id"])
    expected = {(r["k"], r["horizon"]): tuple(r)[2:] for r in long.collect()}
    for r in wide.collect():
        for m in (2, 3):
            got = tuple(r[f"{c}_{m}"] for c in ("prev_month", "prev_logerror", "month_interval", "has_history"))
            assert got == expected[r["k"], m + 12 * (r["y"] - 2016)]


def test_repeat_sale_pairs(spark, sales):
    with many_blocks(spark):
        got = rows(history.repeat_sale_pairs(sales, "k", ["d", "row_id"]), "k")
    # The first skips a missing target, the second row is taken as it is.
    assert got == [(20, 2, 0.2, 0.3), (30, 2, 0.5, 0.5)]
    assert {r["k"] for r in history.sales_of_repeat_keys(sales, "k").collect()} == {20, 30}


def test_close_repeats_are_dropped(spark, sales):
    with many_blocks(spark):
        kept = {r["row_id"] for r in history.drop_close_repeats(sales, "k", "d", ["d", "row_id"]).collect()}
        # 30 and 31 days are close, 32 days are not.
        assert kept == {1, 2, 4, 6, 7, 9, 10, 11, 12}
        reasonable = F.col("logerror").isNotNull()
        filtered = history.drop_close_repeats(sales, "k", "d", ["d", "row_id"], 31, reasonable)
        assert {r["row_id"] for r in filtered.collect()} == {1, 2, 5, 6, 7, 9, 11, 12}


def test_a_single_order_column_gives_the_same_by_hash_aggregation(sales):
    numbered = history.sale_history(sales, "k", ["d", "row_id"], number="n").filter("k is not null")
    by_struct = history.last_sales(numbered, "k", [1, 2, 3, 20], ["d", "row_id"])
    by_number = history.last_sales(numbered, "k", [1, 2, 3, 20], ["n"])
    plan = by_number._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan.split("Window")[0]
    flat = [F.col(f"_h{h}")[c] for h in (1, 2, 3, 20) for c in ("prev_month", "prev_logerror")]
    assert rows(by_number.select("k", *flat), "k") == rows(by_struct.select("k", *flat), "k")


def test_last_sales_is_one_shuffle_with_partial_aggregation(sales):
    plan = history.last_sales(sales, "k", [1, 2], ["d", "row_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning") == 1
    assert "partial_max_by" in text
