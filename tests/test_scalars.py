import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from residualkit.functions import names, scalars


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_winsorize_keeps_missing(spark):
    df = column(spark, [-2.0, -1.0, 0.5, 2.0, None])
    got = [r[0] for r in df.select(scalars.winsorize("x")).collect()]
    assert got == [-1.0, -1.0, 0.5, 1.0, None]


def test_log_offset_is_missing_where_undefined(spark):
    df = column(spark, [0.0, -0.1, -5.0, None, 0.9])
    got = [r[0] for r in df.select(scalars.log_offset("x")).collect()]
    assert got[0] == pytest.approx(math.log(0.1))
    assert got[1:4] == [None, None, None]
    assert got[4] == pytest.approx(0.0)


def test_month_block_and_calendar(spark):
    df = spark.createDataFrame([("2016-01-31",), ("2017-09-15",)], "d string").select(F.to_date("d").alias("d"))
    parts = scalars.calendar_columns("d", 2016)
    got = df.select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [tuple(r) for r in got] == [(2016, 1, 31, 1), (2017, 9, 15, 21)]


def test_log_error(spark):
    df = spark.createDataFrame([(math.e, 1.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(scalars.log_error("a", "b")).collect()]
    assert got == [pytest.approx(1.0), None, None]


def test_rounding_is_half_even(spark):
    df = column(spark, [0.5, 1.5, 2.5, None])
    got = [r[0] for r in df.select(scalars.round_half_even("x", 0)).collect()]
    assert got == [0.0, 2.0, 2.0, None]


def test_composite_text_names_missing_parts(spark):
    df = spark.createDataFrame([("a", None), ("a_b", "c"), (None, "")], "a string, b string")
    got = [r[0] for r in df.select(scalars.composite_text("a", "b")).collect()]
    assert got == ["a_nan", "a_b_c", "nan"]


def test_null_count_of_many_columns(spark):
    df = spark.range(3).select("id", *[F.when(F.col("id") > 1, F.lit(i)).alias(f"c{i}") for i in range(301)])
    got = [r[0] for r in df.select(scalars.null_count(df.columns)).collect()]
    assert sorted(got) == [0, 301, 301]
    assert df.select(scalars.null_count([])).first()[0] == 0


def test_flag_and_nan(spark):
    df = column(spark, [1.0, None, float("nan")])
    cleaned = df.select(scalars.nan_to_null("x").alias("x"))
    assert [r[0] for r in cleaned.select(scalars.flag("x")).collect()] == [1, 0, 0]


def test_name_helpers(spark):
    df = spark.createDataFrame([(1, 2.0, "t")], "parcelid long, roomcnt double, usedesc string")
    assert names.columns_matching(df.columns, ("id", "cnt"), ("parcelid",)) == ["roomcnt"]
    assert names.text_columns(df) == ["usedesc"]
    assert names.present(df, ["usedesc", "nothing"]) == ["usedesc"]
    wide = names.suffix_columns(df, "_2017", ["parcelid"])
    assert wide.columns == ["parcelid", "roomcnt_2017", "usedesc_2017"]
    both = df.join(wide, "parcelid")
    first, second = names.split_by_suffix(both, "_2017", ["parcelid"])
    assert first.columns == df.columns == second.columns
    assert rows(second) == rows(df)
    assert names.move_to_end(df, ["parcelid"]).columns == ["roomcnt", "usedesc", "parcelid"]
    with pytest.raises(ValueError, match="missing"):
        names.require(df, ["nothing"], "order")


def test_grouping_mark_matches_spark(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    keys = ["a", "b", "c"]
    for chosen in (["a"], ["b", "c"], ["a", "c"], []):
        got = df.groupingSets([[F.col(k) for k in chosen]], *[F.col(k) for k in keys]).agg(
            F.grouping_id().alias("g")
        )
        assert got.first()["g"] == names.grouping_mark(keys, chosen)
