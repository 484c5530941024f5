import pytest
from conftest import rows

from residualkit.operators import snapshots


@pytest.fixture
def snap_a(spark):
    data = [(1, 5.0, None, "x"), (2, None, None, None), (3, 1.0, None, "y"), (4, None, None, "x"), (5, 2.0, None, None)]
    return spark.createDataFrame(data, "parcelid long, roomcnt double, voidcnt double, usedesc string")


@pytest.fixture
def snap_b(spark):
    data = [(1, None, None, "x2"), (2, 7.0, None, "y2"), (3, 0.5, None, None), (4, None, None, None), (9, -50.0, None, "z")]
    return spark.createDataFrame(data, "parcelid long, roomcnt double, voidcnt double, usedesc string")


def test_align_drops_keys_of_the_second_only(snap_a, snap_b):
    wide = snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b")
    assert wide.columns == ["parcelid", "roomcnt", "voidcnt", "usedesc", "roomcnt_b", "voidcnt_b", "usedesc_b"]
    assert [r[0] for r in rows(wide, "parcelid")] == [1, 2, 3, 4, 5]
    full = snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b", how="full")
    assert [r[0] for r in rows(full, "parcelid")] == [1, 2, 3, 4, 5, 9]
    with pytest.raises(ValueError, match="how"):
        snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b", how="cross")


def test_cross_fill_borrows_then_takes_the_sentinel(snap_a, snap_b):
    wide = snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b")
    fill = snapshots.fit_cross_fill(wide, ["roomcnt"], "_b")
    # The key listed only by the second snapshot is not part of the minimum.
    assert fill.sentinels == {"roomcnt": -0.5}
    got = rows(fill.apply(wide).select("parcelid", "roomcnt", "roomcnt_b"), "parcelid")
    assert got == [(1, 5.0, 5.0), (2, 7.0, 7.0), (3, 1.0, 0.5), (4, -0.5, -0.5), (5, 2.0, 2.0)]


def test_cross_fill_of_an_empty_column(snap_a, snap_b):
    wide = snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b")
    kept = snapshots.fit_cross_fill(wide, ["voidcnt"], "_b").apply(wide)
    assert {r["voidcnt"] for r in kept.collect()} == {None}
    given = snapshots.fit_cross_fill(wide, ["voidcnt"], "_b", default_sentinel=-1.0).apply(wide)
    assert {(r["voidcnt"], r["voidcnt_b"]) for r in given.collect()} == {(-1.0, -1.0)}
    assert snapshots.fit_cross_fill(wide, [], "_b").apply(wide).columns == wide.columns


def test_stack_gives_one_row_per_year_without_a_shuffle(snap_a, snap_b):
    wide = snapshots.align_snapshots(snap_a, snap_b, "parcelid", "_b").select(
        "parcelid", "roomcnt", "roomcnt_b", "usedesc", "usedesc_b"
    )
    got = snapshots.stack_snapshots(wide, "parcelid", "_b", (2016, 2017), "y")
    assert rows(got.filter("parcelid in (1, 3)"), "parcelid", "y") == [
        (1, 2016, 5.0, "x"),
        (1, 2017, None, "x2"),
        (3, 2016, 1.0, "y"),
        (3, 2017, 0.5, None),
    ]


def test_key_years_and_union(spark):
    keys = spark.createDataFrame([(1,), (2,)], "k long")
    years = snapshots.key_years(keys, (2016, 2017), "y")
    assert rows(years) == [(1, 2016), (1, 2017), (2, 2016), (2, 2017)]
    assert "Join" not in years._jdf.queryExecution().executedPlan().toString()
    a = spark.createDataFrame([(1, "a")], "k long, s string")
    b = spark.createDataFrame([(2.5, 2)], "x double, k long")
    assert rows(snapshots.union_by_name([a, b]), "k") == [(1, "a", None), (2, None, 2.5)]


def test_a_key_listed_twice_is_an_error(spark):
    good = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k long, v string")
    bad = good.unionByName(good.filter("k = 2"))
    snapshots.require_unique({"first": (good, "k"), "names": (good, "v")})
    with pytest.raises(ValueError, match="second has 2 rows with the key 2"):
        snapshots.require_unique({"first": (good, "k"), "second": (bad, "k")})
