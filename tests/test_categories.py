import pytest
from conftest import many_blocks, rows

from residualkit.operators.categories import fit_labels, fit_rare


@pytest.fixture
def listed(spark):
    data = [(i, "big", 10, "late") for i in range(5)]
    data += [(5, "few_b", 3, "few_b"), (6, "few_a", 2, "new"), (7, None, None, "big")]
    return spark.createDataFrame(data, "id long, c string, n int, twin string")


def test_rare_values_become_the_smallest_rare_value(listed):
    rare = fit_rare(listed, ["c", "n"], threshold=3)
    assert rare.replacements == {"c": "few_a", "n": 2}
    got = rows(rare.apply(listed, twins={"twin": "c"}), "id")
    assert got[4:] == [
        (4, "big", 10, "late"),
        (5, "few_a", 2, "few_a"),
        (6, "few_a", 2, "new"),
        (7, None, None, "big"),
    ]


def test_nothing_rare_changes_nothing(listed):
    rare = fit_rare(listed.filter("id < 5"), ["c"], threshold=3)
    assert rare.replacements == {}
    assert rows(rare.apply(listed, twins={"twin": "c"}), "id") == rows(listed, "id")


def test_labels_are_sorted_over_all_frames_with_missing_as_nan(spark, listed):
    other = spark.createDataFrame([("zzz", None), ("Abc", "big")], "c string, twin string")
    with many_blocks(spark):
        codes = fit_labels([listed, other], ["c", "twin"])
        got = {r["id"]: (r["c"], r["twin"]) for r in codes.apply(listed).collect()}
    # Abc, big, few_a, few_b, nan, zzz / big, few_b, late, nan, new
    assert got[0] == (1, 2) and got[5] == (3, 1) and got[6] == (2, 4) and got[7] == (4, 0)
    assert dict(codes.apply(listed).dtypes)["c"] == "int"


def test_unseen_label_is_an_error_or_null(spark, listed):
    codes = fit_labels([listed], ["c"])
    new = spark.createDataFrame([(1, "never seen")], "id long, c string")
    with pytest.raises(Exception, match="unseen value in c: never seen"):
        codes.apply(new).collect()
    assert rows(codes.apply(new, unseen="null")) == [(1, None)]
    with pytest.raises(ValueError, match="unseen"):
        codes.apply(new, unseen="keep")
