"""Shapes of physical plans, and the whole job against SQL."""

import re
from pathlib import Path

import duckdb
import pytest
from compare import connect, differences

from __spark_entry__ import entry
from residualkit.operators.folds import contiguous_folds, shuffled_folds
from residualkit.plans import catalog
from residualkit.plans.features import FeatureSpec
from residualkit.plans.oracle import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture(scope="module")
def sql() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_sql(spark, sql, name):
    result = catalog.QUERIES[name](spark, SMALL).toPandas()
    assert len(result) > 0
    if name in ORACLE_SQL:
        assert differences(result, sql.execute(ORACLE_SQL[name]).df()) == []


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(catalog.QUERIES)


def test_entry_has_rows(spark):
    assert entry(spark).count() == 1500


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["sale_history", "target_encode_oof", "group_stats_pair", "asof_history", "label_encode", "contiguous_folds"]
)
def test_no_python_no_single_task_window_no_cross_join(spark, name):
    plan = plan_of(catalog.QUERIES[name](spark, SMALL))
    assert "Python" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


def test_folds_do_not_shuffle_the_frame(spark):
    tx = catalog.table(spark, SMALL, "orders")
    for df in (
        contiguous_folds(tx, 5, ["o_orderdate", "o_orderkey"]),
        shuffled_folds(tx, "o_orderkey", 5, 1),
        shuffled_folds(tx, "o_orderkey", 5, 1, exact=True),
    ):
        assert "Exchange" not in plan_of(df)


def test_scan_reads_only_what_is_asked(spark):
    plan = catalog.QUERIES["log_columns"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<c_custkey:bigint,c_acctbal:double>", plan)


def test_standard_definition_has_288_statistic_columns():
    spec = FeatureSpec()
    assert len(spec.stat_key_sets) * len(spec.stat_values) * 3 == 288
    assert len(spec.encoding_key_sets) == 6
    assert spec.horizons == {2016: {10: 10, 11: 11, 12: 12}, 2017: {10: 22, 11: 23, 12: 24}}


def test_library_code_keeps_to_its_rules():
    for path in (ROOT / "residualkit").rglob("*.py"):
        text = path.read_text()
        if "llm" in path.relative_to(ROOT).parts:
            assert "localCheckpoint" not in text and "except ImportError" not in text
            continue
        assert "residualkit.llm" not in text, f"{path} imports the llm subpackage"
        for word in ("localCheckpoint", "crossJoin", "toPandas", ".rdd", "pandas_udf", "F.udf"):
            assert word not in text, f"{word} in {path}"
