import json
import math

import pytest
from conftest import rows, settings

from residualkit.sources import config, tables
from residualkit.staging import checkpoint_root, clear_staged, stage, staged_folder


def test_csv_missing_values_become_null(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,x,name\n1,NaN,NaN\n2,1.5,nan\n3,,plain\n4,2.5,N/A\n")
    got = tables.read_table(spark, str(path), "id long, x double, name string", format="csv")
    assert rows(got, "id") == [(1, None, None), (2, 1.5, None), (3, None, "plain"), (4, 2.5, None)]
    inferred = tables.read_table(spark, str(path), format="csv")
    assert rows(inferred, "id") == rows(got, "id")


def test_rows_are_numbered_in_file_order_across_splits(spark, tmp_path):
    path = tmp_path / "sales"
    path.mkdir()
    expected = []
    for part in ("a", "b"):
        lines = [f"{(i * 7919) % 1009},{part}{i}" for i in range(400 if part == "a" else 150)]
        (path / f"{part}.csv").write_text("k,name\n" + "\n".join(lines) + "\n")
        expected += [line.split(",")[1] for line in lines]
    with settings(spark, spark__sql__files__maxPartitionBytes="900", spark__sql__files__openCostInBytes="1"):
        df = tables.read_in_order(spark, str(path), "k long, name string", start=10)
        got = rows(df.select("row_id", "name"), "row_id")
    assert got == list(enumerate(expected, 10))


def test_parquet_nan_becomes_null_and_key_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, float("nan")), (2, 2.0)], "id long, x double").write.parquet(path)
    got = tables.read_table(spark, path)
    assert rows(got, "id") == [(1, None), (2, 2.0)]
    plan = got.filter("id = 2").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,2)" in plan
    assert "x#" not in plan


def test_bool_to_text(spark):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "id long, b boolean")
    assert rows(tables.bool_to_text(df), "id") == [(1, "True"), (2, None), (3, "False")]


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 2016, 0.5), (2, 2017, None)], "id long, year int, x double")
    path = str(tmp_path / "features")
    tables.write_table(df, path, ("year",))
    tables.write_table(df, path, ("year",))
    assert rows(tables.read_table(spark, path).select("id", "year", "x"), "id") == rows(df, "id")


def test_submission_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1234)], "ParcelId long, `201610` double")
    path = tables.write_submission(df, str(tmp_path), "gbt", 7, single_file=True)
    assert path.endswith("submission_gbt_7")
    files = list((tmp_path / "submission_gbt_7").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text() == "ParcelId,201610\n1,0.1234\n"


def test_config(tmp_path):
    values = {
        "n_splits": 5,
        "features": ["a", "b"],
        "model_type": "lgb",
        "model_params": {"learning_rate": 0.1},
        "eval_metric": "mae",
        "early_stopping_rounds": 20,
        "n_estimators": 50,
        "seed": 3,
    }
    path = tmp_path / "config.json"
    path.write_text(json.dumps(values))
    read = config.read_config(str(path))
    assert read.features == ("a", "b") and read.seed == 3
    with pytest.raises(ValueError, match="unknown"):
        config.parse_config(json.dumps({**values, "typo": 1}))


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, "a", math.pi), (2, None, None)], "id long, s string, x double")
    staged = stage(df, "test", partition_by="id")
    assert staged.schema == df.schema
    assert rows(staged, "id") == rows(df, "id")
    assert staged_folder(spark).startswith(checkpoint_root(spark))


def test_staged_files_live_below_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    staged = stage(spark.range(3), "here")
    files = staged.inputFiles()
    assert root and files and all(f"{root.rstrip('/')}/residualkit/" in f for f in files)
    assert clear_staged(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FAILED_READ_FILE"):
        spark.read.parquet(files[0]).collect()


class _Cluster:
    """A session that looks like one on a cluster without a checkpoint folder."""

    master = "spark://somewhere"

    @property
    def conf(self):
        return self

    @property
    def sparkContext(self):
        return self

    def get(self, name, default):
        return default

    def getCheckpointDir(self):
        return None


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Cluster())
