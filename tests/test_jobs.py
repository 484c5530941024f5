"""The jobs from files to files: file names by year, numbering in file order, damaged rows, submission, command line."""

import json
import random

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from test_feature_job import ID_COLUMNS, snapshot

from residualkit import jobs
from residualkit.plans.features import FeatureSpec
from residualkit.plans.training import estimator_for
from residualkit.sources.config import TrainConfig
from residualkit.sources.quarantine import read_quarantined
from residualkit.sources.tables import read_table

KEYS = 60
SCHEMA = "row long, amount double, day date, word string"
DAMAGED = ["1,2.5,2016-01-02,fine", "2,,,", ",3.5,2016-01-02,nokey", "4,abc,2016-01-02,type", "5,1.5,2016-13-40,date", "6,1.5", "7,1,2016-01-02,a,b"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """CSV files without row ids; the sales files have names of their own, one property row is damaged."""
    source = tmp_path_factory.mktemp("source")
    rng = random.Random(5)
    for year, seed in ((2016, 1), (2017, 2)):
        snapshot(seed, range(KEYS)).to_csv(source / f"properties_{year}.csv", index=False)
    for year, name in ((2016, "train_2016_v2.csv"), (2017, "train_2017.csv")):
        lines = [f"{rng.randrange(KEYS)},{rng.gauss(0, 0.2):.4f},{year}-{1 + i // 20:02d}-{1 + i % 28:02d}" for i in range(160)]
        (source / name).write_text("\n".join(["parcelid,logerror,transactiondate", *lines]) + "\n")
    (source / "sample_submission.csv").write_text("\n".join(["ParcelId,201610", *[f"{k},0" for k in range(KEYS)]]) + "\n")
    return source


SALES = {2016: "train_2016_v2.csv", 2017: "train_2017.csv"}


@pytest.fixture(scope="module")
def tables(spark, folder):
    out = f"{folder}/tables"
    jobs.prepare(spark, str(folder), out, FeatureSpec(rare_threshold=5), jobs.SourceFiles(sales=SALES))
    return out


def test_sales_are_numbered_in_file_order(folder, tables, spark):
    got = {r.row_id: (r.ParcelId, r.month_block) for r in read_table(spark, f"{tables}/train").collect()}
    lines = [line.split(",") for year in SALES for line in (folder / SALES[year]).read_text().split("\n")[1:] if line]
    assert len(got) == len(lines) == 320
    for i, (parcel, _, day) in enumerate(lines):
        year, month, _ = map(int, day.split("-"))
        assert got[i] == (int(parcel), (year - 2016) * 12 + month)


def test_submission_is_the_mean_of_the_fold_lines(spark, folder, tables):
    config = TrainConfig(n_splits=3, features=("month_block",), model_type="linear", seed=3)
    path = jobs.train_and_submit(spark, tables, config, f"{folder}/out", FeatureSpec(), LinearRegression(solver="normal"))
    wide = read_table(spark, path, format="csv").collect()
    assert len(wide) == KEYS and len(wide[0]) == 7
    assert all(-1 <= r[p] <= 1 for r in wide for p in ("201610", "201712"))
    assert len({r["201611"] for r in wide}) == 1  # the feature is the same for all keys


def test_command_line(spark, folder, tables, monkeypatch):
    # One feature and few trees of the median booster, from a configuration file.
    config = {"n_splits": 2, "features": ["month_block"], "model_type": "median", "n_estimators": 1, "early_stopping_rounds": None,
              "model_params": {"max_depth": 2, "objective": "mae"}}
    (folder / "config.json").write_text(json.dumps(config))
    jobs.main(["submit", tables, str(folder / "config.json"), f"{folder}/cli"])
    assert read_table(spark, f"{folder}/cli/*", format="csv").count() == KEYS
    called = []
    monkeypatch.setattr(jobs, "prepare", lambda *a: called.append(a[1:]))
    jobs.main(["prepare", "from", "to"])
    assert called == [("from", "to")]


def test_median_booster_takes_parameters():
    made = estimator_for(TrainConfig(5, ("x",), "median", {"learning_rate": 0.3, "depth": 4, "min_child_samples": 7, "metric": "mae"}, n_estimators=9, seed=2))
    names = ("stepSize", "maxDepth", "minInstancesPerNode", "maxIter", "seed", "patience", "holdout")
    assert [made.getOrDefault(n) for n in names] == [0.3, 4, 7, 9, 2, 200, 0.1]
    with pytest.raises(ValueError, match="absolute loss"):
        estimator_for(TrainConfig(5, ("x",), "median", {"objective": "mse"}))
    with pytest.raises(ValueError, match="no counterpart"):
        estimator_for(TrainConfig(5, ("x",), "median", {"bagging_fraction": 0.5}))


def test_damaged_rows_are_set_aside(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(["row,amount,day,word", *DAMAGED]) + "\n")
    found = read_quarantined(spark, str(tmp_path / "in.csv"), SCHEMA, str(tmp_path / "bad"), ["row"])
    assert sorted(r.row for r in found.rows.collect()) == [1, 2]
    assert (found.good, found.bad) == (2, 5)
    got = sorted((r.reason, r.text) for r in spark.read.parquet(str(tmp_path / "bad")).collect())
    assert got == [("malformed", t) for t in sorted(DAMAGED[3:])] + [("no row", DAMAGED[2])]
    assert {r.file for r in found.rejected.collect()} == {"in.csv"}
    assert found.checked(0.8).count() == 2
    with pytest.raises(ValueError, match="5 of 7 rows"):
        found.checked(0.1)
    with pytest.raises(ValueError, match="not in the schema"):
        read_quarantined(spark, str(tmp_path / "in.csv"), SCHEMA, required=["other"])


def test_property_files_with_damage(spark, folder, tmp_path):
    for path in folder.glob("*.csv"):
        (tmp_path / path.name).write_text(path.read_text())
    name = "properties_2016.csv"
    header = (folder / name).read_text().split("\n")[0]
    with (tmp_path / name).open("a") as file:
        file.write("notakey" + "," * header.count(",") + "\n")
    kinds = {c: "double" for c in header.split(",")} | {"parcelid": "long", "hashottuborspa": "boolean"}
    kinds |= {"propertycountylandusecode": "string", "propertyzoningdesc": "string"}
    schema = spark.createDataFrame([], ", ".join(f"{c} {kinds[c]}" for c in header.split(","))).schema
    files = jobs.SourceFiles(sales=SALES, schemas={name: schema})
    jobs.prepare(spark, str(tmp_path), f"{tmp_path}/tables", FeatureSpec(rare_threshold=5), files, f"{tmp_path}/rejected")
    assert read_table(spark, f"{tmp_path}/tables/score").select("ParcelId").distinct().count() == KEYS
    bad = spark.read.parquet(f"{tmp_path}/rejected/{name}")
    assert [(r.reason, r.text.split(",")[0]) for r in bad.collect()] == [("malformed", "notakey")]
    assert bad.filter(F.col("file") == name).count() == 1 and len(ID_COLUMNS) == 4
