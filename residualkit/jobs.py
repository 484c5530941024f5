"""The two jobs from files to files.

    python -m residualkit.jobs prepare SOURCE TABLES
    python -m residualkit.jobs submit TABLES CONFIG OUT

``prepare`` reads a folder of CSV files and writes the feature tables; ``submit``
trains on them as the configuration says and writes the submission. All paths are
read and written by Spark.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from residualkit.plans.features import FeatureSpec, build_features
from residualkit.plans.scoring import forecast, submission
from residualkit.plans.training import train
from residualkit.sources.config import TrainConfig, read_config
from residualkit.sources.quarantine import read_quarantined
from residualkit.sources.tables import read_in_order, read_table, write_submission, write_table
from residualkit.staging import staging_scope


@dataclass(frozen=True)
class SourceFiles:
    """Names of the CSV files, one pattern for all years or a name for each, and schemas where they should not be inferred."""

    properties: str | Mapping[int, str] = "properties_{year}.csv"
    sales: str | Mapping[int, str] = "train_{year}.csv"
    template: str = "sample_submission.csv"
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)


def file_name(names: str | Mapping[int, str], year: int) -> str:
    return names.format(year=year) if isinstance(names, str) else names[year]


def prepare(
    spark: SparkSession,
    source: str,
    tables: str,
    spec: FeatureSpec = FeatureSpec(),
    files: SourceFiles = SourceFiles(),
    quarantine: str | None = None,
) -> None:
    """CSV files in ``source`` to the feature tables ``train`` and ``score`` below ``tables``.

    Sales without a row id are numbered in file order, year after year. With ``quarantine``, damaged rows
    of property files that have a schema are written to that folder, one table a file, and left out.
    """

    def read(name: str) -> DataFrame:
        return read_table(spark, f"{source}/{name}", files.schemas.get(name), format="csv")

    def read_properties(name: str) -> DataFrame:
        if quarantine is None or name not in files.schemas:
            return read(name)
        return read_quarantined(spark, f"{source}/{name}", files.schemas[name], f"{quarantine}/{name}", [spec.key]).rows

    with staging_scope(spark):
        sales, start = {}, 0
        for year in spec.years:
            name = file_name(files.sales, year)
            rows = read(name)
            if spec.row_id not in rows.columns:
                rows = read_in_order(spark, f"{source}/{name}", files.schemas.get(name), name=spec.row_id, start=start)
                start += rows.count()
            sales[year] = rows
        properties = {year: read_properties(file_name(files.properties, year)) for year in spec.years}
        frames = build_features(properties, sales, read(files.template).select(spec.score_key), spec)
        write_table(frames.train, f"{tables}/train")
        write_table(frames.score, f"{tables}/score", ("snapshot_year",))


def train_and_submit(
    spark: SparkSession,
    tables: str,
    config: TrainConfig,
    out: str,
    spec: FeatureSpec = FeatureSpec(),
    estimator: Estimator | None = None,
    parallelism: int = 1,
) -> str:
    """Train on the feature tables and write the submission; returns its folder."""
    with staging_scope(spark):
        trained = train(
            read_table(spark, f"{tables}/train"), config, estimator, row_id=spec.row_id, label=spec.target, parallelism=parallelism
        )
        score = read_table(spark, f"{tables}/score")
        yearly = [
            forecast(
                score.filter(score["snapshot_year"] == year).drop("snapshot_year"),
                trained.result.models,
                trained.prep,
                spec.score_key,
                year,
                spec.months,
                spec.base_year,
            )
            for year in spec.years
        ]
        periods = [f"{y}{m:02d}" for y in spec.years for m in spec.months]
        return write_submission(submission(yearly, spec.score_key, periods), out, config.model_type, config.seed)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="residualkit.jobs", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    first = jobs.add_parser("prepare")
    first.add_argument("source")
    first.add_argument("tables")
    second = jobs.add_parser("submit")
    second.add_argument("tables")
    second.add_argument("config")
    second.add_argument("out")
    second.add_argument("--parallelism", type=int, default=1)
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"residualkit-{chosen.job}").getOrCreate()
    if chosen.job == "prepare":
        prepare(spark, chosen.source, chosen.tables)
    else:
        config = read_config(chosen.config, spark)
        train_and_submit(spark, chosen.tables, config, chosen.out, parallelism=chosen.parallelism)


if __name__ == "__main__":
    main()
