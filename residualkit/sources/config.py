"""The training configuration."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class TrainConfig:
    n_splits: int
    features: tuple[str, ...]
    model_type: str = "gbt"
    model_params: Mapping[str, object] = field(default_factory=dict)
    eval_metric: str = "mae"
    early_stopping_rounds: int | None = 200
    n_estimators: int = 50_000
    seed: int = 0


def parse_config(text: str) -> TrainConfig:
    """A configuration from JSON text. Unknown and missing names are errors."""
    values = json.loads(text)
    known = set(TrainConfig.__dataclass_fields__)
    unknown = set(values) - known
    if unknown:
        raise ValueError(f"unknown configuration entries: {sorted(unknown)}")
    return TrainConfig(**{**values, "features": tuple(values["features"])})


def read_config(path: str, spark: SparkSession | None = None) -> TrainConfig:
    """Read a configuration from wherever Spark reads from."""
    session = spark or SparkSession.active()
    return parse_config(session.read.text(path, wholetext=True).first()[0])
