"""The feature job: snapshots, transactions and a scoring list in, feature tables out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import columns_matching, move_to_end, present, text_columns
from residualkit.functions.scalars import calendar_columns, log_offset, null_count
from residualkit.operators.categories import fit_labels, fit_rare
from residualkit.operators.folds import contiguous_folds
from residualkit.operators.group_stats import fit_group_stats
from residualkit.operators.history import asof_history_wide, sale_history
from residualkit.operators.lookup import left_join
from residualkit.operators.snapshots import (
    align_snapshots,
    attach_properties,
    fit_cross_fill,
    require_unique,
    stack_snapshots,
    union_by_name,
)
from residualkit.operators.target_encoding import apply_encodings, fit_target_encodings
from residualkit.sources.tables import bool_to_text
from residualkit.staging import stage

# Column names, months and thresholds the feature tables are defined by.
FILL_NAME_PARTS = ("id", "cnt", "nbr")
FILL_EXCLUDED = (
    "parcelid",
    "unitcnt",
    "structuretaxvaluedollarcnt",
    "taxvaluedollarcnt",
    "landtaxvaluedollarcnt",
)
RARE_COLUMNS = ("regionidcity", "regionidzip", "regionidneighborhood", "propertycountylandusecode")
RARE_THRESHOLD = 100
SCALED_COLUMNS = ("bathroomcnt", "calculatedbathnbr")
SCALE = 10
LOG_COLUMNS = (
    "calculatedfinishedsquarefeet",
    "finishedsquarefeet50",
    "structuretaxvaluedollarcnt",
    "taxvaluedollarcnt",
    "taxamount",
    "landtaxvaluedollarcnt",
    "lotsizesquarefeet",
    "finishedsquarefeet6",
    "garagetotalsqft",
    "finishedsquarefeet12",
    "unitcnt",
    "finishedsquarefeet15",
    "finishedfloor1squarefeet",
    "longitude",
)
LOG_OFFSET = 0.1
PLACE_KEYS = ("regionidcounty", "regionidcity", "regionidneighborhood", "regionidzip")
USE_KEYS = ("propertycountylandusecode", "propertyzoningdesc")
STAT_VALUES = (
    "taxvaluedollarcnt_log",
    "lotsizesquarefeet_log",
    "finishedsquarefeet12_log",
    "landtaxvaluedollarcnt_log",
    "yearbuilt",
    "taxamount_log",
    "structuretaxvaluedollarcnt_log",
    "calculatedfinishedsquarefeet_log",
)
ENCODED_PLACES = ("regionidcity", "regionidzip", "regionidneighborhood")
ENCODING_FOLDS = 5
YEARS = (2016, 2017)
BASE_YEAR = 2016
MONTHS = (10, 11, 12)


@dataclass(frozen=True)
class FeatureSpec:
    """Names and settings of the feature job. The defaults are its standard definition."""

    key: str = "parcelid"
    score_key: str = "ParcelId"
    date: str = "transactiondate"
    target: str = "logerror"
    row_id: str = "row_id"
    years: tuple[int, int] = YEARS
    base_year: int = BASE_YEAR
    months: tuple[int, ...] = MONTHS
    fill_parts: tuple[str, ...] = FILL_NAME_PARTS
    fill_excluded: tuple[str, ...] = FILL_EXCLUDED
    default_sentinel: float | None = -1.0
    rare_columns: tuple[str, ...] = RARE_COLUMNS
    rare_threshold: int = RARE_THRESHOLD
    scaled_columns: tuple[str, ...] = SCALED_COLUMNS
    scale: int = SCALE
    log_columns: tuple[str, ...] = LOG_COLUMNS
    log_offset: float = LOG_OFFSET
    stat_key_sets: tuple[tuple[str, ...], ...] = (
        *((place,) for place in PLACE_KEYS),
        *((place, use) for place in PLACE_KEYS for use in USE_KEYS),
    )
    stat_values: tuple[str, ...] = STAT_VALUES
    encoding_key_sets: tuple[tuple[str, ...], ...] = tuple(
        (place, use) for use in USE_KEYS for place in ENCODED_PLACES
    )
    encoding_folds: int = ENCODING_FOLDS
    unseen_labels: str = "error"
    horizons: Mapping[int, Mapping[int, int]] = field(init=False)

    def __post_init__(self) -> None:
        by_year = {y: {m: m + 12 * (y - self.base_year) for m in self.months} for y in self.years}
        object.__setattr__(self, "horizons", by_year)


@dataclass(frozen=True)
class FeatureFrames:
    """``train``: one row per sale. ``score``: one row per scoring key and snapshot year."""

    train: DataFrame
    score: DataFrame

    def score_year(self, year: int) -> DataFrame:
        return self.score.filter(F.col("snapshot_year") == year).drop("snapshot_year")


SUFFIX = "__second"


def build_features(
    snapshots: Mapping[int, DataFrame],
    sales: Mapping[int, DataFrame],
    template: DataFrame,
    spec: FeatureSpec = FeatureSpec(),
) -> FeatureFrames:
    """Run the feature job.

    ``sales`` need a ``row_id`` that is unique over all years; it breaks ties between sales of
    one day. A key that a snapshot or the template holds twice is an error. Both years travel in one frame with a ``snapshot_year`` column, so
    every join and every statistic is done once for both. Fold numbers and sale
    history are taken from the narrow sales table before anything wide is joined.
    """
    unique = {f"the snapshot of {y}": (df, spec.key) for y, df in snapshots.items()}
    require_unique({**unique, "the template": (template, spec.score_key)})
    properties = clean_properties(snapshots, spec)

    order = ["_date", spec.row_id]
    tx = contiguous_folds(stage(narrow_sales(sales, spec), "narrow_sales"), spec.encoding_folds, order)
    tx = sale_history(tx, spec.score_key, order, "month_block", spec.target, number="_number")
    tx = stage(tx, "sales")

    history = asof_history_wide(
        template,
        tx.select(spec.score_key, "_number", "month_block", spec.target),
        spec.score_key,
        {y: dict(m) for y, m in spec.horizons.items()},
        ["_number"],
        "snapshot_year",
        target=spec.target,
    )
    on = [spec.score_key, "snapshot_year"]
    # Scoring keys are unique, so no key can be hot; sales repeat theirs.
    score = stage(left_join(history, properties, on), "score", partition_by="snapshot_year")
    train = attach_properties(tx.drop("_number"), properties, on)

    labels = fit_labels([score], text_columns(properties))
    score = labels.apply(score)
    train = stage(labels.apply(train, spec.unseen_labels), "train")

    key_sets = [s for s in spec.stat_key_sets if len(present(score, s)) == len(s)]
    encoded = [s for s in spec.encoding_key_sets if len(present(train, s)) == len(s)]
    stats = fit_group_stats(score, key_sets, present(score, spec.stat_values), within=["snapshot_year"])
    encodings = fit_target_encodings(train, encoded, spec.target, "fold", spec.encoding_folds)

    uncounted = set(history.columns) - set(template.columns)
    uncounted |= {"prev_month", "prev_logerror", "month_interval", "has_history", "fold", *order}
    frames = []
    for frame in (stats.apply(train), stats.apply(score)):
        counted = [c for c in frame.columns if c not in uncounted]
        frames.append(frame.withColumn("num_of_nan", null_count(counted)))
    train, score = frames
    if encodings:
        train, score = apply_encodings(train, encodings, "fold"), apply_encodings(score, encodings)

    train = train.drop("_date", "fold", "snapshot_year")
    return FeatureFrames(move_to_end(train, ["year", "month", "month_block"]), score)


def clean_properties(snapshots: Mapping[int, DataFrame], spec: FeatureSpec) -> DataFrame:
    """Aligned, repaired, collapsed, scaled and logged properties, one row per key and year.

    The aligned table is staged; everything after it is a projection of it.
    """
    first, second = (bool_to_text(snapshots[y]) for y in spec.years)
    wide = stage(align_snapshots(first, second, spec.key, SUFFIX), "aligned")
    names = [c for c in first.columns if c in second.columns and c != spec.key]
    filled = columns_matching(names, spec.fill_parts, spec.fill_excluded)
    wide = fit_cross_fill(wide, filled, SUFFIX, spec.default_sentinel).apply(wide)
    rows = stack_snapshots(wide, spec.key, SUFFIX, spec.years, "snapshot_year")

    rare_columns = present(rows, spec.rare_columns)
    if rare_columns:
        learned_on = rows.filter(F.col("snapshot_year") == spec.years[0])
        rows = fit_rare(learned_on, rare_columns, spec.rare_threshold).apply(rows)
    rows = rows.withColumns({c: F.col(c) * spec.scale for c in present(rows, spec.scaled_columns)})
    logged = present(rows, spec.log_columns)
    rows = rows.withColumns({f"{c}_log": log_offset(c, spec.log_offset) for c in logged}).drop(*logged)
    return rows.withColumnRenamed(spec.key, spec.score_key)


def narrow_sales(sales: Mapping[int, DataFrame], spec: FeatureSpec) -> DataFrame:
    """Key, target, calendar and order columns of all sales, with the year of their file."""
    day = F.col("_date")
    parts = calendar_columns(day, spec.base_year)
    frames = [
        frame.select(
            F.col(spec.key).alias(spec.score_key),
            spec.target,
            spec.row_id,
            F.to_date(spec.date).alias("_date"),
            F.lit(year).alias("snapshot_year"),
        ).select("*", *[parts[name].alias(name) for name in ("year", "month", "month_block")])
        for year, frame in sales.items()
    ]
    return union_by_name(frames)
