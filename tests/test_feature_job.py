"""The feature job with its standard definition, on frames with all of its columns."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from residualkit.plans import features
from residualkit.plans.features import FeatureSpec, build_features

ID_COLUMNS = ("regionidcounty", "regionidcity", "regionidneighborhood", "regionidzip")
OTHER = ("bathroomcnt", "calculatedbathnbr", "roomcnt", "yearbuilt")
TEXTS = ("propertycountylandusecode", "propertyzoningdesc", "hashottuborspa")


def snapshot(seed: int, keys: range) -> pd.DataFrame:
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.2 else value

    rows = []
    for k in keys:
        row = {"parcelid": k}
        row |= {c: maybe(float(rng.randrange(1, 4 + i))) for i, c in enumerate(ID_COLUMNS)}
        row |= {c: maybe(float(rng.randrange(1, 9))) for c in OTHER}
        row |= {c: maybe(round(rng.uniform(-1, 900), 2)) for c in features.LOG_COLUMNS}
        row |= {c: maybe(rng.choice("ABCD") + c[:2]) for c in TEXTS}
        row["hashottuborspa"] = True if row["hashottuborspa"] else None
        rows.append(row)
    return pd.DataFrame(rows)


@pytest.fixture(scope="module")
def inputs():
    rng = random.Random(9)
    snapshots = {2016: snapshot(1, range(120)), 2017: snapshot(2, range(10, 130))}
    sales, row_id = {}, 0
    for year, start in ((2016, dt.date(2016, 1, 1)), (2017, dt.date(2017, 1, 1))):
        days = sorted(rng.randrange(0, 260) for _ in range(150))
        rows = []
        for d in days:
            target = None if rng.random() < 0.05 else round(rng.gauss(0, 0.3), 4)
            rows.append((rng.randrange(0, 120), target, (start + dt.timedelta(d)).isoformat(), row_id))
            row_id += 1
        sales[year] = pd.DataFrame(rows, columns=["parcelid", "logerror", "transactiondate", "row_id"])
    return snapshots, sales


@pytest.fixture(scope="module")
def frames(spark, inputs):
    snapshots, sales = inputs
    kinds = {c: "double" for c in (*ID_COLUMNS, *OTHER, *features.LOG_COLUMNS)} | {c: "string" for c in TEXTS}
    kinds["hashottuborspa"] = "boolean"
    schema = "parcelid long, " + ", ".join(f"{c} {t}" for c, t in kinds.items())
    snaps = {
        y: spark.createDataFrame(f.astype(object).where(f.notna(), None)[["parcelid", *kinds]].values.tolist(), schema)
        for y, f in snapshots.items()
    }
    tx = {
        y: spark.createDataFrame(
            f.astype(object).where(f.notna(), None).values.tolist(),
            "parcelid long, logerror double, transactiondate string, row_id long",
        )
        for y, f in sales.items()
    }
    template = spark.range(120).select(F.col("id").alias("ParcelId"), F.lit(0.0).alias("201610"))
    spec = FeatureSpec(rare_threshold=25)
    return build_features(snaps, tx, template, spec)


@pytest.fixture(scope="module")
def train(frames):
    return frames.train.toPandas().sort_values("row_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def score(frames):
    return frames.score.toPandas().sort_values(["ParcelId", "snapshot_year"]).reset_index(drop=True)


def test_columns(train, score):
    stats = [
        f"{'_'.join(s)}_{v}_{kind}"
        for s in FeatureSpec().stat_key_sets
        for v in features.STAT_VALUES
        for kind in ("mean", "dif", "ratio")
    ]
    assert len(stats) == 288
    encodings = [f"{p}_{u}_logerror_enc" for u in features.USE_KEYS for p in features.ENCODED_PLACES]
    logs = [f"{c}_log" for c in features.LOG_COLUMNS]
    shared = {"ParcelId", "num_of_nan", *ID_COLUMNS, *OTHER, *TEXTS, *stats, *encodings, *logs}
    lags = ["prev_month", "prev_logerror", "month_interval", "has_history"]
    assert set(train.columns) == shared | {"logerror", "row_id", "year", "month", "month_block", *lags}
    assert list(train.columns[-3:]) == ["year", "month", "month_block"]
    monthly = {f"{c}_{m}" for c in lags for m in (10, 11, 12)}
    assert set(score.columns) == shared | monthly | {"snapshot_year", "201610"}
    assert (len(train), len(score)) == (300, 240)


def by_hand(snapshots):
    """The properties of both years, computed another way."""
    a = snapshots[2016].set_index("parcelid")
    b = snapshots[2017].set_index("parcelid").reindex(a.index)
    years = {2016: a.copy(), 2017: b.copy()}
    for c in (*ID_COLUMNS, "bathroomcnt", "calculatedbathnbr", "roomcnt"):
        low = min(a[c].min(), b[c].min()) - 1
        years[2016][c] = a[c].fillna(b[c]).fillna(low)
        years[2017][c] = b[c].fillna(a[c]).fillna(low)
    for c in features.RARE_COLUMNS:
        counts = years[2016][c].value_counts()
        few = sorted(counts[counts < 25].index)
        for y in years:
            years[y][c] = years[y][c].where(~years[y][c].isin(few), few[0] if few else None)
    for y in years:
        for c in features.SCALED_COLUMNS:
            years[y][c] *= 10
    for c in TEXTS:
        values = sorted({str(v) if v == v and v is not None else "nan" for y in years for v in years[y][c]})
        for y in years:
            years[y][c] = [values.index(str(v) if v == v and v is not None else "nan") for v in years[y][c]]
    return years


def test_property_columns(inputs, score):
    years = by_hand(inputs[0])
    for y in (2016, 2017):
        got = score[score.snapshot_year == y].set_index("ParcelId")
        for c in (*ID_COLUMNS, *OTHER, *TEXTS):
            expected = years[y][c].astype(float)
            assert got[c].astype(float).fillna(-99).tolist() == expected.fillna(-99).tolist(), c


def test_statistics_describe_the_property_list_of_the_year(score, train, inputs):
    for y in (2016, 2017):
        part = score[score.snapshot_year == y]
        key = ["regionidzip", "propertyzoningdesc"]
        means = part.groupby(key)["taxamount_log"].mean()
        sold = train[train.year == y]
        for frame in (part, sold):
            expected = pd.Series([means.get(tuple(k)) for k in frame[key].values], index=frame.index, dtype=float)
            got = frame["regionidzip_propertyzoningdesc_taxamount_log_mean"]
            pd.testing.assert_series_equal(got, expected, check_names=False, rtol=1e-9)


def test_missing_counts_leave_history_out(train, score):
    later = {"prev_month", "prev_logerror", "month_interval", "has_history", "num_of_nan", "row_id"}
    for frame in (train, score):
        counted = [c for c in frame.columns if c not in later and not c.endswith("_enc") and c[-3:] not in ("_10", "_11", "_12")]
        assert frame[counted].isna().sum(axis=1).tolist() == frame["num_of_nan"].tolist()


def test_encoding_leaves_the_own_fold_out(train):
    fold = [i * 5 // 300 for i in range(300)]
    key = list(zip(train.regionidcity, train.propertycountylandusecode, strict=True))
    for i in range(300):
        others = [train.logerror[j] for j in range(300) if fold[j] != fold[i] and key[j] == key[i]]
        others = [v for v in others if v == v]
        got = train["regionidcity_propertycountylandusecode_logerror_enc"][i]
        assert (got != got) if not others else got == pytest.approx(sum(others) / len(others))


def test_history_of_scoring_rows(inputs, score):
    sales = pd.concat(inputs[1].values())
    sales["block"] = pd.to_datetime(sales.transactiondate).map(lambda d: (d.year - 2016) * 12 + d.month)
    for row in score.itertuples():
        for m in (10, 11, 12):
            h = m + 12 * (row.snapshot_year - 2016)
            earlier = sales[(sales.parcelid == row.ParcelId) & (sales.block < h)]
            got = getattr(row, f"prev_month_{m}")
            assert (got != got) if earlier.empty else got == earlier.block.iloc[-1]
