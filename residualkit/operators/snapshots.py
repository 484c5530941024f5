"""Yearly snapshots of the same entities: align, repair across years, stack."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import suffix_columns
from residualkit.operators.lookup import keyed_join


def require_unique(frames: Mapping[str, tuple[DataFrame, str]]) -> None:
    """Raise if a frame has two rows of one key: joined to others, they would multiply rows silently.

    ``frames`` maps a name to a frame and its key column. One aggregation of the keys alone checks all of them;
    missing keys are not compared.
    """
    keys = [df.select(F.lit(name).alias("frame"), F.col(key).cast("string").alias("key")) for name, (df, key) in frames.items()]
    counted = reduce(DataFrame.union, keys).filter("key is not null").groupBy("frame", "key").agg(F.count(F.lit(1)).alias("n"))
    twice = counted.filter("n > 1").head(1)
    if twice:
        raise ValueError(f"{twice[0]['frame']} has {twice[0]['n']} rows with the key {twice[0]['key']}")


def align_snapshots(first: DataFrame, second: DataFrame, key: str, suffix: str, how: str = "left") -> DataFrame:
    """One row per entity with the columns of ``first`` and suffixed twins from ``second``.

    By default entities known only to ``second`` are left out; ``how="full"`` keeps them.
    """
    if how not in ("left", "full"):
        raise ValueError(f"how must be left or full, not {how}")
    return first.join(suffix_columns(second, suffix, [key]), key, how)


@dataclass(frozen=True)
class CrossFill:
    """Learned replacement per column for values missing from both snapshots."""

    suffix: str
    sentinels: Mapping[str, float | int]

    def apply(self, wide: DataFrame) -> DataFrame:
        """Each snapshot borrows the other's value, then takes the sentinel. One projection."""
        types = dict(wide.dtypes)
        filled = {}
        for name, sentinel in self.sentinels.items():
            twin = name + self.suffix
            constant = F.lit(sentinel)
            filled[name] = F.coalesce(F.col(name), F.col(twin).cast(types[name]), constant.cast(types[name]))
            filled[twin] = F.coalesce(F.col(twin), F.col(name).cast(types[twin]), constant.cast(types[twin]))
        return wide.select(*[filled.get(c, F.col(c)).alias(c) for c in wide.columns])


def fit_cross_fill(
    wide: DataFrame, columns: Sequence[str], suffix: str, default_sentinel: float | int | None = None
) -> CrossFill:
    """Learn ``min - 1`` over both snapshots for every column, in one aggregation.

    Borrowing copies values between the twins and so cannot change their joint
    minimum; the minimum is therefore taken on the frame as it stands. A column
    without any value takes ``default_sentinel``, or stays missing without one.
    """
    if not columns:
        return CrossFill(suffix, {})
    lows = [F.least(F.min(c), F.min(c + suffix)).alias(c) for c in columns]
    row = wide.agg(*lows).first()
    sentinels = {c: default_sentinel if row[c] is None else row[c] - 1 for c in columns}
    return CrossFill(suffix, sentinels)


def stack_snapshots(wide: DataFrame, key: str, suffix: str, years: tuple[int, int], year_name: str) -> DataFrame:
    """Turn aligned columns into one row per entity and year. No shuffle."""
    names = [c for c in wide.columns if c != key and not c.endswith(suffix)]
    types = dict(wide.dtypes)
    first = F.struct(F.lit(years[0]).alias(year_name), *[F.col(c).alias(c) for c in names])
    second = F.struct(
        F.lit(years[1]).alias(year_name), *[F.col(c + suffix).cast(types[c]).alias(c) for c in names]
    )
    return wide.select(key, F.inline(F.array(first, second)))


def attach_properties(rows: DataFrame, properties: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of rows to the property rows of their key and year.

    ``properties`` has one row per key; ``rows`` may repeat a key any number of times.
    """
    return keyed_join(rows, properties, on, apart=True)


def key_years(keys: DataFrame, years: Sequence[int], year_name: str) -> DataFrame:
    """Repeat every scoring key for every target year. No shuffle, no join."""
    return keys.select("*", F.explode(F.array(*[F.lit(y) for y in years])).alias(year_name))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; a column missing from one is NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
