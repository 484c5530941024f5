"""Helpers over column names and schemas. They run on the driver and read no rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str]) -> DataFrame:
    """Append ``suffix`` to every column name except the ones in ``keep``."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(c + suffix) for c in df.columns])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    names = {c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix)}
    return df.withColumnsRenamed(names)


def split_by_suffix(df: DataFrame, suffix: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split a wide frame into its plain half and its suffixed half, both with the keys."""
    plain = [c for c in df.columns if not c.endswith(suffix)]
    marked = [c for c in df.columns if c.endswith(suffix)]
    return df.select(*plain), strip_suffix(df.select(*keys, *marked), suffix)


def columns_matching(columns: Iterable[str], parts: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    """Columns whose name holds any of ``parts``, without the excluded ones."""
    return [c for c in columns if any(p in c for p in parts) and c not in exclude]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given names that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def move_to_end(df: DataFrame, names: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, *names)


def require(df: DataFrame, names: Sequence[str], what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing or not names:
        raise ValueError(f"{what}: need columns {list(names)}, missing {missing}")


def grouping_mark(keys: Sequence[str], chosen: Sequence[str]) -> int:
    """The ``grouping_id`` of a grouping set: one bit per key, set where it is left out."""
    mark = 0
    for k in keys:
        mark = mark * 2 + (0 if k in chosen else 1)
    return mark
