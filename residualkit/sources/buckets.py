"""Tables bucketed by a key: written once, then joined and windowed by that key without moving rows.

Rows of one key lie in one bucket, and buckets of two tables with equal counts face each other, so a
join or a window by the key needs no exchange. A key that holds at least 1/1000 of the rows would
fill one bucket and one task. Its rows, and rows without a key, are written to a table of their own that
is not bucketed; joins answer them from a broadcast of at most 1000 rows and windows by range blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from residualkit.operators.lookup import heavy_keys, left_join
from residualkit.operators.ordering import number_and_previous, numbered_by_window
from residualkit.staging import stage, staged_folder


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: ``even`` is bucketed and sorted by the key, ``hot`` is not (None: no such rows)."""

    key: str
    buckets: int
    even: str
    hot: DataFrame | None
    heavy: tuple[object, ...] = ()

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows of the table."""
        even = spark.table(self.even)
        return even if self.hot is None else even.unionByName(self.hot)


def write_bucketed(
    df: DataFrame, key: str, buckets: int, order: Sequence[str] = (), path: str | None = None, split_heavy: bool = True
) -> Bucketed:
    """Write ``df`` in ``buckets`` buckets by ``key``, each one file, sorted by the key and ``order``.

    Files go to ``path``, or to the staging folder; the table is known to the session's catalog under a name of its own.
    ``split_heavy=False`` is for tables with one row a key, which are not read for heavy keys.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = stage(df, "to_bucket") if split_heavy else df
    keys = [r[0] for r in heavy_keys(rows.filter(F.col(key).isNotNull()), [key])] if split_heavy else []
    apart = F.col(key).isNull() | (F.col(key).isin(keys) if keys else F.lit(False))
    hot = stage(rows.filter(apart), "hot_rows") if split_heavy else None
    even = rows.filter(~apart) if split_heavy else rows
    dealt = even.repartition(buckets, key)
    writer = dealt.write.bucketBy(buckets, key).sortBy(key, *order).option("path", f"{path or staged_folder(spark)}/{name}")
    writer.format("parquet").saveAsTable(name)
    if hot is not None and not hot.head(1):
        hot = None
    return Bucketed(key, buckets, name, hot, tuple(keys))


def join_bucketed(left: Bucketed, right: Bucketed, spark: SparkSession) -> DataFrame:
    """Left join of two tables bucketed alike; ``right`` has one row a key. No row of the bucketed parts is moved."""
    if (left.key, left.buckets) != (right.key, right.buckets):
        raise ValueError("both tables must be bucketed by the same key into as many buckets")
    listed = spark.table(right.even)
    even = left_join(spark.table(left.even).hint("merge"), listed.hint("merge"), [left.key])
    if left.hot is None:
        return even
    few = listed.filter(F.col(right.key).isin(list(left.heavy)) if left.heavy else F.lit(False))
    return even.unionByName(left_join(left.hot, F.broadcast(few), [left.key]))


def number_bucketed(
    table: Bucketed, order: Sequence[str], previous: Mapping[str, str], number: str, spark: SparkSession
) -> DataFrame:
    """Number the rows of each key and fetch values of the row before, as :func:`number_and_previous` does.

    The bucketed part takes a window by the key without an exchange.
    """
    even = numbered_by_window(spark.table(table.even), table.key, order, previous, number)
    if table.hot is None:
        return even
    return even.unionByName(number_and_previous(table.hot, table.key, order, previous, number))


def drop_bucketed(table: Bucketed, spark: SparkSession) -> None:
    """Take the table out of the session's catalog; its files stay where they are."""
    spark.sql(f"drop table if exists {table.even}")
