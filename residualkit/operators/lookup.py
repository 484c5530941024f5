"""Left joins of a big frame to a table with one row per key.

Two situations, two operators.

``lookup_join`` attaches a *fitted* table (group means, codes, rare lists). The
table is staged already, so its size can be measured; below the session's
broadcast limit it is broadcast and the big frame is not shuffled at all. Above
the limit it goes to ``keyed_join``.

``keyed_join`` attaches a *large* table by a shuffle join. One key of the big
frame may hold a third of its rows, so keys holding at least 1/1000 of the rows
are counted first. There can be at most 1000 of them, which bounds what is
broadcast: their rows are answered from a broadcast table and are spread over
all partitions by a salt instead of meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from residualkit.functions.names import grouping_mark
from residualkit.staging import size_columns, size_of, stage

HEAVY_SHARE = 1000
SALT_BUCKETS = 4096


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 switches broadcasts off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    digits = text.removesuffix("b")
    scale = units.get(digits[-1:], 1)
    return int(digits.rstrip("kmg")) * scale


def table_bytes(table: DataFrame) -> int:
    """Unpacked size of a staged table, from one aggregate over it."""
    return size_of(list(table.agg(*size_columns(table.schema)).first()), len(table.columns))


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    null_safe: bool = False,
    at_most: int | None = None,
    heavy: list[Row] | None = None,
) -> DataFrame:
    """Left join to a staged table with one row per key; broadcast only if it is small.

    ``at_most`` is a known bound on its bytes, such as the size of a staged table
    that ``table`` is a part of. Without one that settles it, the table is measured.
    ``heavy`` are heavy keys counted beforehand; with them ``at_most`` is taken as it is.
    """
    limit = broadcast_limit(df.sparkSession)
    if limit >= 0 and (at_most is None or (at_most > limit and heavy is None)):
        at_most = table_bytes(table)
    if at_most is not None and at_most <= limit:
        return left_join(df, F.broadcast(table), on, null_safe)
    return keyed_join(df, table, on, null_safe, heavy)


def keyed_join(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    null_safe: bool = False,
    heavy: list[Row] | None = None,
    apart: bool = False,
) -> DataFrame:
    """Left join to a large table with one row per key, safe against hot keys in ``df``.

    Without ``heavy``, ``df`` is read once more for its key counts; stage it
    first if it is expensive to compute, or count before a chain of joins with
    :func:`heavy_keys_of`. With ``apart``, rows of heavy keys are not shuffled at all: they are answered
    in a part of their own, and ``df`` is read once for each part. In a chain of joins the parts would
    double with each join, so there the rows stay together and heavy ones are spread by a salt.
    """
    keys = heavy_keys(df, on) if heavy is None else heavy
    if not keys:
        return left_join(df, table, on, null_safe)
    spark = df.sparkSession
    heavy = spark.createDataFrame(keys, df.select(*on).schema)
    if apart:
        flag = F.broadcast(heavy.withColumn("_heavy", F.lit(True)))
        few = left_join(table, flag, on, null_safe=True).filter("_heavy").drop("_heavy")
        flagged = left_join(df, flag, on, null_safe=True)
        hot_rows = left_join(flagged.filter("_heavy").drop("_heavy"), F.broadcast(few), on, null_safe)
        return left_join(flagged.filter("_heavy is null").drop("_heavy"), table, on, null_safe).unionByName(hot_rows)
    payload = [c for c in table.columns if c not in on]
    packed = table.select(*on, F.struct(*payload).alias("_value"))

    flagged = left_join(df, F.broadcast(heavy.withColumn("_heavy", F.lit(True))), on, null_safe=True)
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(SALT_BUCKETS)).cast("int") + 1
    flagged = flagged.withColumn("_salt", F.when(F.col("_heavy"), spread).otherwise(F.lit(0)))

    marked = left_join(packed, F.broadcast(heavy.withColumn("_heavy", F.lit(True))), on, null_safe=True)
    hot = marked.filter(F.col("_heavy")).select(*on, F.col("_value").alias("_hot"))
    cold = marked.filter(F.col("_heavy").isNull()).select(*on, F.lit(0).alias("_salt"), F.col("_value").alias("_cold"))

    joined = left_join(flagged, F.broadcast(hot), on, null_safe)
    joined = left_join(joined, cold, [*on, "_salt"], null_safe)
    chosen = F.when(F.col("_heavy"), F.col("_hot")).otherwise(F.col("_cold"))
    helpers = ["_heavy", "_salt", "_hot", "_cold"]
    return joined.withColumn("_value", chosen).drop(*helpers).select("*", "_value.*").drop("_value")


def heavy_keys(df: DataFrame, on: Sequence[str], share: int = HEAVY_SHARE) -> list[Row]:
    """Keys of more than one row holding at least ``1/share`` of the rows, hence at most ``share`` of them."""
    return heavy_keys_of(df, [on], share)[0]


def heavy_keys_of(df: DataFrame, key_sets: Sequence[Sequence[str]], share: int = HEAVY_SHARE) -> list[list[Row]]:
    """The heavy keys of several key sets, from one pass over ``df`` with grouping sets.

    The bar follows from the number of rows alone, which the empty grouping set counts.
    """
    names = list(dict.fromkeys(c for keys in key_sets for c in keys))
    copies = {c: f"_k{i}" for i, c in enumerate(names)}
    narrow = df.select(*[F.col(f"`{c}`").alias(n) for c, n in copies.items()])
    sets = [[F.col(copies[c]) for c in keys] for keys in key_sets]
    counted = narrow.groupingSets([*sets, []], *[F.col(n) for n in copies.values()]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")
    )
    everything = grouping_mark(names, [])
    counts = stage(counted, "key_counts")
    total = counts.filter(F.col("_set") == everything).agg(F.max("_rows")).first()[0] or 0
    bar = max(2, -(-total // share))
    found = counts.filter((F.col("_rows") >= bar) & (F.col("_set") != everything)).collect()
    marks = [grouping_mark(names, keys) for keys in key_sets]
    return [
        [Row(*[r[copies[c]] for c in keys]) for r in found if r["_set"] == mark]
        for keys, mark in zip(key_sets, marks, strict=True)
    ]


def set_sizes(table: DataFrame) -> dict[int, int]:
    """Unpacked size of every part of a table that is marked by ``_set``, from one aggregate over it."""
    rows = table.groupBy("_set").agg(*size_columns(table.schema)).collect()
    return {r["_set"]: size_of(list(r)[1:], len(table.columns)) for r in rows}


def lookup_chain(
    df: DataFrame,
    tables: Sequence[tuple[DataFrame, Sequence[str], bool]],
    sizes: Sequence[int],
) -> DataFrame:
    """Left join ``df`` to several tables ``(table, keys, null safe)`` of the given sizes, one after the other.

    Heavy keys of all tables that are too large to broadcast are counted once,
    on ``df`` as it comes in, and not again on the growing chain of joins.
    """
    limit = broadcast_limit(df.sparkSession)
    large = [i for i, size in enumerate(sizes) if size > limit]
    heavy = dict(zip(large, heavy_keys_of(df, [tables[i][1] for i in large]), strict=True)) if large else {}
    for i, (table, on, null_safe) in enumerate(tables):
        if i in heavy:
            df = keyed_join(df, table, on, null_safe, heavy[i])
        else:
            df = left_join(df, F.broadcast(table), on, null_safe)
    return df


def left_join(df: DataFrame, table: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Plain left join on equally named keys: the columns of ``df``, then the others of ``table``."""
    renamed = table.withColumnsRenamed({k: f"_right_{k}" for k in on})
    equal = "<=>" if null_safe else "="
    match = " and ".join(f"`{k}` {equal} `_right_{k}`" for k in on)
    return df.join(renamed, F.expr(match), "left").drop(*[f"_right_{k}" for k in on])
