"""Positions and neighbours in a total order, without a single-task window.

A window over everything runs in one task, and a window per key runs a hot key
in one task. Both are replaced by range blocks: rows are range-partitioned by
their order, the block number is stored with each row in a staged table, and
what crosses a block edge is patched from a table with two rows per block.
The number of blocks is the number of shuffle partitions, so every small table
here is bounded by that and not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from residualkit.functions.names import require
from residualkit.staging import stage

HEAVY_GROUPS = 200
_LOCAL_BITS = (1 << 33) - 1


def ordered_blocks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, staged with the block
    number ``_block`` and the 0-based place within it ``_place``."""
    require(df, order, "an order is needed because rows have none of their own")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row_number = F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS))
    marked = ranged.select(*df.columns, F.spark_partition_id().alias("_block"), row_number.alias("_place"))
    return stage(marked, "blocks")


def block_starts(blocks: DataFrame) -> list[tuple[int, int, int]]:
    """``(block, first index, rows)`` per block: one small row per shuffle partition."""
    counted = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("rows")).collect()
    starts, index = [], 0
    for row in sorted(counted, key=lambda r: r["_block"]):
        starts.append((row["_block"], index, row["rows"]))
        index += row["rows"]
    return starts


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add the 0-based index of each row in ``order``."""
    blocks = ordered_blocks(df, order)
    starts = [(block, first) for block, first, _ in block_starts(blocks)]
    offsets = df.sparkSession.createDataFrame(starts, "_block int, _first long")
    joined = blocks.join(F.broadcast(offsets), "_block")
    return joined.select(*df.columns, (F.col("_first") + F.col("_place")).alias(name))


def rows_at(blocks: DataFrame, starts: list[tuple[int, int, int]], positions: Sequence[int]) -> dict[int, Row]:
    """The rows at the given 0-based positions of staged blocks; as many rows as positions."""
    wanted = F.lit(False)
    first_of = {block: first for block, first, _ in starts}
    for position in positions:
        for block, first, rows in starts:
            if first <= position < first + rows:
                wanted = wanted | ((F.col("_block") == block) & (F.col("_place") == position - first))
    return {first_of[r["_block"]] + r["_place"]: r for r in blocks.filter(wanted).collect()}


def number_and_previous(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    previous: Mapping[str, str],
    number: str,
) -> DataFrame:
    """Number the rows of each group in ``order`` and fetch values of the row before.

    ``previous`` maps a new column to the column whose preceding value it takes.
    The preceding row counts even where its value is NULL. Rows whose group is
    NULL belong to no group and get NULL.

    Equal to ``row_number`` and ``lag`` over ``partitionBy(group)``. Groups are
    counted once. Those holding at least 1/``HEAVY_GROUPS`` of the rows are cut
    at range-block edges, so one with a third of the rows is spread over a third
    of the blocks; all others take that window, with one shuffle.
    """
    require(df, order, "an order is needed because rows have none of their own")
    rows = stage(df, "ordered")
    counted = rows.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    counts = stage(counted, "group_counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    heavy = counts.filter(F.col("_rows") >= max(2, -(-total // HEAVY_GROUPS))).select(group)
    if not heavy.head(1):
        return numbered_by_window(rows, group, order, previous, number)
    hot = F.broadcast(heavy)
    cold = numbered_by_window(rows.join(hot, group, "left_anti").select(*df.columns), group, order, previous, number)
    return cold.unionByName(_by_blocks(rows.join(hot, group, "left_semi").select(*df.columns), group, order, previous, number))


def numbered_by_window(
    rows: DataFrame, group: str, order: Sequence[str], previous: Mapping[str, str], number: str
) -> DataFrame:
    """Number and previous values by a window over each group; none for rows without a group."""
    # Rows without a group are windows of their own, so that they do not meet in one task.
    alone = F.when(F.col(group).isNull(), F.struct(*[F.col(c) for c in order]))
    in_group = Window.partitionBy(group, alone).orderBy(*order)
    known = F.col(group).isNotNull()
    return rows.select(
        *rows.columns,
        F.when(known, F.row_number().over(in_group)).cast("long").alias(number),
        *[F.when(known, F.lag(source).over(in_group)).alias(name) for name, source in previous.items()],
    )


def _by_blocks(
    df: DataFrame, group: str, order: Sequence[str], previous: Mapping[str, str], number: str
) -> DataFrame:
    """The same for groups of any size, by range blocks."""
    values = F.struct(*[F.col(source).alias(name) for name, source in previous.items()])
    blocks = ordered_blocks(df, [group, *order])
    within = Window.partitionBy("_block", group).orderBy("_place")
    local = blocks.select(
        *df.columns,
        "_block",
        F.row_number().over(within).alias("_local"),
        F.lag(values).over(within).alias("_before"),
    )

    edges = _edge_groups(blocks, group, values)
    over_blocks = Window.partitionBy(group).orderBy("_block")
    earlier = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        "_block",
        group,
        F.sum("_rows").over(earlier).alias("_carried_rows"),
        F.lag("_last").over(over_blocks).alias("_carried"),
    ).filter(F.col("_carried_rows").isNotNull())

    joined = local.join(F.broadcast(carried), ["_block", group], "left")
    before = F.when(F.col("_local") == 1, F.col("_carried")).otherwise(F.col("_before"))
    place = (F.col("_local") + F.coalesce(F.col("_carried_rows"), F.lit(0))).cast("long")
    return joined.select(
        *df.columns,
        place.alias(number),
        *[before[name].alias(name) for name in previous],
    )


def _edge_groups(blocks: DataFrame, group: str, values: Column) -> DataFrame:
    """Rows and last values of the first and the last group of every block.

    Only these can continue in another block. At most two rows per block.
    """
    ends = blocks.groupBy("_block").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
    at_edge = (F.col(group) == F.col("_low")) | (F.col(group) == F.col("_high"))
    return (
        blocks.join(F.broadcast(ends), "_block")
        .filter(at_edge)
        .groupBy("_block", group)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max_by(values, F.col("_place")).alias("_last"))
    )
