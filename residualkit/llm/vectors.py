"""What the vector operators share: usable vectors, unit rows, blocks of rows and how they meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns

TOGETHER = 64


def usable(embedding: Column) -> Column:
    """Neither NULL, empty nor zero, and without NULL or non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False))


def one_per_id(vectors: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``vec_id`` and the named columns, one row for each id that is not NULL.

    Rows that repeat an id are one vector; if they differ, the smallest row by
    the named columns counts.
    """
    rows = first_columns(vectors, ["vec_id", *columns]).withColumn("vec_id", F.col("vec_id").cast("long"))
    packed = rows.filter("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct(*columns)).alias("r"))
    return packed.select("vec_id", "r.*")


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else values.reshape(0, 0)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1. Scaled by the largest component first, so that nothing overflows or vanishes."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def sums(batches: Iterator[pa.RecordBatch], second: bool) -> Iterator[pa.RecordBatch]:
    """For each dimension count: the sum of the unit vectors and, if asked for, of their outer products, cell by cell.

    Input: one column ``embedding``. A task gives at most one row for each cell.
    """
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        column = batch.column(0)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            x = unit(matrix(column.filter(pa.array(sizes == size))))
            own = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()]) if second else np.append(len(x), x.sum(axis=0))
            totals[int(size)] = totals.get(int(size), 0) + own
    for size, own in totals.items():
        n = len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, size, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(own)],
            names=["dims", "cell", "v"],
        )


def summed(vectors: DataFrame, second: bool) -> dict[int, np.ndarray]:
    """Totals of :func:`sums` over all rows; their size is bounded by the dimensions, not by the rows."""
    from functools import partial

    cells = vectors.select("embedding").mapInArrow(partial(sums, second=second), "dims int, cell int, v double")
    rows = cells.groupBy("dims", "cell").agg(F.sum("v").alias("v")).collect()
    found: dict[int, dict[int, float]] = {}
    for r in rows:
        found.setdefault(r["dims"], {})[r["cell"]] = r["v"]
    return {d: np.array([own[i] for i in range(len(own))]) for d, own in found.items()}


def facing(stored: DataFrame, blocks: DataFrame, number: Column, slots: Column) -> DataFrame:
    """Every query block beside the stored blocks of its dimension count in each of its ``slots``.

    ``stored`` has a ``slot``; ``number`` tells query blocks apart. It is always a shuffle join: a table of copies counts for the
    optimizer no more than one copy of each, so it would be gathered on the driver and broadcast however
    large it is. Query blocks meet in groups of about ``TOGETHER``, which bounds what a task holds of them.
    """
    groups = max(1, -(-blocks.count() // TOGETHER))
    sent = blocks.withColumn("group", F.pmod(F.xxhash64(number), F.lit(groups)).cast("int")).withColumn("slot", F.explode(slots))
    every = stored.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return every.join(sent.hint("merge"), ["slot", "group", "dims"]).drop("group")
