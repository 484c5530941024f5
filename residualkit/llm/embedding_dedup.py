"""Near-duplicate vectors: tiles in principal-component order, compared dimension group by dimension group.

1. Equal vectors of a label are collapsed to the smallest id with a count.
2. Principal axes come from the sum of outer products, one bounded table. A
   rotation onto them keeps every inner product and moves most of the length of
   a vector into its first coordinates.
3. Vectors are range-sorted by label and first coordinate and cut into tiles. The
   tiles of a label are cut into groups of neighbours, and a pair of groups is the unit
   of work: a tile is sent once to each unit whose other group is close enough for
   the threshold in the leading coordinates, whatever the number of tiles there. Within a
   unit two tiles meet only if their own boxes are that close.
4. Within a pair of tiles, products of the leading coordinates are accumulated
   first. What the remaining coordinates can add is at most the product of the
   norms of the two suffixes; a pair is given up as soon as even that does not reach
   the threshold. The last few survivors are settled on the original vectors.
5. A pair of tiles leaves only a count for each vector and a spanning forest of
   its links, however many links there are; alternating star steps join the
   forests to components.

Within one label all tiles whose boxes are close are compared, as the task asks. A
label has about the square root of twice the shuffle partitions in groups, so that a label with
a third of all rows is spread over all of them and a tile is copied that many times at
most; only beyond ``GROUP_BYTES`` a group are there more groups. A task holds one group and one
tile of the other. Groups find each other by number, not by label, so no label is a join key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import stage_python
from residualkit.llm.graph import components
from residualkit.llm.vectors import matrix, one_per_id, summed, unit, usable
from residualkit.staging import stage

TILE = 1024
GROUP_BYTES = 32 << 20
BOX = 8
STEPS = (16, 32)
MARGIN = 1e-9


def axes(totals: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Principal axes by number of dimensions, as columns, those with the largest second moment first."""
    found = {}
    for dims, own in totals.items():
        moments = own[1 + dims :].reshape(dims, dims)
        values, vectors = np.linalg.eigh((moments + moments.T) / 2)
        found[dims] = vectors[:, np.argsort(-values, kind="stable")]
    return found


def _lead(batches: Iterator[pa.RecordBatch], rotation: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Add the first principal coordinate."""
    for batch in batches:
        column = batch.column(3)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        lead = np.zeros(batch.num_rows)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            lead[at] = unit(matrix(column.take(pa.array(at)))) @ rotation[int(size)][:, 0]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(sizes.astype(np.int32)), pa.array(lead)],
            names=["id", "copies", "label", "embedding", "dims", "lead"],
        )


TILES = (
    "tile long, part int, seq int, label string, dims int, low array<double>, high array<double>, "
    "ids array<long>, copies array<long>, vectors binary"
)


def _tiles(batches: Iterator[pa.RecordBatch], rotation: dict[int, np.ndarray], tile: int) -> Iterator[pa.RecordBatch]:
    """Cut sorted rows into tiles of one label and dimension count; ``seq`` counts those of a label within the task."""
    part = TaskContext.get().partitionId()
    number, seq = part << 32, 0
    held: list[pa.RecordBatch] = []
    key = None

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal number, seq
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        x = matrix(rows.column("embedding"))
        box = (unit(x) @ rotation[x.shape[1]])[:, :BOX]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([key[0]]),
                pa.array([key[1]], pa.int32()),
                pa.array([box.min(axis=0).tolist()]),
                pa.array([box.max(axis=0).tolist()]),
                pa.array([rows.column("id").to_pylist()]),
                pa.array([rows.column("copies").to_pylist()]),
                pa.array([x.tobytes()], pa.binary()),
            ],
            names=["tile", "part", "seq", "label", "dims", "low", "high", "ids", "copies", "vectors"],
        )
        number += 1
        seq += 1

    filled = 0
    for batch in batches:
        labels, dims = batch.column("label").to_pylist(), batch.column("dims").to_pylist()
        begin = 0
        while begin < batch.num_rows:
            now = (labels[begin], dims[begin])
            if now != key or filled == tile:
                yield from close()
                seq = seq if now == key else 0
                key, filled = now, 0
            end = begin
            while end < batch.num_rows and filled < tile and (labels[end], dims[end]) == key:
                end += 1
                filled += 1
            held.append(batch.slice(begin, end - begin))
            begin = end
    yield from close()


def close_pairs(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of rotated unit rows with a product of at least ``threshold`` less a rounding margin."""
    dims = x.shape[1]
    cuts = [s for s in STEPS if s < dims] + [dims]
    left, right = (np.sqrt(np.maximum(0, (v[:, cuts[0] :] ** 2).sum(axis=1))) for v in (x, y))
    partial_sum = x[:, : cuts[0]] @ y[:, : cuts[0]].T
    possible = partial_sum + np.outer(left, right) >= threshold - MARGIN
    if same:
        possible &= np.tri(len(x), len(y), -1, dtype=bool).T
    i, j = np.nonzero(possible)
    total = partial_sum[i, j]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        if not len(i):
            break
        more = np.empty(len(i))
        for at in range(0, len(i), 65536):
            part = slice(at, at + 65536)
            more[part] = np.einsum("nd,nd->n", x[i[part], begin:end], y[j[part], begin:end])
        total = total + more
        left, right = (np.sqrt(np.maximum(0, (v[:, end:] ** 2).sum(axis=1))) for v in (x, y))
        keep = total + left[i] * right[j] >= threshold - MARGIN
        i, j, total = i[keep], j[keep], total[keep]
    return i, j


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of paired original rows, summed from the first component to the last."""
    dot, xx, yy = (np.cumsum(v, axis=1)[:, -1] for v in (x * y, x * x, y * y))
    return dot / (np.sqrt(xx) * np.sqrt(yy))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row number that each of ``n`` rows reaches over the links ``i``-``j``."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, i, before[j])
        np.minimum.at(least, j, least[i])
        least = least[least]
        if np.array_equal(least, before):
            return least


@dataclass(frozen=True)
class Tile:
    """A tile in a task: ids, counts, vectors as they are, and unit vectors on the principal axes."""

    number: int
    low: np.ndarray
    high: np.ndarray
    ids: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray
    turned: np.ndarray


def _links(one: Tile, two: Tile, threshold: float) -> pa.RecordBatch | None:
    """Rows ``(a, b, n)``: a link of the spanning forest (b given) or a number of links of ``a`` (b NULL)."""
    same = one is two
    i, j = close_pairs(one.turned, two.turned, threshold, same)
    keep = np.ones(len(i), bool)
    for at in range(0, len(i), 65536):
        part = slice(at, at + 65536)
        keep[part] = exact_cosine(one.vectors[i[part]], two.vectors[j[part]]) >= threshold
    i, j = i[keep], j[keep]
    if not len(i):
        return None
    a, b = one.ids, two.ids
    n_one = np.bincount(i, two.copies[j], len(a)).astype(np.int64)
    n_two = np.bincount(j, one.copies[i], len(b)).astype(np.int64)
    every = a if same else np.concatenate([a, b])
    root = forest(len(every), i, j + (0 if same else len(a)))
    child = np.flatnonzero(root != np.arange(len(every)))
    at, bt = np.flatnonzero(n_one), np.flatnonzero(n_two)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([every[child], a[at], b[bt]])),
            pa.concat_arrays([pa.array(every[root[child]]), pa.nulls(len(at) + len(bt), pa.int64())]),
            pa.array(np.concatenate([np.zeros(len(child), np.int64), n_one[at], n_two[bt]])),
        ],
        names=["a", "b", "n"],
    )


def _compare(
    batches: Iterator[pa.RecordBatch], rotation: dict[int, np.ndarray], threshold: float
) -> Iterator[pa.RecordBatch]:
    """Links of the units of a task. Rows come unit by unit, the tiles of the first group (``side`` 0) before the others.

    The first group is held, the tiles of the second pass by. In a unit of a group with itself all tiles are of side 0.
    """
    unit_key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            dims = row["dims"]
            x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dims)
            now = Tile(
                row["tile"],
                np.array(row["low"]),
                np.array(row["high"]),
                np.array(row["ids"], np.int64),
                np.array(row["copies"], np.int64),
                x,
                unit(x) @ rotation[dims],
            )
            key = (row["label"], dims, row["one"], row["two"])
            if key != unit_key:
                unit_key, held = key, []
            own = row["side"] == 0
            if own and key[2] == key[3]:
                partners = [*held, now]
            else:
                partners = [] if own else held
            for tile in partners:
                apart = np.maximum(0, np.maximum(tile.low - now.high, now.low - tile.high))
                if (apart**2).sum() <= 2 - 2 * threshold + MARGIN:
                    found = _links(tile, now, threshold)
                    if found is not None:
                        yield found
            if own:
                held.append(now)


def _between(low: str, high: str, low2: str, high2: str) -> Column:
    """Squared distance of two boxes."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(low) - 1),
        F.lit(0.0),
        lambda acc, k: acc
        + F.pow(F.greatest(F.lit(0.0), F.col(low)[k] - F.col(high2)[k], F.col(low2)[k] - F.col(high)[k]), F.lit(2)),
    )


def group_tiles(tiles: DataFrame, slots: int, tile: int = TILE) -> DataFrame:
    """``tile, label, dims, low, high, grp, last``: the tiles of a label in order, cut into groups of neighbours 0 to ``last``.

    About ``sqrt(2 * slots)`` groups a label, so that their pairs are about ``slots``, and more where a group would pass ``GROUP_BYTES``.
    """
    key = ["label", "dims"]
    spans = tiles.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    # At most one row a label and partition of the range sort.
    label = Window.partitionBy(*key)
    before = F.sum("n").over(label.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(*key, "part", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(label).alias("total"))
    size = F.ceil(F.col("total") / F.lit(math.ceil(math.sqrt(2 * slots))))
    most = F.greatest(F.lit(1), F.floor(F.lit(GROUP_BYTES) / (F.col("dims") * F.lit(8 * tile))))
    spans = spans.withColumn("size", F.least(size, most))
    group = F.floor((F.col("start") + F.col("seq")) / F.col("size")).cast("long")
    last = F.floor((F.col("total") - 1) / F.col("size")).cast("long")
    return tiles.select("tile", *key, "part", "seq", "low", "high").join(spans, [*key, "part"]).select(
        "tile", *key, "low", "high", group.alias("grp"), last.alias("last")
    )


def _sent(grouped: DataFrame, reach: float) -> DataFrame:
    """``tile, one, two, side``: the units, pairs of groups, that a tile is sent to."""
    key = ["label", "dims"]
    width = F.size(F.first("low")).alias("width")
    low = [F.min(F.get("low", F.lit(k))).alias(f"l{k}") for k in range(BOX)]
    high = [F.max(F.get("high", F.lit(k))).alias(f"h{k}") for k in range(BOX)]
    groups = grouped.groupBy(*key, "grp", "last").agg(width, *low, *high)
    groups = groups.select(
        *key,
        "grp",
        "last",
        F.slice(F.array(*[f"l{k}" for k in range(BOX)]), F.lit(1), F.col("width")).alias("low"),
        F.slice(F.array(*[f"h{k}" for k in range(BOX)]), F.lit(1), F.col("width")).alias("high"),
    )
    groups = stage(groups, "tile_groups")
    first = groups.withColumn("two", F.explode(F.sequence("grp", "last"))).withColumnRenamed("grp", "one")
    second = groups.select(*key, F.col("grp").alias("two"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    units = first.join(second, [*key, "two"]).filter(_between("low", "high", "low2", "high2") <= reach)
    # A tile goes to a unit only if it is close to the box of the other group.
    to_first = units.select(*key, F.col("one").alias("grp"), "one", "two", F.lit(0).alias("side"), "low2", "high2")
    to_second = units.filter("one < two").select(
        *key, F.col("two").alias("grp"), "one", "two", F.lit(1).alias("side"), F.col("low").alias("low2"), F.col("high").alias("high2")
    )
    sent = grouped.drop("last").join(to_first.unionByName(to_second), [*key, "grp"]).filter(_between("low", "high", "low2", "high2") <= reach)
    return sent.select("tile", "one", "two", "side")


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per vector id: number of links, smallest id reachable over links, and whether it is that id.

    Two vectors are linked if their labels are equal and not NULL and their
    cosine, in double precision, is at least ``threshold``. Vectors of different
    lengths are never linked.

    Returns ``vec_id, n_links, component_id, kept``. Vectors that are NULL,
    empty, zero or hold NULL or non-finite components, and those without a
    label, are linked with nothing and kept. Rows that repeat an id are one vector (the smallest by
    label and embedding, if they differ). Rows with a NULL id are linked with
    nothing, have a NULL component and are kept, row by row. An empty table
    gives an empty result. Other columns are not looked at.
    """
    rows = stage(one_per_id(vectors, ("label", "embedding")).withColumn("label", F.col("label").cast("string")), "vectors")
    good = rows.filter(F.col("label").isNotNull() & usable(F.col("embedding")))
    reps = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    reps = stage(reps.select("id", "copies", "label", "embedding"), "distinct_vectors")
    again = reps.filter("copies > 1").withColumnRenamed("id", "rep").select("rep", "copies", "label", "embedding")
    alias = stage(good.join(again, ["label", "embedding"]).select("vec_id", "rep", "copies"), "vector_copies")

    rotation = axes(summed(reps, second=True))
    leads = reps.mapInArrow(
        partial(_lead, rotation=rotation),
        f"id long, copies long, label string, embedding {reps.schema['embedding'].dataType.simpleString()}, dims int, lead double",
    )
    order = ["label", "dims", "lead", "id"]
    ranged = stage_python(leads, "leads", 4096).repartitionByRange(*order).sortWithinPartitions(*order)
    tiles = stage_python(ranged.mapInArrow(partial(_tiles, rotation=rotation, tile=tile), TILES), "tiles", 1024)

    slots = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = _sent(stage(group_tiles(tiles, slots, tile), "grouped_tiles"), 2 - 2 * threshold + MARGIN)
    unit_key = ["label", "dims", "one", "two"]
    facing = tiles.drop("part", "seq").join(sent, "tile").repartition(slots, *unit_key)
    facing = facing.sortWithinPartitions(*unit_key, "side", "tile")
    compare = partial(_compare, rotation=rotation, threshold=threshold)
    found = stage_python(facing.mapInArrow(compare, "a long, b long, n long"), "vector_links", 2)

    counts = found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    edges = found.filter("b is not null").select("a", "b")
    edges = edges.unionByName(alias.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    reached = stage(components(edges), "vector_components")
    named = rows.select("vec_id").join(alias, "vec_id", "left")
    lead_id = F.coalesce("rep", "vec_id")
    component = F.coalesce("component", "vec_id")
    answered = (
        named.withColumn("a", lead_id)
        .join(counts, "a", "left")
        .join(reached.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
            component.alias("component_id"),
            (F.col("vec_id") == component).alias("kept"),
        )
    )
    nameless = vectors.filter(F.col("vec_id").isNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return answered.unionByName(nameless)
