"""Exact top-k by integer inner product, with MaxScore over inverted lists.

Components become integer impacts. A term is a dimension with a sign; the inverted list of a dimension
holds the impacts of a shard's vectors, and the largest impact of each sign bounds them. For a query, only the
terms of its own signs can add to a score; each has a score bound, query weight times largest impact.

Let a query's *floor* be a score that its k-th result is known to reach. Its terms are ordered by
bound. Where the bounds of a tail of the order add up to less than the floor, the tail is
non-essential: a vector found in those lists alone cannot get in. The terms before it are essential, and their
lists are traversed for all queries of a block in one product. Since lists are dense, traversing one costs less than
probing it for many vectors; so lists are traversed until the tail is below ``OPEN`` of the floor, which leaves few
vectors competitive: those whose score so far plus what the tail can still add reaches the floor. They are probed
for the other terms, largest bounds first, and dropped as soon as they fall below. Nothing that reaches the floor
is ever dropped, so the result is exact.

Vectors are dealt into shards, queries into blocks, and both meet slot by slot. A first round,
in which every query block meets the shards of a single slot, gives the floors; the second
meets all shards. Each shard gives at most ``k`` rows for a query, and the merge keeps the best ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import stage_python
from residualkit.llm.vectors import facing, matrix, one_per_id
from residualkit.staging import stage

SHARD = 4096
QUERY_BLOCK = 512
PROBE = 8
NO_FLOOR = np.iinfo(np.int64).min
LARGEST = float(2**63 - 1024)
EXACT = float(2**53)
OPEN = 0.25


def finite(embedding: Column) -> Column:
    """Not NULL and without NULL or non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def impacts(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as integers; what is beyond the range of long saturates."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * rows), -LARGEST, LARGEST).astype(np.int64)


class Lists:
    """The inverted lists of a shard: for each dimension the impacts of all its vectors, of both signs, and a bound for each sign.

    Nearly every vector has an impact in every dimension, so lists are kept dense.
    Scores are whole numbers below 2**53 and thus exact as doubles.
    """

    def __init__(self, ids: np.ndarray, codes: np.ndarray) -> None:
        self.ids, self.whole = ids, codes
        self.rows = codes.astype(np.float64)
        self.tops = np.stack([self.rows.max(axis=0, initial=0), -self.rows.min(axis=0, initial=0)])
        self.probed = 0

    def search(
        self, queries: np.ndarray, floors: np.ndarray, own: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, place and score of the ``k`` best vectors of each query that reach its floor, best first.

        ``own`` are the ids that do not count, one for each query.
        """
        largest = float(np.abs(queries).max(initial=0)) * float(self.tops.max(initial=0)) * max(1, queries.shape[1])
        if largest >= EXACT:
            return self._in_full(queries, floors, own, k)
        weights = queries.astype(np.float64)
        known = floors > NO_FLOOR
        found = [self._exhaustive(weights, np.flatnonzero(~known), k), self._pruned(weights, floors, np.flatnonzero(known))]
        query, place, score = (np.concatenate(c) for c in zip(*found, strict=True))
        keep = self.ids[place] != own[query]
        query, place, score = query[keep], place[keep], score[keep]
        order = np.lexsort((self.ids[place], -score, query))
        query, place, score = query[order], place[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query, "left") < k
        return query[best], place[best], score[best]

    def _exhaustive(self, weights: np.ndarray, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Without a floor all terms are essential and every vector is competitive; its ``k + 1`` best hold the ``k`` others."""
        score = weights[chosen] @ self.rows.T
        last = max(0, score.shape[1] - k - 1)
        query, place = np.nonzero(score >= np.partition(score, last, axis=1)[:, last, None])
        return chosen[query], place, score[query, place]

    def _pruned(
        self, weights: np.ndarray, floors: np.ndarray, chosen: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, dims = len(chosen), weights.shape[1]
        weights, floors = weights[chosen], floors[chosen].astype(np.float64)
        bound = np.abs(weights) * np.where(weights < 0, self.tops[1], self.tops[0])
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1)
        # tail[i, j]: what the terms from the j-th on can add at most.
        tail = np.concatenate([np.cumsum(bound[:, ::-1], axis=1)[:, ::-1], np.zeros((n, 1))], axis=1)
        reachable = np.flatnonzero(tail[:, 0] >= floors)
        # How many terms are traversed: all of them where no tail stays below the floor.
        below = tail < OPEN * floors[:, None]
        traversed = np.where(below[:, -1], np.argmax(below, axis=1), dims)
        inside = np.arange(dims)[None, :] < traversed[:, None]
        is_traversed = np.zeros((n, dims), bool)
        np.put_along_axis(is_traversed, order, inside, axis=1)
        rest = np.take_along_axis(tail, traversed[:, None], axis=1)
        most = (weights * is_traversed)[reachable] @ self.rows.T + rest[reachable]
        query, place = np.nonzero(most >= floors[reachable, None])
        most, query = most[query, place], reachable[query]
        signed = np.take_along_axis(weights, order, axis=1)
        for begin in range(int(traversed.min(initial=dims)), dims, PROBE):
            if not len(query):
                break
            part = slice(begin, begin + PROBE)
            self.probed += len(query)
            given = self.rows[place[:, None], order[query, part]] * signed[query, part]
            most = most + np.where(inside[query, part], 0, given - bound[query, part]).sum(axis=1)
            keep = most >= floors[query]
            query, place, most = query[keep], place[keep], most[keep]
        return chosen[query], place, most

    def _in_full(
        self, queries: np.ndarray, floors: np.ndarray, own: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For impacts so large that doubles would round: whole numbers of any length, saturated to the range of long."""
        found: list[tuple[int, int, int]] = []
        for q, query in enumerate(queries.tolist()):
            products = (sum(a * b for a, b in zip(row, query, strict=True)) for row in self.whole.tolist())
            scores = [max(-(2**63), min(2**63 - 1, s)) for s in products]
            at = [i for i, s in enumerate(scores) if self.ids[i] != own[q] and s >= floors[q]]
            found += [(q, i, scores[i]) for i in sorted(at, key=lambda i: (-scores[i], self.ids[i]))[:k]]
        columns = zip(*found, strict=True) if found else ((), (), ())
        return tuple(np.array(c, np.int64) for c in columns)


SHARDS = "shard long, dims int, ids binary, codes binary"


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    sizes = batch.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        yield size, pa.array(np.flatnonzero(sizes == size))


def _coded(batch: pa.RecordBatch, at: pa.Array, size: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("vec_id").take(at).to_numpy(zero_copy_only=False).astype(np.int64)
    rows = matrix(batch.column("embedding").take(at)) if size else np.zeros((len(ids), 0))
    return ids, impacts(rows, scale)


def _shards(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 36
    for batch in batches:
        for size, at in _by_length(batch):
            parts = _coded(batch, at, size, scale)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([size], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                names=[c.split()[0] for c in SHARDS.split(", ")],
            )
            number += 1


QUERIES = "query_block long, dims int, query_ids binary, queries binary, floors binary"


def _query_blocks(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 36
    for batch in batches:
        for size, at in _by_length(batch):
            ids, codes = _coded(batch, at, size, scale)
            floors = batch.column("floor").take(at).fill_null(NO_FLOOR).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([size], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in (ids, codes, floors)]],
                names=[c.split()[0] for c in QUERIES.split(", ")],
            )
            number += 1


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of a shard for each query of a block, among what reaches the floors."""
    last, lists = None, None
    for batch in batches:
        for row in batch.to_pylist():
            ids, codes, query_ids, queries, floors = (
                np.frombuffer(row[c], np.int64) for c in ("ids", "codes", "query_ids", "queries", "floors")
            )
            if lists is None or last != row["shard"]:
                last, lists = row["shard"], Lists(ids, codes.reshape(len(ids), row["dims"]))
            query, place, score = lists.search(queries.reshape(len(query_ids), row["dims"]), floors, query_ids, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids[query]), pa.array(lists.ids[place]), pa.array(score.astype(np.int64))],
                names=["query_id", "vec_id", "score"],
            )


def top_products(
    vectors: DataFrame, is_query: Column | None = None, k: int = 5, scale: int = 256
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each query, itself left out.

    Each component x counts as floor(``scale`` * x). Equal scores go to the smaller id.
    By default queries are the rows whose ``vec_id`` is divisible by 50; every row is a
    candidate. Vectors that are NULL or hold NULL or non-finite components, and rows with a NULL id, take no part;
    zero vectors do. Vectors of different lengths never meet. Rows that repeat an id are one vector (the smallest, if they
    differ). Impacts and scores beyond the range of long saturate. An empty table gives an empty result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    good = stage(one_per_id(vectors, ("embedding",)).filter(finite(F.col("embedding"))), "maxscore_vectors")
    pick = is_query if is_query is not None else F.col("vec_id") % 50 == 0
    shards = stage_python(good.mapInArrow(partial(_shards, scale=scale), SHARDS), "maxscore_shards", SHARD)
    slots = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), shards.count()))
    dealt = shards.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(slots)).cast("int"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(queries: DataFrame, where: Column, label: str) -> DataFrame:
        """The ``k`` best found of queries ``vec_id, embedding, floor`` in the slots ``where`` each block is sent to."""
        blocks = stage_python(queries.mapInArrow(partial(_query_blocks, scale=scale), QUERIES), f"{label}_queries", QUERY_BLOCK)
        met = facing(dealt, blocks, F.col("query_block"), where)
        found = stage_python(met.mapInArrow(partial(_search, k=k), "query_id long, vec_id long, score long"), label, 2)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    asked = good.filter(pick).withColumn("floor", F.lit(None).cast("long"))
    one = F.array(F.pmod(F.xxhash64("query_block"), F.lit(slots)).cast("int"))
    first = best(asked, one, "maxscore_first").filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    floored = asked.drop("floor").join(first, "vec_id", "left").select("vec_id", "embedding", "floor")
    found = best(floored, F.sequence(F.lit(0), F.lit(slots - 1)), "maxscore_found")
    return found.select("query_id", "rank", "vec_id", "score")
