"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is taken relative to the centroid of all and rotated by one random
rotation; the signs of its coordinates are its code, one bit each. Beside the
packed bits it keeps two correction scalars: its distance from the centroid and
the inner product of code and vector. From these, its inner product with a query
is estimated without the vector, with an error bound that shrinks with the number of
dimensions. ``epsilon`` scales the bound: at 4 about one estimate in 10,000 lies outside of
it, so recall is close to 1; the tests measure it against brute force.

Two passes over the codes. The first reranks, for each query and block, the ``SEEDS``
largest estimates on the original vectors; the k-th best cosine over all blocks is
the query's floor. The second reranks every vector whose upper bound reaches the floor; no
other limit applies. One floor for all blocks leaves far fewer vectors to
rerank than what each block knows by itself.

All vectors are indexed. Queries meet vectors block by block; a task sees one
block of each at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.embedding_dedup import exact_cosine
from residualkit.llm.frames import stage_python
from residualkit.llm.vectors import facing, matrix, one_per_id, summed, unit, usable
from residualkit.staging import stage

BLOCK = 2048
QUERY_BLOCK = 512
SEEDS = 16
ROUNDING = 1e-9


def random_rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centroid: np.ndarray, rotation: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the centroid, and inner products of code and direction."""
    residual = x - centroid
    distance = np.sqrt((residual * residual).sum(axis=1))
    turned = (residual / np.where(distance > 0, distance, 1)[:, None]) @ rotation
    bits = np.packbits(turned > 0, axis=1)
    return bits, distance, np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def estimate(
    query: np.ndarray,
    bits: np.ndarray,
    distance: np.ndarray,
    factor: np.ndarray,
    centroid: np.ndarray,
    rotation: np.ndarray,
    epsilon: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of unit queries with the coded vectors, and how far off they may be."""
    dims = query.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dims).astype(np.float32) * 2 - 1
    product = (query @ rotation).astype(np.float32) @ signs.T / np.sqrt(dims)
    safe = np.where(factor > 0, factor, 1)
    guess = (query @ centroid)[:, None] + product * (distance / safe)[None, :]
    spread = distance * np.sqrt(np.maximum(0, 1 - factor**2)) / safe * epsilon / np.sqrt(max(1, dims - 1))
    return guess, np.broadcast_to(spread[None, :] + 1e-6, guess.shape)


CODES = "block long, dims int, ids array<long>, vectors binary, bits binary, distance binary, factor binary"


def _index(
    batches: Iterator[pa.RecordBatch], centroids: dict[int, np.ndarray], seed: int, block: int
) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    rotations = {d: random_rotation(d, seed) for d in centroids}
    for batch in batches:
        column = batch.column(1)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            every = np.flatnonzero(sizes == size)
            for begin in range(0, len(every), block):
                at = pa.array(every[begin : begin + block])
                x = matrix(column.take(at))
                bits, distance, factor = encode(unit(x), centroids[size], rotations[size])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number]),
                        pa.array([size], pa.int32()),
                        pa.array([batch.column(0).take(at).to_pylist()]),
                        *[pa.array([v.tobytes()], pa.binary()) for v in (x, bits, distance, factor)],
                    ],
                    names=["block", "dims", "ids", "vectors", "bits", "distance", "factor"],
                )
                number += 1


def _products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs ``i, j`` of rows."""
    out = np.empty(len(i))
    for begin in range(0, len(i), 65536):
        part = slice(begin, begin + 65536)
        out[part] = np.einsum("nd,nd->n", x[i[part]], y[j[part]])
    return out


def _search(
    batches: Iterator[pa.RecordBatch], centroids: dict[int, np.ndarray], seed: int, k: int, epsilon: float
) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of each block for each query, by exact cosine, among the seeds and what may reach the floor."""
    rotations = {d: random_rotation(d, seed) for d in centroids}
    for batch in batches:
        rows = batch.to_pydict()
        for dims, qids, qraw, floors, ids, raw, bits, distance, factor in zip(
            *[rows[c] for c in ("dims", "qids", "queries", "floors", "ids", "vectors", "bits", "distance", "factor")],
            strict=True,
        ):
            q, x = (np.frombuffer(r, np.float64).reshape(-1, dims) for r in (qraw, raw))
            code = np.frombuffer(bits, np.uint8).reshape(len(x), -1)
            d, f = np.frombuffer(distance, np.float64), np.frombuffer(factor, np.float64)
            guess, spread = estimate(unit(q), code, d, f, centroids[dims], rotations[dims], epsilon)
            known_ids = np.array(ids)
            own = known_ids[None, :] == np.array(qids)[:, None]
            guess[own] = -np.inf
            chosen = guess + spread >= np.array(floors)[:, None]
            first = max(0, len(x) - max(SEEDS, k + 1))
            np.put_along_axis(chosen, np.argpartition(guess, first, axis=1)[:, first:], True, axis=1)
            at, to = np.nonzero(chosen & ~own)
            # Rerank by plain products; the k best, and what rounding cannot tell from them, are scored exactly.
            near = _products(unit(q), unit(x), at, to)
            order = np.lexsort((-near, at))
            at, to, near = at[order], to[order], near[order]
            begins = np.searchsorted(at, at, "left")
            last = np.minimum(begins + k, np.searchsorted(at, at, "right")) - 1
            close = near >= near[last] - ROUNDING
            at, to = at[close], to[close]
            score = exact_cosine(q[at], x[to])
            order = np.lexsort((known_ids[to], -score, at))
            place = np.arange(len(at)) - np.searchsorted(at[order], at[order], "left")
            best = order[place < k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(qids)[at[best]]), pa.array(known_ids[to[best]]), pa.array(score[best])],
                names=["query_id", "vec_id", "score"],
            )


QUERIES = "dims int, qids array<long>, queries binary, floors array<double>"


def _query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(1)
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            at = pa.array(np.flatnonzero(sizes == size))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size], pa.int32()),
                    pa.array([batch.column(0).take(at).to_pylist()]),
                    pa.array([matrix(column.take(at)).tobytes()], pa.binary()),
                    pa.array([batch.column(2).take(at).to_pylist()]),
                ],
                names=["dims", "qids", "queries", "floors"],
            )


def nearest(
    vectors: DataFrame, is_query: Column | None = None, k: int = 5, epsilon: float = 4.0, seed: int = 11
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query, never the query itself.

    Nearness is the cosine in double precision, ties go to the smaller id. By default queries are
    the rows whose ``vec_id`` is divisible by 50. Vectors that are NULL, empty,
    zero or hold NULL or non-finite components, and rows with a NULL id, take no
    part. Vectors of different lengths never meet. Rows that repeat an id are
    one vector (the smallest, if they differ). An empty table gives an empty
    result. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    good = stage(one_per_id(vectors, ("embedding",)).filter(usable(F.col("embedding"))), "ann_vectors")
    totals = summed(good, second=False)
    centroids = {d: own[1:] / own[0] for d, own in totals.items()}
    pick = is_query if is_query is not None else F.col("vec_id") % 50 == 0
    codes = stage_python(
        good.mapInArrow(partial(_index, centroids=centroids, seed=seed, block=BLOCK), CODES), "ann_codes", BLOCK
    )
    asked = good.filter(pick).select(F.col("vec_id").alias("query_id"), "embedding")
    find = partial(_search, centroids=centroids, seed=seed, k=k, epsilon=epsilon)
    slots = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), codes.count()))
    dealt = codes.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(queries: DataFrame, label: str) -> DataFrame:
        """The ``k`` best found of queries ``query_id, embedding, floor``."""
        blocks = stage_python(queries.mapInArrow(_query_blocks, QUERIES), f"{label}_queries", QUERY_BLOCK)
        # A query block is sent once to every slot, where it meets the code blocks of that slot.
        met = facing(dealt, blocks, F.element_at("qids", 1), F.sequence(F.lit(0), F.lit(slots - 1)))
        found = stage_python(met.mapInArrow(find, "query_id long, vec_id long, score double"), label, 2)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    seeds = best(asked.withColumn("floor", F.lit(float("inf"))), "ann_seeds")
    floors = seeds.filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    floored = asked.join(floors, "query_id", "left").fillna(float("-inf"), ["floor"])
    return best(floored, "ann_found").select("query_id", "rank", "vec_id", "score")
