"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

1. Word vectors. A word falls into one of ``2**BITS`` buckets by its hash and has
   a sparse random index vector. Its word vector is the sum of the index vectors
   of the words around it, over all texts: one pass, with partial sums a task,
   summed by bucket in Spark. The table has a fixed size.
2. Pooling. A text is the weighted mean of its word vectors, and of the products
   of neighbouring ones, so that it also sees repetition. Frequent words weigh less.
3. Network. One hidden layer and a sigmoid, learned on a bounded sample of
   labelled rows. A temperature is then fitted on a part of that sample that the
   network has not seen, so that scores are probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import first_columns, stage_python
from residualkit.llm.labelled import held_out, training_rows
from residualkit.llm.words import hashed_runs, mix, text_buffer, token_classes

BITS, DIMS, NONZERO, WINDOW = 14, 32, 4, 2
SAMPLE = 20_000
RARE = 1e-3


def index_vectors(seed: int) -> np.ndarray:
    """Sparse vectors of -1, 0 and 1 for every bucket."""
    rng = np.random.default_rng(seed)
    table = np.zeros((1 << BITS, DIMS), np.int8)
    places = np.argsort(rng.random((1 << BITS, DIMS)), axis=1)[:, :NONZERO]
    signs = rng.choice(np.array([-1, 1], np.int8), (1 << BITS, NONZERO))
    np.put_along_axis(table, places, signs, axis=1)
    return table


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token (words, numbers, runs of signs) of every text, and the bounds of the texts."""
    tokens, bounds = hashed_runs(*text_buffer(column), token_classes)
    return (tokens >> np.uint64(64 - BITS)).astype(np.uint16), bounds


COLUMNS = ["bucket", "n", *[f"d{i}" for i in range(DIMS)]]
PIECE = 1 << 17


def _contexts(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket seen by the task: occurrences and the sum of the neighbours' index vectors."""
    index = index_vectors(seed)
    total = np.zeros((1 << BITS, DIMS), np.int64)
    seen = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        own, bounds = buckets(batch.column(0))
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        seen += np.bincount(own, minlength=1 << BITS)
        for begin in range(0, len(own), PIECE):
            end = min(len(own), begin + PIECE)
            low, high = max(0, begin - WINDOW), min(len(own), end + WINDOW)
            around = np.zeros((high - low, DIMS), np.int16)
            near, where = index[own[low:high]].astype(np.int16), text[low:high]
            for gap in range(1, WINDOW + 1):
                same = (where[gap:] == where[:-gap])[:, None]
                around[gap:] += near[:-gap] * same
                around[:-gap] += near[gap:] * same
            inner = around[begin - low : end - low]
            order = np.argsort(own[begin:end], kind="stable")
            sorted_own = own[begin:end][order]
            cuts = np.flatnonzero(np.append(True, sorted_own[1:] != sorted_own[:-1]))
            total[sorted_own[cuts]] += np.add.reduceat(inner[order], cuts, axis=0, dtype=np.int64)
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at), pa.array(seen[at]), *[pa.array(total[at, d]) for d in range(DIMS)]], names=COLUMNS
    )


@dataclass(frozen=True)
class WordVectors:
    """Weighted unit vectors of all buckets, and their weights."""

    vectors: np.ndarray
    weights: np.ndarray


def fit_word_vectors(texts: DataFrame, seed: int = 5) -> WordVectors:
    """Word vectors from all texts. What is collected has ``2**BITS`` rows at most."""
    schema = ", ".join(f"{c} long" for c in COLUMNS)
    partials = stage_python(texts.select("text").mapInArrow(partial(_contexts, seed=seed), schema), "contexts", 512)
    rows = partials.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in COLUMNS[1:]]).toArrow()
    at = rows.column("bucket").to_numpy()
    count = np.zeros(1 << BITS)
    count[at] = rows.column("n").to_numpy()
    vectors = np.zeros((1 << BITS, DIMS))
    for d in range(DIMS):
        vectors[at, d] = rows.column(f"d{d}").to_numpy()
    length = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    vectors /= np.where(length > 0, length, 1)
    weights = RARE / (RARE + count / max(1.0, count.sum()))
    return WordVectors(vectors.astype(np.float32), weights.astype(np.float32))


def pool(column: pa.Array, words: WordVectors) -> np.ndarray:
    """One row per text: mean word vector, mean product of neighbours, and log length. Empty texts are zero."""
    own, bounds = buckets(column)
    n = len(bounds) - 1
    out = np.zeros((n, 2 * DIMS + 1), np.float32)
    for i in range(n):
        at = own[bounds[i] : bounds[i + 1]]
        if not len(at):
            continue
        total, pairs, weight = np.zeros(DIMS), np.zeros(DIMS), 0.0
        for begin in range(0, len(at), PIECE):
            part = at[begin : begin + PIECE + 1]
            w = words.weights[part][:, None]
            v = words.vectors[part] * w
            total += v[:PIECE].sum(axis=0)
            weight += float(w[:PIECE].sum())
            pairs += (v[1:] * v[:-1]).sum(axis=0)
        out[i, :DIMS] = total / weight
        out[i, DIMS : 2 * DIMS] = pairs / weight
        out[i, -1] = np.log1p(len(at))
    return out


@dataclass(frozen=True)
class Network:
    """Standardisation, two layers, and the temperature."""

    center: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature on the last fifth.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    features = x.shape[1]
    center = x.mean(axis=0) if len(x) else np.zeros(features)
    scale = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1) if len(x) else np.ones(features)
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Network(center, scale, (np.zeros((features, hidden)), np.zeros(hidden), np.zeros(hidden), prior))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    learn, check = order[: max(1, len(x) * 4 // 5)], order[max(1, len(x) * 4 // 5) :]
    z = (x - center) / scale
    p = [rng.standard_normal((features, hidden)) / np.sqrt(features), np.zeros(hidden), np.zeros(hidden), np.array(prior)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(learn), max(1, len(learn) // 128)):
            h = np.tanh(z[at] @ p[0] + p[1])
            g = (1 / (1 + np.exp(-(h @ p[2] + p[3]))) - y[at]) / len(at)
            back = np.outer(g, p[2]) * (1 - h * h)
            grads = [z[at].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ g + 1e-4 * p[2], g.sum()]
            step += 1
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad * grad
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(center, scale, (p[0], p[1], p[2], float(p[3])))
    logits = net.logits(x[check]) if len(check) else np.zeros(0)

    def loss(t: float) -> float:
        return float(np.logaddexp(0, np.where(y[check] == 1, -logits, logits) / t).sum())

    best = min(np.geomspace(0.5, 8, 41), key=loss) if len(check) else 1.0
    return Network(center, scale, net.layers, float(best))


def _pooled(batches: Iterator[pa.RecordBatch], words: WordVectors) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [row.tobytes() for row in pool(batch.column(1), words)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(raw, pa.binary())], names=["id", "y", "x"]
        )


def _score(batches: Iterator[pa.RecordBatch], words: WordVectors, net: Network) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = net.scores(pool(batch.column(1), words).astype(np.float64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["id", "score"])


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", at_most: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text.

    Word vectors come from all texts; the network from at most ``at_most``
    labelled rows that are not held out. NULL and empty texts are scored as a
    text without words. NULL ids are scored and not held out; repeated rows are
    scored each. Without labelled rows every score is one half. An empty table
    gives an empty result.
    """
    texts = first_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("id"), "text")
    words = fit_word_vectors(texts)
    sample = training_rows(texts, labels, label, at_most).select("id", "text", "y")
    pooled = stage_python(sample.mapInArrow(partial(_pooled, words=words), "id long, y int, x binary"), "pooled", 512).toArrow()
    ids, y = pooled.column("id").to_numpy(), pooled.column("y").to_numpy()
    raw = pooled.column("x").to_pylist()
    x = np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), 2 * DIMS + 1).astype(np.float64)
    order = np.lexsort((x[:, 0], mix(ids.astype(np.int64).view(np.uint64)))) if len(raw) else np.zeros(0, int)
    net = fit_network(x[order], y[order].astype(np.float64))
    scored = stage_python(texts.mapInArrow(partial(_score, words=words, net=net), "id long, score double"), "quality", 512)
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
