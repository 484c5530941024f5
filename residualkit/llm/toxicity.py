"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every text becomes a set of hashed features: words, their stems (the first four
and the first six bytes, for languages that compound), word pairs, and pairs with
one word left out between them. The weights are learned by FTRL-proximal, with a
learning rate for every coordinate and an L1 penalty that leaves most of them
exactly zero, so what is sent to the scoring tasks is a few kilobytes, and never
more than the number of buckets. Learning takes a bounded sample of labelled
rows, in one task; scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import arrow_rows, first_columns, stage_python
from residualkit.llm.labelled import held_out, training_rows
from residualkit.llm.words import mix, prefixed_runs, text_buffer, token_classes

BITS = 20
STEMS = (4, 6)
SAMPLE = 12_000


@dataclass(frozen=True)
class Ftrl:
    """Settings of the learner: rate ``alpha / (beta + sqrt(sum of squared gradients))``, penalties, passes."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 1.0
    passes: int = 3


@dataclass(frozen=True)
class Weights:
    """The weights that are not zero, by bucket, and the bias."""

    buckets: np.ndarray
    values: np.ndarray
    bias: float
    bits: int

    @property
    def learned(self) -> bool:
        return len(self.buckets) > 0 or self.bias != 0

    def dense(self) -> np.ndarray:
        full = np.zeros(1 << self.bits)
        full[self.buckets] = self.values
        return full


def features(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every feature occurrence; grams do not cross texts."""
    (words, *stems), bounds = prefixed_runs(*text_buffer(column), token_classes, (None, *STEMS))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, owner = [words], [text]
    for length, own in zip(STEMS, stems, strict=True):
        found.append(mix(own + np.uint64(length)))
        owner.append(text)
    for gap, odd in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(words) > gap:
            same = text[gap:] == text[:-gap]
            found.append(mix(words[:-gap] * np.uint64(odd) + words[gap:])[same])
            owner.append(text[gap:][same])
    return np.concatenate(owner), (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def feature_sets(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, y, features)`` from rows ``(id, text, y)``."""
    for batch in batches:
        owner, bucket = features(batch.column(1), bits)
        distinct = np.unique((owner << bits) | bucket)
        cuts = np.searchsorted(distinct >> bits, np.arange(batch.num_rows + 1))
        buckets = (distinct & ((1 << bits) - 1)).astype("<i4")
        sets = [buckets[cuts[i] : cuts[i + 1]].tobytes() for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sets, pa.binary())], names=["id", "y", "features"]
        )


def fit_ftrl(examples: list[tuple[np.ndarray, int]], bits: int, settings: Ftrl) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the bias, from examples in the given order."""
    size = (1 << bits) + 1  # the last coordinate is the bias, without penalty
    z, n = np.zeros(size), np.zeros(size)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        l1 = np.where(at == size - 1, 0.0, settings.l1)
        shrunk = np.sign(zi) * l1 - zi
        return np.where(np.abs(zi) <= l1, 0.0, shrunk / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2))

    for _ in range(settings.passes):
        for own, y in examples:
            at = np.append(own, size - 1)
            w = weights(at)
            gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] += gradient - (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / settings.alpha * w
            n[at] += gradient**2
    full = weights(np.arange(size))
    return full[:-1], float(full[-1])


def _fit(batches: Iterator[pa.RecordBatch], bits: int, settings: Ftrl) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True)
    rows.sort(key=lambda r: (int(mix(np.array([r[0]], np.int64).view(np.uint64))[0]), r[2]))
    full, bias = fit_ftrl([(np.frombuffer(f, "<i4"), y) for _, y, f in rows], bits, settings)
    at = np.flatnonzero(full)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(full[at], bias))], names=["bucket", "w"])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    at_most: int = SAMPLE,
    bits: int = BITS,
    settings: Ftrl = Ftrl(),
) -> Weights:
    """Learn from at most ``at_most`` labelled documents that are not held out.

    One task learns, in an order fixed by the ids. Without any labelled row all
    weights are zero and every score is one half.
    """
    texts = first_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("id"), "text")
    sample = training_rows(texts, labels, label, at_most).select("id", "text", "y")
    sets = stage_python(sample.mapInArrow(partial(feature_sets, bits=bits), "id long, y int, features binary"), "features")
    learner = partial(_fit, bits=bits, settings=settings)
    with arrow_rows(docs.sparkSession, 1024):
        found = sets.repartition(1).mapInArrow(learner, "bucket long, w double").collect()
    bias = next((r["w"] for r in found if r["bucket"] == -1), 0.0)
    kept = sorted((r["bucket"], r["w"]) for r in found if r["bucket"] >= 0)
    return Weights(np.array([b for b, _ in kept], np.int64), np.array([w for _, w in kept]), bias, bits)


def _score(batches: Iterator[pa.RecordBatch], weights: Weights) -> Iterator[pa.RecordBatch]:
    full, bits = weights.dense(), weights.bits
    used = full != 0
    for batch in batches:
        owner, bucket = features(batch.column(1), bits)
        hit = used[bucket]
        distinct = np.unique((owner[hit] << bits) | bucket[hit])
        total = np.bincount(distinct >> bits, full[distinct & ((1 << bits) - 1)], batch.num_rows) + weights.bias
        score = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])


def score_toxicity(docs: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, from its whole text.

    NULL and empty texts get the score of the bias alone. A NULL id is scored
    like any other and is not held out. Repeated rows are scored each.
    """
    texts = first_columns(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("id"), "text")
    scored = stage_python(texts.mapInArrow(partial(_score, weights=weights), "id long, score double"), "toxicity", 512)
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows that are not held out, then score every document.

    An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are not looked at.
    """
    return score_toxicity(docs, fit_toxicity(docs, labels))


def _kept(batches: Iterator[pa.RecordBatch], weights: Weights, text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        only = pa.RecordBatch.from_arrays([batch.column(text)] * 2, names=["id", "text"])
        for scored in _score(iter([only]), weights):
            yield batch.filter(pa.array(scored.column("score").to_numpy() < 0.5))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns.

    Each row is judged by its own text, in the pass that scores it, so rows are not shuffled; of rows that repeat an id some may go and
    some stay. Rows with a NULL id, a NULL text or an empty text are judged like any other. An empty table gives an empty result.
    Without any labelled row nothing is learned and nothing rejected.
    """
    weights = fit_toxicity(docs, labels)
    if not weights.learned:
        return docs
    keep = partial(_kept, weights=weights, text=docs.columns.index("text"))
    return stage_python(docs.mapInArrow(keep, docs.schema), "not_toxic", 512)
