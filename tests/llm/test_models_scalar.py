"""Both classifiers against plain loops over single numbers, and the number of packed sequences."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from residualkit.llm import packing, quality, toxicity

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def scalar_ftrl(examples, settings):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        l1 = 0.0 if i == "bias" else settings.l1
        if abs(z[i]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i]) - z[i]) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for own, y in examples:
            at = [*own, "bias"]
            w = [weight(i) for i in at]
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, math.fsum(w))))) - y
            for i, wi in zip(at, w, strict=True):
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / settings.alpha * wi
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_ftrl_equals_scalar_loops():
    random.seed(6)
    examples = [(np.array(sorted(random.sample(range(256), random.randint(0, 12))), "<i4"), random.randrange(2)) for _ in range(200)]
    settings = toxicity.Ftrl()
    full, bias = toxicity.fit_ftrl(examples, 8, settings)
    want = scalar_ftrl([(e.tolist(), y) for e, y in examples], settings)
    assert bias == pytest.approx(want.pop("bias"), abs=1e-9)
    assert full.tolist() == pytest.approx([want.get(i, 0.0) for i in range(256)], abs=1e-9)


def test_toxicity_equals_scalar_scores(spark):
    """The whole operator on a table: sample, order, features as sets, weights and scores."""
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    given = {r.doc_id: r.toxic for r in labels.collect()}
    held = {r.doc_id for r in docs.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()}

    def buckets(text):
        return sorted(set(toxicity.features(pa.array([text], pa.string()), toxicity.BITS)[1].tolist()))

    chosen = [i for i in texts if given.get(i) in (0, 1) and i not in held]
    chosen.sort(key=lambda i: int(toxicity.mix(np.array([i], np.int64).view(np.uint64))[0]))
    weights = scalar_ftrl([(buckets(texts[i]), given[i]) for i in chosen], toxicity.Ftrl())
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    for i, text in texts.items():
        total = math.fsum([weights["bias"], *[weights.get(b, 0.0) for b in buckets(text)]])
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.5) and got[i].held_out == (i in held)


def scalar_words(texts):
    """Neighbours' index vectors summed for every bucket, as unit vectors, and the weights of the buckets."""
    index = quality.index_vectors(5).astype(int)
    total, count = defaultdict(lambda: np.zeros(quality.DIMS)), defaultdict(int)
    for text in texts:
        own = quality.buckets(pa.array([text], pa.string()))[0].tolist()
        for i, b in enumerate(own):
            count[b] += 1
            for j in range(max(0, i - quality.WINDOW), min(len(own), i + quality.WINDOW + 1)):
                if j != i:
                    total[b] = total[b] + index[own[j]]
    every = sum(count.values())
    vectors = {b: v / (math.sqrt(float(v @ v)) or 1.0) for b, v in total.items()}
    return vectors, {b: quality.RARE / (quality.RARE + n / every) for b, n in count.items()}


def test_quality_equals_scalar_loops(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    rows = docs.select("doc_id", "text").collect()
    vectors, weights = scalar_words([r.text for r in rows])
    words = quality.fit_word_vectors(docs.select("text"))
    pooled = quality.pool(pa.array([r.text for r in rows], pa.string()), words)
    none = np.zeros(quality.DIMS)
    for r, got in zip(rows, pooled, strict=True):
        own = quality.buckets(pa.array([r.text], pa.string()))[0].tolist()
        if not own:
            assert not got.any()
            continue
        v = [vectors.get(b, none) * weights[b] for b in own]
        mass = math.fsum(weights[b] for b in own)
        pairs = sum((a * b for a, b in zip(v[1:], v[:-1], strict=True)), none)
        want = [*(sum(v, none) / mass), *(pairs / mass), math.log1p(len(own))]
        assert got.tolist() == pytest.approx(want, abs=2e-5)

    rng = np.random.default_rng(0)
    x = rng.standard_normal((60, 5))
    net = quality.fit_network(x, (x[:, 0] > 0).astype(float), hidden=4, epochs=5)
    w1, b1, w2, b2 = net.layers
    for row, score in zip(x, net.scores(x), strict=True):
        z = [(row[i] - net.center[i]) / net.scale[i] for i in range(5)]
        hidden = [math.tanh(math.fsum(z[i] * w1[i, j] for i in range(5)) + b1[j]) for j in range(4)]
        logit = math.fsum(hidden[j] * w2[j] for j in range(4)) + b2
        assert score == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), abs=1e-9)


def test_sequences_of_the_query_are_nearly_as_few_as_can_be(spark):
    rows = packing.pack(spark.read.parquet(f"{MIDDLE}/documents.parquet")).collect()
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id].append((r.start, r.length))
    for own in starts.values():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
    least = math.ceil(sum(r.length for r in rows) / packing.CAPACITY)
    assert len(places) <= 1.03 * least
