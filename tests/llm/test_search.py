"""Exact top-k products and ranked lexical search, against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import settings

from residualkit.llm import ann, maxscore, presence
from residualkit.llm import vectors as shared

VECTORS = "vec_id long, embedding array<float>, score long, slot int, dims int"


def products(rows, k, scale=256):
    """Plain whole numbers, every query against every vector."""
    codes = {}
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            codes[i] = min(codes.get(i, v), v)
    codes = {i: [max(-(2**63 - 1024), min(2**63 - 1024, math.floor(scale * float(np.float32(x))))) for x in v] for i, v in codes.items()}
    found = []
    for q, own in codes.items():
        if q % 50 == 0:
            scores = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own, c)))), i) for i, c in codes.items() if i != q and len(c) == len(own)]
            found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def vectors(n=700, dims=12, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(dims).astype(np.float32).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(20)] + [(1050, rows[7][1]), (1100, [0.0] * dims), (1150, [-1.0] * dims)]
    rows += [(1200, None), (1250, [None] * dims), (1300, [float("nan")] * dims), (1350, [float("inf")] * dims), (None, rows[3][1])]
    rows += [(1400, [1.0, 2.0]), (1401, [3.0, -1.0]), (1450, []), (1451, []), (50, rows[50][1]), (100, rows[3][1])]
    return rows


def top(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 9, 9, 9) for i, v in rows], VECTORS)
    return sorted(tuple(r) for r in maxscore.top_products(df, **options).collect())


@pytest.mark.parametrize("shard", [4096, 64])
def test_products_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(maxscore, "SHARD", shard)
    rows = vectors()
    assert top(spark, rows) == products(rows, 5)


def test_products_of_clusters_ties_and_few_rows(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 32)
    rng = np.random.default_rng(0)
    rows = []
    for center in range(10):
        base = rng.standard_normal(16)
        rows += [(center * 40 + i, (base + rng.integers(0, 2, 16) / 256).astype(np.float32).tolist()) for i in range(40)]
    assert top(spark, rows) == products(rows, 5)
    assert top(spark, rows[:1] + rows[50:53]) == products(rows[:1] + rows[50:53], 5)
    assert top(spark, []) == []


def planned(monkeypatch, module):
    """The plans of the tables ``module`` stages from now on, by label."""
    plans, write = {}, module.stage_python

    def staged(df, label, rows=256):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label, rows)

    monkeypatch.setattr(module, "stage_python", staged)
    return plans


def check_meeting(plan):
    """Copies of queries are shuffled, never broadcast."""
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_queries_of_nearest_go_through_no_driver(spark, monkeypatch):
    plans = planned(monkeypatch, ann)
    for name, value in (("BLOCK", 16), ("QUERY_BLOCK", 2)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(shared, "TOGETHER", 1)
    x = np.random.default_rng(8).standard_normal((400, 8)).astype(np.float32)
    found = ann.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), k=3).collect()
    check_meeting(plans["ann_seeds"])
    check_meeting(plans["ann_found"])
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q in range(0, 400, 50):
        score = unit @ unit[q]
        score[q] = -2
        assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == np.argsort(-score)[:3].tolist()


def test_queries_of_products_go_through_no_driver(spark, monkeypatch):
    plans = planned(monkeypatch, maxscore)
    for name, value in (("SHARD", 64), ("QUERY_BLOCK", 2)):
        monkeypatch.setattr(maxscore, name, value)
    monkeypatch.setattr(shared, "TOGETHER", 1)
    rows = vectors()
    assert top(spark, rows) == products(rows, 5)
    check_meeting(plans["maxscore_first"])
    check_meeting(plans["maxscore_found"])


def test_products_beyond_doubles(spark):
    big = [(0, [1e15, -3e13, 1.0]), (1, [1e15, 1.0, 2.0]), (2, [3e38, -3e38, 0.0]), (50, [3e38, 3e38, 3e38]), (4, [-3e38, 1.0, 1.0])]
    assert top(spark, big) == products(big, 5)


def test_floors_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    codes = rng.integers(-9, 10, (500, 20)) * 5
    codes[100:110] = codes[0]
    queries, own = codes[:8], np.arange(8)
    exact = codes @ queries.T
    lists = maxscore.Lists(np.arange(500), codes)
    floors = np.array([np.sort(np.delete(exact[:, q], q))[-5] for q in range(8)])
    query, place, score = lists.search(queries, floors, own, 5)
    for q in range(8):
        want = sorted((-exact[i, q], i) for i in range(500) if i != q)[:5]
        assert list(zip(-score[query == q], place[query == q])) == want
    assert lists.probed < 8 * 500 * 3 / 2
    assert len(lists.search(queries, floors + 10**6, own, 5)[0]) == 0
    assert len(lists.search(queries, np.full(8, maxscore.NO_FLOOR), own, 5)[0]) == 40
    assert len(lists.search(-np.abs(queries), np.full(8, -(10**6)), own, 5)[0]) == 40


TEXTS = "doc_id long, text string, item_id long, score long, terms string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranking(docs, items, k=10):
    bags = [Counter(terms(t)) for _, t in docs]
    n = sum(bool(b) for b in bags)
    total = sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    asked = {}
    for i, t in items:
        if t is not None:
            asked[i] = min(asked.get(i, t), t)
    found = []
    for item, text in asked.items():
        scores = []
        for (doc, _), bag in zip(docs, bags):
            m = 100 - 75 + (75 * sum(bag.values()) * n) // total if total else 0
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in terms(text)
                if t in bag
            )
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        found += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(found, key=str)


def corpus(seed=2, n=400):
    random.seed(seed)
    words = [f"w{int(random.paretovariate(0.4)) % 300}" for _ in range(5000)] + ["Été", "naïve", "北京", "x9", "The"]
    docs = [(i, " ".join(random.choice(words) for _ in range(random.randint(1, 60)))) for i in range(n)]
    docs += [(None, docs[5][1]), (None, docs[5][1]), (7, docs[5][1]), (9000, None), (9001, ""), (9002, " .,- \n"), (9003, "w1 " * 70000)]
    docs += [(5000 + i, docs[3][1]) for i in range(40)]
    items = [(i, " ".join(random.choice(words) for _ in range(25))) for i in range(70)]
    items += [(200, docs[3][1].upper()), (201, None), (202, ""), (203, "nowhere_tobefound"), (204, " ".join(f"w{i} w{i}" for i in range(150)))]
    items += [(None, "w1 w2 été ÉTÉ"), (205, "w9"), (205, "w3 w4"), (206, "w5-w6.W7 the")]
    return docs, items


def ranking(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, 1, "x") for i, t in docs], TEXTS)
    b = spark.createDataFrame([(i, t, 1, 1, "x") for i, t in items], TEXTS.replace("item_id", "other").replace("doc_id", "item_id"))
    return sorted((tuple(r) for r in presence.ranked(d, b, **options).collect()), key=str)


@pytest.mark.parametrize("items_at_most", [presence.ITEM_BYTES, 0])
@pytest.mark.parametrize("shard", [4096, 50])
def test_ranking_equals_brute_force(spark, monkeypatch, shard, items_at_most):
    monkeypatch.setattr(presence, "SHARD_DOCS", shard)
    monkeypatch.setattr(presence, "ITEM_BLOCK", 16)
    docs, items = corpus()
    with settings(spark, spark__sql__shuffle__partitions="5"):
        assert ranking(spark, docs, items, items_at_most=items_at_most) == brute_ranking(docs, items)


def test_ranking_of_nothing(spark):
    docs, items = corpus(n=10)
    assert ranking(spark, [], items) == []
    assert ranking(spark, docs, []) == []
    assert ranking(spark, [(1, None), (2, "..")], items) == []


def test_only_the_best_masks_are_evaluated():
    rng = np.random.default_rng(1)
    n = 4000
    held = [np.flatnonzero(rng.random(n) < p) for p in (0.001, 0.01, 0.2, 0.6)]
    starts = np.cumsum([0, *map(len, held)])
    postings = presence.Postings(
        np.arange(n), np.ones(n, bool), np.full(n, 10), np.arange(4, dtype=np.uint64), starts,
        np.concatenate(held).astype(np.uint16), np.ones(starts[-1], np.int32),
    )
    shard = presence.ShardSearch(postings, presence.Corpus(n, 10 * n), 2)
    best = {}
    shard.search([presence.Item(0, np.arange(4, dtype=np.uint64), np.array([6900, 4600, 1600, 500]))], best)
    assert len(best[0].ids) == 2 and shard.evaluated < 200
