"""Near-duplicate texts and vectors, and nearest neighbours, against brute force."""

import random
import re

import numpy as np
import pytest
from test_words_graph import reached

from residualkit.llm import ann, embedding_dedup, minhash

TEXT_SCHEMA = "doc_id long, text string, id string, component string, n_shingles int"


def brute_documents(rows, k, percent):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        own = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(own)
    links = []
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                links.append((a, b))
    comp = reached(links)
    return {i: (max(map(len, sets[i])), comp.get(i, i)) for i in ids}


def near_copies(seed=1):
    """Clusters of copies with one to thirty per cent of the words changed, exact copies, and odd texts."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(4):
        base = [random.choice(vocabulary) for _ in range(80)]
        for copy in range(25):
            own = [random.choice(vocabulary) if random.random() < copy / 300 else w for w in base]
            rows.append((doc, " ".join(own)))
            doc += 1
    rows += [(doc + i, rows[3][1].upper()) for i in range(5)]
    rows += [(900, None), (901, ""), (902, " \n "), (903, "two words"), (904, "Two  words"), (905, "w1 " * 5000), (906, "w1 " * 4000)]
    rows += [(3, rows[3][1]), (3, rows[30][1])]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_documents_equal_brute_force(spark, k):
    rows = near_copies()
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], TEXT_SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k=k).collect()}
    assert got == brute_documents(rows, k, 80)


def changed(text, at, word):
    own = text.split()
    return " ".join([*own[:at], word, *own[at + 1 :]])


@pytest.mark.parametrize("copied_id", [10, 70])
@pytest.mark.parametrize("k", [4, 5])
def test_a_copied_row_does_not_hide_other_rows_of_its_id(spark, copied_id, k):
    x, y = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(copied_id, x), (50, x), (50, y), (60, f"{y} more"), (80, "something else altogether here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k=k).collect()}
    assert got == brute_documents(rows, k, 80)
    assert got[60][1] == got[50][1] == got[copied_id][1] == min(copied_id, 50)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeated_ids_with_copies_and_near_copies(spark, seed):
    random.seed(seed)
    bases = [" ".join(random.choice("abcdefghij") + str(random.randrange(90)) for _ in range(50)) for _ in range(12)]
    texts = [t for b in bases for t in (b, changed(b, 0, "new"), changed(b, 49, "end"))]
    rows = [(random.randrange(30), random.choice(texts)) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k=4).collect()}
    assert got == brute_documents(rows, 4, 80)


def test_documents_without_id_and_no_documents(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    got = sorted(minhash.near_duplicates(df).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got] == [(1, 1, True), (None, None, True), (None, None, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_common_counts():
    sets = [np.unique(np.random.default_rng(i).integers(0, 50, 30).astype(np.uint64)) for i in range(6)]
    got = minhash.common_counts(sets[:2], sets[2:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:2]]


VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int, id long, copies int"


def some_vectors():
    rng = np.random.default_rng(4)
    rows = []
    for center in range(6):
        base = rng.standard_normal(24)
        for i in range(30):
            v = base + rng.standard_normal(24) * (0.05 + 0.01 * i)
            rows.append((center * 30 + i, v.astype(np.float32).tolist(), center % 2))
    copy = rows[10]
    rows += [(500 + i, copy[1], copy[2]) for i in range(4)] + [(510, copy[1], None), (511, copy[1], 7)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] * 24, [None] * 24, [1.0] * 3, [3e38] * 24, [1e-30] * 24]
    rows += [(600 + i, v, 0) for i, v in enumerate(odd)]
    return [*rows, rows[0]]


def ok(v):
    return v is not None and len(v) > 0 and None not in v and bool(np.isfinite(v).all()) and any(v)


def cosine(x, y):
    x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
    return float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))


@pytest.mark.parametrize("tile", [16, 1024])
def test_vectors_equal_brute_force(spark, tile):
    rows = some_vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTOR_SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicate_vectors(df, 0.93, tile).collect()}
    single = {r[0]: r for r in rows}
    links = [
        (a, b)
        for a, (_, x, p) in single.items()
        for b, (_, y, q) in single.items()
        if a < b and p is not None and p == q and ok(x) and ok(y) and len(x) == len(y) and cosine(x, y) >= 0.93
    ]
    comp = reached(links)
    count = {i: sum(i in pair for pair in links) for i in single}
    assert got == {i: (count[i], comp.get(i, i), comp.get(i, i) == i) for i in single}


@pytest.mark.parametrize("group_bytes", [1, 16 * 24 * 8 * 3, 1 << 25])
def test_groups_of_tiles_lose_no_link(spark, monkeypatch, group_bytes):
    monkeypatch.setattr(embedding_dedup, "GROUP_BYTES", group_bytes)
    test_vectors_equal_brute_force(spark, 16)


def test_groups_of_a_label_are_few_and_bounded(spark):
    schema = "tile long, part int, seq int, label string, dims int, low array<double>, high array<double>"
    rows = [(p << 32 | i, p, i, "hot", 64, [0.0], [1.0]) for p in range(4) for i in range(50)]
    rows += [(9 << 32, 9, 0, "cold", 64, [0.0], [1.0])]
    tiles = spark.createDataFrame(rows, schema)
    found = embedding_dedup.group_tiles(tiles, 50, 1024).collect()
    hot = sorted((r.tile, r.grp, r["last"]) for r in found if r.label == "hot")
    assert [g for _, g, _ in hot] == [i // 20 for i in range(200)] and {n for _, _, n in hot} == {9}
    assert [(r.grp, r["last"]) for r in found if r.label == "cold"] == [(0, 0)]
    # 64 dimensions: 512 KB a tile, so 64 tiles a group at most.
    few = embedding_dedup.group_tiles(tiles, 1, 1024).groupBy("label", "grp").count().collect()
    assert max(r["count"] for r in few) == embedding_dedup.GROUP_BYTES // (1024 * 64 * 8)


def test_vectors_without_id_and_no_vectors(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(embedding_dedup.near_duplicate_vectors(df).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, 0, 1, True), (None, 0, None, True), (None, 0, None, True)]
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0
    assert ann.nearest(df.limit(0)).count() == 0


def test_nearest_equal_brute_force(spark):
    rows = some_vectors()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTOR_SCHEMA)
    good = {r[0]: r[1] for r in rows if ok(r[1])}
    expected = {}
    for q in good:
        if q % 50 == 0:
            scored = sorted((-cosine(good[q], v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            expected[q] = scored[:5]
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {q for q, e in expected.items() if e}
    hits = total = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and len(found) == len(expected[q])
        assert all(abs(f[2] - cosine(good[q], good[f[1]])) < 1e-12 for f in found)
        assert all((-a[2], a[1]) < (-b[2], b[1]) for a, b in zip(found, found[1:]))
        hits += sum(abs(f[2] + e[0]) < 1e-12 for f, e in zip(found, expected[q], strict=True))
        total += len(found)
    assert hits >= 0.99 * total


def test_estimates_stay_in_their_bounds():
    rng = np.random.default_rng(0)
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (rng.standard_normal((500, 64)), rng.standard_normal((20, 64))))
    rotation, centroid = ann.random_rotation(64, 3), x.mean(axis=0)
    bits, distance, factor = ann.encode(x, centroid, rotation)
    assert bits.shape == (500, 8)
    guess, spread = ann.estimate(q, bits, distance, factor, centroid, rotation, 4.0)
    inside = np.abs(guess - q @ x.T) <= spread
    assert inside.mean() > 0.999
