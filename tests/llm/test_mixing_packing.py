import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from residualkit.llm import mixing, packing


def water(children, budget):
    """Real-valued shares by weight with capacities: raise one common level until the budget is spent."""
    given, left, open_ = {}, budget, dict(children)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {c for c, (w, cap) in open_.items() if left * w / weight >= cap}
        if not full:
            given.update({c: left * w / weight for c, (w, _) in open_.items()})
            break
        for c in full:
            given[c] = open_.pop(c)[1]
            left -= given[c]
    return given


@pytest.mark.parametrize("seed", range(3))
def test_share_is_weighted_filling(spark, seed):
    random.seed(seed)
    rows, expected = [], {}
    for p in range(6):
        children = {c: (random.randint(1, 9), random.choice([0, 5, 50, 500])) for c in range(random.randint(1, 7))}
        budget = random.randint(0, 900)
        rows += [(p, c, w, cap, budget) for c, (w, cap) in children.items()]
        expected.update({(p, c): v for c, v in water(children, budget).items()})
        expected[p] = min(budget, sum(cap for _, cap in children.values()))
    df = spark.createDataFrame(rows, "p long, c long, weight long, capacity long, budget long")
    sums = defaultdict(int)
    for r in mixing.share(df, ["p"], ["c"]).collect():
        assert abs(r.given - expected[r.p, r.c]) < 1 and 0 <= r.given <= r.capacity
        sums[r.p] += r.given
    assert all(sums[p] == expected[p] for p in range(6))


DOCS = "doc_id long, text string, lang string, source string, epoch int, tokens int, mix_x string"


def mix_rows(spark, rows, **kw):
    return mixing.mix(spark.createDataFrame([(*r, 1, 2, "z") for r in rows], DOCS), **kw).collect()


def test_mix_takes_exact_budgets_and_prefixes(spark):
    random.seed(3)
    rows = [(i, "w " * random.randint(0, 30), random.choice(["en", "de", None]), random.choice(["a", "b", None])) for i in range(300)]
    rows += [rows[5], (None, "w w", "en", "a"), (301, None, "en", "a"), (302, "w " * 4000, "de", "b")]
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    for percent, epochs in ((50, 2), (150, 2), (100, 1), (0, 1)):
        got = mix_rows(spark, rows, weights={("domain0",): 3, ("domain1", "en"): 2}, percent=percent, max_epochs=epochs)
        assert sum(r.taken for r in got) == min(total * percent // 100, total * epochs)
        assert all(0 <= r.taken <= r.tokens and r.epoch < epochs for r in got)
        cut = defaultdict(int)
        for r in got:
            cut[r.domain, r.lang, r.source] += r.taken < r.tokens
        assert max(cut.values(), default=0) <= 1


def test_mix_with_zero_weights_and_without_documents(spark):
    rows = [(i, "a b c", "en", f"s{i % 5}") for i in range(40)]
    got = mix_rows(spark, rows, weights={("domain0",): 0}, percent=100, max_epochs=1)
    assert got and "domain0" not in {r.domain for r in got}
    assert mix_rows(spark, rows[:0], weights={}) == []


@pytest.fixture(scope="module")
def encoder():
    return packing.ByteEncoder(*packing.tokenizer_files())


ODD = ["", " ", "  a", "a b ", "<|endoftext|> a<|endoftext|>", "a \n b\n\n c", "日本語 text", "don't I'll 're", "é ß\tq\r\n x", "a\x1cb \x1c c", "😀😀", "x" * 3000]


def test_ids_are_those_of_the_tokenizer(spark, encoder):
    texts = ODD + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in texts:
        ids = encoder.full.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.asarray(ids, "<u4").tobytes()


def test_only_long_documents_are_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(16, 8) == [(0, 8), (8, 8)] and packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def fewest(counts, capacity):
    """No packing needs fewer sequences: long pieces need one each, and what they leave takes only so much of the rest."""
    best = 0
    for low in range(capacity // 2 + 1):
        big = sum(c for n, c in counts.items() if n > capacity - low)
        half = {n: c for n, c in counts.items() if capacity / 2 < n <= capacity - low}
        small = sum(n * c for n, c in counts.items() if low <= n <= capacity / 2)
        room = sum((capacity - n) * c for n, c in half.items())
        best = max(best, big + sum(half.values()) + max(0, -(-(small - room) // capacity)))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    random.seed(seed)
    counts = {n: random.randint(1, 40) for n in random.sample(range(1, 129), 60)}
    seen, fill = set(), defaultdict(list)
    for length, rank, many, first, offset in packing.plan_runs(counts, 128):
        for i in range(many):
            assert (length, rank + i) not in seen
            seen.add((length, rank + i))
            fill[first + i].append((offset, length))
    assert seen == {(n, i) for n, c in counts.items() for i in range(c)}
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 128
    assert sorted(fill) == list(range(len(fill)))
    assert len(fill) <= 1.03 * fewest(counts, 128) + 2


def test_pack_round_trip(spark, encoder):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, ODD[3]), (50, None), (51, "one two three " * 3000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, rank int").repartition(3)
    got = packing.pack(df).collect()
    pieces = sorted((r.doc_id if r.doc_id is not None else -1, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    expected = []
    for i, text in rows:
        raw = encoder.encode(text or "") + bytes(4)
        for n, (start, length) in enumerate(packing.cut(len(raw) // 4, 2048)):
            expected.append((-1 if i is None else i, n, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
    assert pieces == sorted(expected)
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        ends = np.cumsum([0, *[n for _, n in sorted(places)]])
        assert [o for o, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 2048
    assert packing.pack(df.limit(0)).count() == 0


def test_long_runs_of_blanks_are_packed(spark, encoder):
    texts = [" " * 300_000, "a" + "\n" * 2000 + "b", "\t " * 5000]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), np.uint32).tolist() == encoder.full.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in packing.pack(df).collect()} == {0, 1, 2}


def test_columns_of_the_mixture_cannot_be_kept(spark):
    df = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, tokens int")
    with pytest.raises(ValueError, match="tokens"):
        mixing.mix(df, {}, keep=["text", "tokens"])
