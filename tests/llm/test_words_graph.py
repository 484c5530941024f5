import random
import re

import numpy as np
import pyarrow as pa
import pytest

from residualkit.llm import words
from residualkit.llm.graph import components

TEXTS = [None, "", " \t\n", "a", "A b a B", "naïve Ünicode ß 日本 \x0b x", "x" * 50, "one two  three\nfour five", "a\x85b c\xa0d"]


def plain_words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


@pytest.mark.parametrize("size", [8, 1 << 20])
def test_word_hashes_tell_words_apart(monkeypatch, size):
    monkeypatch.setattr(words, "SLICE", size)
    hashes, bounds = words.hashed_runs(*words.text_buffer(pa.array(TEXTS)))
    seen = {}
    for i, text in enumerate(TEXTS):
        own = hashes[bounds[i] : bounds[i + 1]]
        assert len(own) == len(plain_words(text))
        for h, w in zip(own.tolist(), plain_words(text), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_of_an_arrow_column_and_empty_columns():
    column = pa.array(TEXTS)[3:6]
    hashes, bounds = words.hashed_runs(*words.text_buffer(column))
    assert np.diff(bounds).tolist() == [len(plain_words(t)) for t in TEXTS[3:6]]
    assert len(words.hashed_runs(*words.text_buffer(pa.array([], pa.string())))[0]) == 0


def test_shingles_of_short_texts():
    h = np.arange(1, 6, dtype=np.uint64)
    assert len(words.shingles(h[:0], 4)) == 0 and len(words.shingles(h[:2], 4)) == 1
    assert len(words.shingles(h, 4)) == 2
    assert words.shingles(h[:4], 4)[0] == words.shingles(h, 4)[0]


def test_token_classes_split_signs_from_letters():
    b = np.frombuffer("ab1**é ".encode(), np.uint8)
    assert words.token_classes(b).tolist() == [1, 1, 2, 3, 3, 1, 1, 0]


def reached(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_components_equal_union_find(spark, kind):
    random.seed(kind)
    pairs = {
        "chain": [(i + 1, i) for i in range(30)],
        "star": [(5, i) for i in range(40) if i != 5],
        "random": [(random.randrange(60), random.randrange(60)) for _ in range(35)],
    }[kind]
    given = [*pairs, pairs[0], (7, 7), (None, 3), (3, None)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(given, "a long, b long")).collect()}
    assert got == reached([(a, b) for a, b in pairs if a != b])


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
