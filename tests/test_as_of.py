"""As-of joins, running totals and statistics of earlier periods against plain loops."""

import random

import pytest
from conftest import many_blocks, no_broadcast

from residualkit.operators.as_of import asof_rows, group_stats_as_of, target_encode_as_of, totals_before


def events(n=900, seed=1):
    """A key with a third of the rows, light keys, missing keys, times and values, and ties."""
    random.seed(seed)
    rows = []
    for i in range(n):
        key = "hot" if random.random() < 0.35 else random.choice(["a", "b", "c", None, *[f"k{j}" for j in range(40)]])
        rows.append((i, key, random.choice([None, *range(30)]) if i % 50 == 0 else random.randrange(30), random.choice([None, random.gauss(0, 1)])))
    return rows


@pytest.mark.parametrize("inclusive", [False, True])
def test_asof_rows_with_cutoffs_of_their_own(spark, inclusive):
    told = events()
    asked = [(i, k, random.choice([None, *range(-1, 32)])) for i, k, _, _ in events(500, 2)] + [(9000, "unseen", 5)]
    ev = spark.createDataFrame(told, "event long, key string, at int, worth double").repartition(4)
    rows = spark.createDataFrame(asked, "row long, key string, until int").repartition(4)
    with many_blocks(spark):
        got = asof_rows(rows, ev, "key", "until", "at", {"seen": "event", "worth": "worth"}, ["event"], inclusive).collect()
    assert len(got) == len(asked) and got[0].asDict().keys() == {"row", "key", "until", "seen", "worth"}
    for r in got:
        known = [(t, i, w) for i, k, t, w in told if k is not None and k == r.key and t is not None and r.until is not None and (t < r.until or (inclusive and t == r.until))]
        want = max(known)[1:] if known else (None, None)
        assert (r.seen, r.worth) == want, r


def test_asof_of_nothing(spark):
    ev = spark.createDataFrame([], "event long, key string, at int")
    rows = spark.createDataFrame([(1, "a", 3), (2, None, 3)], "row long, key string, until int")
    assert [r.seen for r in asof_rows(rows, ev, "key", "until", "at", {"seen": "event"}).collect()] == [None, None]
    assert asof_rows(rows.limit(0), rows, "key", "until", "until", {"seen": "row"}).count() == 0


def test_totals_before(spark):
    rows = [r for r in events() if r[2] is not None]
    df = spark.createDataFrame(rows, "event long, key string, at int, worth double").repartition(4)
    with many_blocks(spark):
        got = totals_before(df, "key", ["at", "event"], {"before": "worth"}).collect()
    assert len(got) == len(rows)
    for r in got:
        want = None if r.key is None else sum(w or 0 for i, k, t, w in rows if k == r.key and (t, i) < (r.at, r.event))
        assert r.before == (None if want is None else pytest.approx(want, abs=1e-9))


def earlier_mean(rows, match, period):
    own = [w for r in rows for w in [r[3]] if match(r) and r[2] is not None and r[2] < period and w is not None]
    return sum(own) / len(own) if own else None


def close(a, b):
    return a == b or (a is not None and b is not None and a == pytest.approx(b, abs=1e-9))


@pytest.mark.parametrize("shuffle", [False, True])
def test_statistics_see_only_earlier_periods(spark, shuffle):
    base = [(i, k, t, w) for i, k, t, w in events(400)]
    df = spark.createDataFrame([(*r, r[0] % 3 or None) for r in base], "event long, key string, at int, worth double, part long").repartition(3)
    late = spark.createDataFrame([(1000, "hot", 99, 1.0, 1), (1001, "new", 99, 2.0, None), (1002, "a", None, 2.0, 2)], df.schema)
    rows = df.unionByName(late)
    with no_broadcast(spark) if shuffle else many_blocks(spark):
        got = group_stats_as_of(rows, df, [["key"], ["key", "part"]], ["worth"], "at").collect()
    assert len(got) == 403
    for r in got:
        if r["at"] is None or r.key is None:
            assert r.key_worth_mean is None
            continue
        want = earlier_mean(base, lambda e, r=r: e[1] == r.key, r["at"])
        assert close(r.key_worth_mean, want)
        both = None if r.part is None else earlier_mean(base, lambda e, r=r: e[1] == r.key and (e[0] % 3 or None) == r.part, r["at"])
        assert close(r.key_part_worth_mean, both)
        if want is not None and r.worth is not None:
            assert close(r.key_worth_dif, want - r.worth)


@pytest.mark.parametrize("shuffle", [False, True])
def test_encodings_see_only_earlier_periods(spark, shuffle):
    base = events(300, 5)
    df = spark.createDataFrame([(*r, r[0] % 3 or None) for r in base], "event long, key string, at int, worth double, part long")
    with no_broadcast(spark) if shuffle else many_blocks(spark):
        got = target_encode_as_of(df, df, ["key", ["key", "part"]], "worth", "at").collect()
    assert len(got) == 300
    for r in got:
        if r["at"] is None:
            assert r.key_worth_enc is None
            continue
        overall = earlier_mean(base, lambda e: True, r["at"])
        single = None if r.key is None else earlier_mean(base, lambda e, r=r: e[1] == r.key, r["at"])
        both = earlier_mean(base, lambda e, r=r: e[1] == r.key and (e[0] % 3 or None) == r.part, r["at"])
        assert close(r.key_worth_enc, overall if single is None else single)
        assert close(r.key_part_worth_enc, overall if both is None else both)
