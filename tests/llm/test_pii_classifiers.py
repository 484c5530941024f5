import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from residualkit.llm import pii, quality, toxicity

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(len(p.lstrip("0")) <= 3 and int(p[-6:]) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[name]()
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


ODD = [
    None,
    "",
    "a@b.c_x@y.z a@b.c@d.e",
    "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3.256 01.0.00.000",
    "4111 1111 1111 1111 4111-1111-1111-1111-2 x4111111111111111y 4111  1111",
    "+1 (017) 555-7713 +1-2 +49 30 1234567890123",
    "é日本😀 a@b.co 😀 10.0.0.1",
    "5" * 20000,
    "a." * 20000 + "@",
    "%" * 3000 + "@x.y " + "1 2 3 " * 5000,
    "+1" + " " * 3000,
    "@@@@ a@b a@b. a@b.c.",
    "12 x " * 20000,
    " ".join(f"u{i}@h{i % 97}.com" for i in range(6000)) + " 4111-1111-1111-1111 " + "1-2 3" * 400,
    "-4111111111111111 5 4111111111111111 - 4111111111111111- 4111111111111111 1 2 3 4 5 6 7 8 9 0 1 2 3 4",
    " ".join(f"+1 (415) 555-{1000 + i} or (415) 555-{1000 + i} at 10.0.{i % 256}.{i % 200}" for i in range(1500)),
]


def test_base_spans_equal_brute_force(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in enumerate(texts)], "doc_id long, text string, n_email int, spans string")
    df = df.unionByName(df.filter("doc_id = 3"))
    got = pii.personal_data(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        spans = base_spans(texts[r.doc_id])
        joined = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))
    assert pii.personal_data(df.limit(0)).count() == 0


def test_wider_spans_need_the_classifier(spark):
    """With enough true phones in the corpus, a number without country code is added; digits of a failing card are not."""
    rows = [(i, f"call me: +1 (415) 555-{1000 + i} now") for i in range(60)]
    rows += [(100, "phone (415) 555-2671 home"), (101, "order 4111111111111112 shipped"), (102, "plain words only")]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == "phone:6:20" and got[101] == "" and got[102] == ""


def test_redaction_keeps_everything_else(spark):
    df = spark.createDataFrame([(1, "mail a@b.co or +1 (415) 555-1000!", "x"), (2, None, "y"), (3, "😀 1.2.3.4", "z")], "doc_id long, text string, marked string")
    got = pii.redact(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "mail [EMAIL] or [PHONE]!", "x"), (2, None, "y"), (3, "😀 [IP]", "z")]


def redacted(text, spans):
    """Spans as ``kind:start:end``, in order; overlapping ones as one, named after the first."""
    out, at = [], 0
    for kind, start, end in (s.split(":") for s in spans.split(",") if s):
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind.upper()}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def test_redaction_of_odd_and_long_texts(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(0, None, "y")], "doc_id long, text string, s0 string")
    spans = {r.doc_id: r.spans for r in pii.personal_data(df).collect()}
    got = pii.redact(df).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        assert r.text == (None if ODD[r.doc_id] is None else redacted(ODD[r.doc_id], spans[r.doc_id])), r.doc_id
    assert pii.redact(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_running_values_in_blocks(spark, n):
    values = [(i * 37) % 11 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    sums, highs = df.select(
        pii.scan_before(F.col("v"), F.lit(0), lambda a, b: a + b), pii.scan_before(F.col("v"), F.lit(0), F.greatest)
    ).first()
    assert sums == [sum(values[:i]) for i in range(n)]
    assert highs == [max([0, *values[:i]]) for i in range(n)]


def test_reliabilities_find_the_good_labelers():
    """Labelers 0 and 1 agree with a hidden truth, labeler 2 is noise."""
    rng = np.random.default_rng(1)
    counts = {}
    for _ in range(4000):
        truth = 1 if rng.random() < 0.4 else -1
        votes = [truth if rng.random() < p else -truth for p in (0.95, 0.9, 0.5)] + [0, truth if rng.random() < 0.8 else -truth]
        key = ",".join(map(str, ["2", *votes]))
        counts[key] = counts.get(key, 0) + 1
    p = pii.reliabilities(counts)
    assert p["2,1,1,-1,0,1"] > 0.95 and p["2,-1,-1,1,0,-1"] < 0.05
    assert abs(p["2,1,1,1,0,1"] - p["2,1,1,-1,0,1"]) < 0.05


def test_pii_runs_no_python(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = pii.candidates(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name, run, least", [("toxic", toxicity.toxicity, 0.98), ("quality", quality.quality, 0.95)])
def test_held_out_accuracy(spark, name, run, least):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    got = run(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert 0.15 < got.held_out.mean() < 0.25 and got.score.between(0, 1).all()
    assert auc(held.score.to_numpy(), held[name].to_numpy()) > least
    assert (held.predicted == held[name]).mean() > 0.95


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_odd_rows_are_scored(spark, run):
    docs = spark.createDataFrame(
        [(1, "fine words here", 0.5), (2, None, 0.5), (3, "", 0.5), (None, "fine words", 0.5), (1, "fine words here", 0.5), (4, "w " * 50000, 0.5)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(1, 0, 1), (4, 1, 0), (4, None, None), (None, 1, 1), (2, 7, 7)], "doc_id long, quality int, toxic int")
    got = run(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert run(docs, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert run(docs.limit(0), labels).count() == 0
