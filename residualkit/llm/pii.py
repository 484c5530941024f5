"""Personal data by weak supervision: labelers vote, reliabilities are estimated, a span classifier decides.

Everything here is DataFrame functions; no Python runs on the executors.

1. Candidates. Four base patterns (e-mail, IP, card, phone) and four wider ones
   (written-out e-mail, IPv6, phone without country code, and base matches that
   fail their check) are found in each whole text, in place: ``split`` by a
   pattern gives the gaps between its matches, and their lengths give positions.
2. Votes. Five labelers vote for, against or abstain: format, gazetteer, context
   words, shape, boundaries.
3. Reliabilities. Votes are counted by kind and vote pattern (at most
   4 * 3**5 rows) and expectation-maximisation estimates, for each labeler and
   kind, how it votes on true and on false spans.
4. Classifier. The resulting probabilities weight the counts of discrete span
   features (at most a few hundred rows); their log ratios are the weights of an
   additive classifier.
5. Base spans always stay. Of the wider candidates those are added that the
   classifier accepts, whose format is right, and that touch no base span.

Patterns are written so that a long run of digits or letters is neither scanned
again from each of its characters nor matched by recursion: possessive
quantifiers and a look-behind, with the same leftmost matches. A run of fewer than 13
digits is no match of the card pattern: it could not pass the check, and nothing is tried in its place.

The work on a text grows with its length: running sums over its matches are made in two levels
(:func:`scan_before`), overlaps are found by bisection, and pieces of the text are cut from blocks of characters.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.llm.frames import known
from residualkit.staging import stage

KINDS = ("email", "ip", "card", "phone")
CHARACTERS = 1024
ABSENT = "pii_"

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
#: name, kind, pattern, what a text must contain to be searched
PATTERNS = (
    ("email", 0, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", "@"),
    ("ip", 1, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", 2, r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+", None),
    ("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    (
        "email_words",
        0,
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._-]{{0,63}}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{{1,63}}"
        rf"(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z]{{2,24}}){{1,3}}",
        None,
    ),
    ("ip_six", 1, r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", ":"),
    ("phone_national", 3, r"(?<![0-9+(.-])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[.-][0-9]{4}(?![0-9-])", None),
)
BASE = 4

# Parts of the gazetteers.
TOP_DOMAINS = ("com org net edu gov mil int info biz io co uk us ca au nz ie de at ch fr be nl es it pt pl cz se no dk "
               "fi gr ru ua jp cn kr in br mx ar za eu").split()
COUNTRY_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
                 "66 81 82 84 86 90 91 92 93 94 95 98").split()
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|65|62)"
CONTEXT_FOR = (
    r"\b(?:e-?mails?|mail|mailto|contact|write|reach)\b",
    r"\b(?:ip|ips|host|server|address|client|ping|addr)\b",
    r"\b(?:card|visa|mastercard|amex|credit|debit|payment|cc)\b",
    r"\b(?:phone|call|tel|telephone|mobile|cell|fax|dial|sms)\b",
)
CONTEXT_AGAINST = r"\b(?:version|release|build|isbn|doi|order|invoice|serial|section|chapter|ticket|token|sha|md5|id|ref)\b"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when((F.length(digits) - i) % 2 == 0, digits.substr(i, F.lit(1)).cast("int")).otherwise(
            (digits.substr(i, F.lit(1)).cast("int") * 2) % 10 + F.floor(digits.substr(i, F.lit(1)).cast("int") / 5).cast("int")
        ),
    )
    return total % 10 == 0


def base_check(name: str, hit: Column) -> Column:
    """Whether a match of a base pattern is a base span."""
    if name == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        part = f"(?:{part}|0++)"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if name == "card":
        digits = _digits(hit)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if name == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def votes(name: str, kind: int, hit: Column, ok: Column, before: Column, after: Column) -> list[Column]:
    """The five labelers: format, gazetteer, context, shape, boundaries."""
    digits = _digits(hit)
    context = F.lower(before)
    if kind == 0:
        top = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)[\])]*$", 1))
        gazetteer = _vote(top.isin(TOP_DOMAINS), top.rlike("[0-9]"))
        shape = _vote(F.length(hit).between(6, 64), F.length(hit) > 100)
    elif kind == 1:
        first = F.regexp_extract(hit, r"^0*([0-9]+)\.", 1)
        gazetteer = _vote(
            F.when(first == "", F.lit(True)).otherwise((F.length(first) <= 3) & first.cast("int").between(1, 223)), F.lit(True)
        )
        shape = _vote(~hit.rlike(r"(?:^|\.)0[0-9]"), F.lit(True))
    elif kind == 2:
        gazetteer = _vote(digits.rlike(CARD_PREFIX), F.lit(True))
        shape = _vote(F.length(digits).isin(15, 16), ~F.length(digits).between(13, 19))
    else:
        gazetteer = (
            _vote(digits.rlike("^(?:" + "|".join(COUNTRY_CODES) + ")"), F.lit(True)) if name == "phone" else F.lit(0)
        )
        shape = _vote(hit.rlike(r"[0-9][\x20().-]+[0-9]{3}[\x20().-]+[0-9]{3,4}$"), F.length(digits) < 8)
    near = _vote(context.rlike(CONTEXT_FOR[kind]), context.rlike(CONTEXT_AGAINST))
    edge = _vote(~before.rlike(r"[A-Za-z0-9_=/#-]$") & ~after.rlike(r"^[A-Za-z0-9_=/#@-]"), F.lit(True))
    return [_vote(ok, F.lit(True)), gazetteer, near, shape, edge]


def span_features(hit: Column, before: Column, after: Column) -> Column:
    """Discrete features for the classifier, as texts."""
    length = F.least(F.length(hit), F.lit(40))
    return F.array(
        F.concat(F.lit("len"), F.floor(length / 4).cast("string")),
        F.concat(F.lit("dig"), F.least(F.length(_digits(hit)), F.lit(24)).cast("string")),
        F.concat(F.lit("sep"), F.least(F.length(F.regexp_replace(hit, "[A-Za-z0-9]", "")), F.lit(9)).cast("string")),
        F.concat(F.lit("pre"), F.regexp_replace(F.regexp_replace(F.right(before, F.lit(1)), r"[A-Za-z]", "a"), "[^a \n(:=\"']", "o")),
        F.concat(F.lit("post"), F.regexp_replace(F.regexp_replace(F.left(after, F.lit(1)), r"[A-Za-z]", "a"), "[^a \n).,\"']", "o")),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and wherever the body uses it."""
    return F.transform(F.array(value), body)[0]


def scan_before(values: Column, zero: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each element of a non-empty array, all elements before it combined, from ``zero`` on.

    An array cannot grow in place, so one fold would copy it once an element. Here folds run within blocks of about
    the square root of the length, and once over the blocks.
    """

    def fold(array: Column, last: Callable[[Column], Column]) -> Column:
        return F.aggregate(array, F.array(zero), lambda seen, v: F.array_append(seen, combine(F.element_at(seen, -1), last(v))))

    def inside(array: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(array))).cast("int")
        return let(
            width,
            lambda w: F.transform(
                F.sequence(F.lit(0), F.floor((F.size(array) - 1) / w).cast("int")),
                lambda b: fold(F.slice(array, b * w + 1, w), lambda v: v),
            ),
        )

    def joined(blocks: Column, starts: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda p, b: F.transform(F.slice(p, 1, F.size(p) - 1), lambda v: combine(starts[b], v))))

    return let(
        values,
        lambda array: let(
            inside(array),
            lambda blocks: let(fold(blocks, lambda p: F.element_at(p, -1)), lambda starts: joined(blocks, starts)),
        ),
    )


def first_beyond(spans: Column, place: Column) -> Column:
    """How many leading spans of a sorted array end at or before ``place``, by bisection; the spans do not overlap."""
    begin = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        done = acc["low"] >= acc["high"]
        ends_before = F.get(spans, middle)["end"] <= place
        return F.struct(
            F.when(~done & ends_before, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(~done & ~ends_before, middle).otherwise(acc["high"]).alias("high"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), begin, halve, lambda acc: acc["low"])


def candidates(docs: DataFrame, id_column: str, text_column: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` rows as the id, ``keep`` and ``spans``: all candidates of the text, with votes and features.

    A span has ``start`` and ``end`` in code points (end exclusive), ``kind`` as
    a number, ``base`` (a base span), ``ok`` (its format is right), ``pattern``
    (kind and votes) and ``features``.
    """
    def own(c: str) -> str:
        return f"{ABSENT}{c}"

    text = F.col(own("text"))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in dict.fromkeys((id_column, *keep))], known(F.col(f"`{text_column}`")).alias(own("text"))
    )
    carried = rows.columns
    none = F.array().cast("array<string>")
    has_digit = text.rlike("[0-9]")

    def guard(name: str, needs: str | None) -> Column:
        if name == "email_words":
            return text.rlike(r"[\[(](?:at|AT)[\])]")
        if needs in ("@", "+"):
            return text.contains(needs)
        return has_digit & text.contains(needs) if needs else has_digit

    hits = rows.select(
        *[F.col(f"`{c}`") for c in carried],
        *[
            F.when(guard(name, needs), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias(own(f"h_{name}"))
            for name, _, pattern, needs in PATTERNS
        ],
    )
    gaps = hits.select(
        *[F.col(f"`{c}`") for c in hits.columns],
        *[
            F.when(F.size(own(f"h_{name}")) > 0, F.split(text, pattern, -1)).otherwise(none).alias(own(f"g_{name}"))
            for name, _, pattern, _ in PATTERNS
        ],
    )

    def found(index: int) -> Column:
        name, kind, _, _ = PATTERNS[index]
        hit, gap = F.col(own(f"h_{name}")), F.col(own(f"g_{name}"))
        lengths = F.transform(F.sequence(F.lit(0), F.size(hit) - 1), lambda i: F.length(gap[i]) + F.length(hit[i]))
        before_each = scan_before(lengths, F.lit(0), lambda a, b: a + b)
        starts = F.transform(before_each, lambda passed, i: passed + F.length(gap[i]))

        def span(start: Column, i: Column) -> Column:
            ok = base_check(name, hit[i])
            before, after = F.right(gap[i], F.lit(32)), F.left(gap[i + 1], F.lit(12))
            cast = [v.cast("string") for v in votes(name, kind, hit[i], ok, before, after)]
            return F.struct(
                start.alias("start"),
                F.lit(kind).alias("kind"),
                (start + F.length(hit[i])).alias("end"),
                (ok if index < BASE else F.lit(False)).alias("base"),
                ok.alias("ok"),
                F.concat_ws(",", F.lit(str(kind)), *cast).alias("pattern"),
                span_features(hit[i], before, after).alias("features"),
            )

        made = F.transform(starts, span)
        if name == "card":  # a short run of digits is not even a candidate
            made = F.filter(made, lambda s: s["end"] - s["start"] >= 13)
        empty = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean,ok:boolean,pattern:string,features:array<string>>>")
        return F.when(F.size(hit) > 0, made).otherwise(empty)

    spans = F.concat(*[found(i) for i in range(len(PATTERNS))])
    return gaps.select(*[F.col(f"`{c}`") for c in carried if c != own("text")], spans.alias("spans"))


@dataclass(frozen=True)
class SpanModel:
    """Log-odds weights by ``kind:feature`` and the log odds of each kind without features."""

    prior: Mapping[str, float] = field(default_factory=dict)
    weights: Mapping[str, float] = field(default_factory=dict)
    posterior: Mapping[str, float] = field(default_factory=dict)


def reliabilities(counts: Mapping[str, int], rounds: int = 30) -> dict[str, float]:
    """Probability that a span is true, for every vote pattern ``kind,v1,..``, by expectation-maximisation.

    Each labeler has, for each kind, its own vote distribution on true and on
    false spans. It begins from the share of votes for a span; counts are
    smoothed so that a labeler never becomes certain. Spans of a kind are true
    with that kind's estimated share.
    """
    by_kind: dict[str, list[tuple[tuple[int, ...], int, str]]] = defaultdict(list)
    for key, n in sorted(counts.items()):
        kind, *own = key.split(",")
        by_kind[kind].append((tuple(map(int, own)), n, key))
    result: dict[str, float] = {}
    for rows in by_kind.values():
        p = {key: min(0.95, max(0.05, 0.5 + 0.5 * (sum(v) + v[0]) / (len(v) + 1))) for v, _, key in rows}
        for _ in range(rounds):
            total = sum(n for _, n, _ in rows)
            share = (sum(p[key] * n for _, n, key in rows) + 1) / (total + 2)
            tables = []
            for j in range(len(rows[0][0])):
                table = {}
                for y in (0, 1):
                    mass = {v: 1.0 for v in (-1, 0, 1)}
                    for own, n, key in rows:
                        mass[own[j]] += n * (p[key] if y else 1 - p[key])
                    whole = sum(mass.values())
                    table[y] = {v: m / whole for v, m in mass.items()}
                tables.append(table)
            for own, _, key in rows:
                odds = math.log(share / (1 - share)) + sum(
                    math.log(t[1][v] / t[0][v]) for t, v in zip(tables, own, strict=True)
                )
                p[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        result.update(p)
    return result


def _lookup(values: Mapping[str, float], key: Column, default: float) -> Column:
    if not values:
        return F.lit(default)
    pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (k, float(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def fit_spans(found: DataFrame) -> SpanModel:
    """Learn from the candidates of all texts. What reaches the driver is bounded by patterns and feature values."""
    each = found.select(F.explode("spans").alias("s")).select("s.*")
    counted = each.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()
    posterior = reliabilities({r["pattern"]: r["n"] for r in counted})
    if not posterior:
        return SpanModel()
    weighted = each.select(
        F.col("kind").cast("string").alias("kind"),
        _lookup(posterior, F.col("pattern"), 0.5).alias("p"),
        F.explode(F.concat(F.col("features"), F.array(F.lit("*")), F.transform(
            F.split("pattern", ","), lambda v, i: F.concat(F.lit("vote"), i.cast("string"), F.lit("="), v)
        ))).alias("feature"),
    )
    sums = weighted.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    totals = {r["kind"]: (r["yes"], r["no"]) for r in sums if r["feature"] == "*"}
    prior = {k: math.log((yes + 1) / (no + 1)) for k, (yes, no) in totals.items()}
    weights = {}
    for r in sums:
        if r["feature"] != "*":
            yes, no = totals[r["kind"]]
            weights[f"{r['kind']}:{r['feature']}"] = math.log((r["yes"] + 1) / (yes + 8)) - math.log((r["no"] + 1) / (no + 8))
    return SpanModel(prior, weights, posterior)


def accepted(spans: Column, model: SpanModel) -> Column:
    """Base spans, and further candidates that the classifier accepts and that touch no base span; sorted."""
    base = F.filter(spans, lambda s: s["base"])
    of_kind = [F.filter(spans, lambda s, k=k: s["base"] & (s["kind"] == k)) for k in range(len(KINDS))]

    def touches(own: Column, s: Column) -> Column:
        """Spans of one kind are sorted and apart, so only the first that ends after the candidate begins can touch it."""
        return F.coalesce(F.get(own, first_beyond(own, s["start"]))["start"] < s["end"], F.lit(False))

    def good(s: Column, bases: Column) -> Column:
        kind = s["kind"].cast("string")
        own = F.concat(
            s["features"],
            F.transform(F.split(s["pattern"], ","), lambda v, i: F.concat(F.lit("vote"), i.cast("string"), F.lit("="), v)),
        )
        score = F.aggregate(
            own,
            _lookup(model.prior, kind, -1.0),
            lambda acc, f: acc + _lookup(model.weights, F.concat(kind, F.lit(":"), f), 0.0),
        )
        hit = touches(bases[KINDS[0]], s)
        for kind_name in KINDS[1:]:
            hit = hit | touches(bases[kind_name], s)
        return s["ok"] & (score > 0) & ~hit

    further = F.filter(spans, lambda s: ~s["base"])
    bases = F.struct(*[spans_of.alias(k) for spans_of, k in zip(of_kind, KINDS, strict=True)])
    added = let(bases, lambda every: F.filter(further, lambda s: good(s, every)))
    chosen = F.when(F.size(further) > 0, F.concat(base, added)).otherwise(base)
    return F.array_sort(F.transform(chosen, lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"])))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of every row's whole text, and digests of the base spans.

    Returns the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans),
    ``base_sha256`` and ``spans``. NULL and empty texts have no spans. Repeated
    rows and NULL ids are answered row by row. An empty table gives an empty
    result. Columns other than the two named ones are not looked at.
    """
    found = stage(candidates(docs, id_column, text_column), "pii")
    model = fit_spans(found)
    marked = found.select(F.col(f"`{id_column}`"), accepted(F.col("spans"), model).alias("s"))
    base = F.filter("s", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("s", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return marked.select(
        F.col(f"`{id_column}`"), *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("s")).alias("spans")
    )


def redact(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets, such as ``[EMAIL]``.

    Overlapping spans are replaced as one, named after the one that begins
    first. NULL texts stay NULL and empty texts empty; repeated rows are answered row by row, an empty table gives an
    empty result. All columns keep their names and order.
    """
    # Inside, columns go by number, so that no name of theirs clashes.
    originals = docs.columns
    text_column = f"c{originals.index(text_column)}"
    docs = docs.toDF(*[f"c{i}" for i in range(len(originals))])
    found = stage(candidates(docs, text_column, text_column, tuple(docs.columns)), "pii_redact")
    model = fit_spans(found)
    spans = F.col("marked")
    marked = found.select(*[F.col(f"`{c}`") for c in docs.columns], accepted(F.col("spans"), model).alias("marked"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col(f"`{text_column}`")
    ends = F.transform(spans, lambda s: s["end"])
    last = F.array_max(ends)

    def cut(blocks: Column, begin: Column, end: Column) -> Column:
        """Characters ``begin`` to ``end`` from blocks of ``CHARACTERS``."""
        first = F.floor(begin / CHARACTERS).cast("int")
        many = F.floor(end / CHARACTERS).cast("int") - first + 1
        return F.array_join(F.slice(blocks, first + 1, many), "").substr(begin - first * CHARACTERS + 1, end - begin)

    def replaced(blocks: Column, reached: Column) -> Column:
        parts = F.transform(
            spans,
            lambda s, i: F.when(
                s["start"] >= reached[i], F.concat(cut(blocks, reached[i], s["start"]), F.element_at(names, s["kind"] + 1))
            ).otherwise(F.lit("")),
        )
        return F.concat(F.array_join(parts, ""), cut(blocks, last, F.length(text)))

    in_blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHARACTERS}}}"), F.lit(0))
    pieces = let(in_blocks, lambda blocks: let(scan_before(ends, F.lit(0), F.greatest), lambda reached: replaced(blocks, reached)))
    changed = F.when(F.size(spans) > 0, pieces).otherwise(text).alias(text_column)
    return marked.select(*[changed if c == text_column else F.col(c) for c in docs.columns]).toDF(*originals)
