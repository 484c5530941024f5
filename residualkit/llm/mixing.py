"""Mixing sources to target weights: budgets down a domain-language-source tree, token prefixes of seeded epochs.

Everything here is DataFrame functions and windows; no Python runs on the executors.

*Budgets.* Every leaf can give at most ``max_epochs`` times its tokens. From the
root down, each node shares its budget among its children in proportion to their
weights, but gives none more than its whole subtree can give. What a child
cannot take goes to its siblings, again by weight, and never leaves a subtree
that can still take it: a shortage is made up by siblings before ancestors. The
shares of one node are one sorted pass: children in the order of capacity per
weight, the first ones full, the others at one common level.

*Selection.* In each epoch the documents of a leaf are ordered by the md5 of
seed, epoch and id. A leaf takes whole epochs and then the token prefix of one
more. That prefix is found without ordering a whole leaf in one task: tokens are
summed per slice of the hash range (``SLICES`` a leaf), the slice in which the
prefix ends is found from these sums, and only that slice's documents are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.llm.frames import known
from residualkit.operators.lookup import lookup_join
from residualkit.staging import stage

SLICES = 4096
LEVELS = ("domain", "lang", "source")
N = "mix_"


def word_count(text: Column) -> Column:
    """Words of a text: runs of characters other than ASCII white space."""
    return F.regexp_count(known(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def domain_of(source: Column, domains: int = 3) -> Column:
    """A domain for tables that have none: the first hex digit of the md5 of the source, modulo ``domains``."""
    digit = F.conv(F.substring(F.md5(known(source).cast("binary")), 1, 1), 16, 10).cast("int")
    return F.concat(F.lit("domain"), (digit % domains).cast("string"))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in an epoch, as a hex text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _weight(weights: Mapping[tuple[str, ...], int], path: Sequence[Column]) -> Column:
    """The integer weight of a node; 1 where none is given."""
    own = [(k, w) for k, w in weights.items() if len(k) == len(path)]
    column = F.lit(1).cast("long")
    for key, weight in own:
        same = F.lit(True)
        for c, v in zip(path, key, strict=True):
            same = same & (c == v)
        column = F.when(same, F.lit(int(weight)).cast("long")).otherwise(column)
    return column


def _wide(name: str) -> str:
    """Products of tokens and weights need more than 64 bits."""
    return f"cast({name} as decimal(19, 0))"


def share(children: DataFrame, parent: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Add ``given`` to rows with ``weight``, ``capacity`` and the parent's ``budget``.

    Sums exactly to the smaller of budget and total capacity: what integer
    division leaves over, less than one token a child, goes one by one to the
    children that are not full, in the order of ``tie``.
    """
    by_ratio = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), *tie)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    ranked = children.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).alias("_left"),
        F.sum("weight").over(onward).alias("_weights"),
        F.row_number().over(by_ratio).alias("_place"),
    )
    # The first child whose proportional share of what is left fits into it; from there on nobody is full.
    fits = F.expr(f"{_wide('_left')} * {_wide('weight')} <= {_wide('capacity')} * {_wide('_weights')}")
    first = ranked.withColumn("_first", F.min(F.when(fits, F.col("_place"))).over(whole))
    at = first.select(
        "*",
        F.max(F.when(F.col("_place") == F.col("_first"), F.col("_left"))).over(whole).alias("_l"),
        F.max(F.when(F.col("_place") == F.col("_first"), F.col("_weights"))).over(whole).alias("_w"),
    )
    open_child = F.col("_first").isNotNull() & (F.col("_place") >= F.col("_first"))
    floors = at.withColumn("given", F.when(open_child, F.expr(f"{_wide('_l')} * {_wide('weight')} div _w")).otherwise(F.col("capacity")))
    spare = floors.select(
        "*",
        (F.least(F.col("budget"), F.sum("capacity").over(whole)) - F.sum("given").over(whole)).alias("_spare"),
        (F.col("given") < F.col("capacity")).cast("int").alias("_room"),
    )
    turn = Window.partitionBy(*parent).orderBy(F.desc("_room"), *tie)
    dealt = spare.withColumn(
        "given", F.col("given") + F.when((F.col("_room") == 1) & (F.row_number().over(turn) <= F.col("_spare")), 1).otherwise(0)
    )
    return dealt.select(*children.columns, "given")


def budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], percent: int, max_epochs: int
) -> DataFrame:
    """``leaves`` (levels, ``tokens``) with ``given``: the tokens to take from each.

    The whole budget is ``percent`` per cent of all tokens. Windows run over the
    children of one node, which are aggregated rows, never documents.
    """
    level_frames = []
    for depth in range(1, len(levels) + 1):
        own = list(levels[:depth])
        nodes = leaves.groupBy(*own).agg((F.sum("tokens") * max_epochs).alias("capacity"))
        level_frames.append(nodes.withColumn("weight", _weight(weights, [F.col(c) for c in own])))
    total = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * percent).alias("t")).select(F.expr("t div 100").alias("budget"))
    given = None
    for depth, nodes in enumerate(level_frames):
        own = list(levels[: depth + 1])
        parent = list(levels[:depth])
        if given is None:
            top = nodes.withColumn("budget", F.lit(_single(total)).cast("long"))
        else:
            top = nodes.join(given.select(*parent, F.col("given").alias("budget")), parent)
        given = share(top, parent or [F.lit(0)], own)
    return leaves.join(given.select(*levels, "given"), list(levels))


def _single(frame: DataFrame) -> int:
    return int(frame.first()[0])


def mix(
    docs: DataFrame,
    weights: Mapping[tuple[str, ...], int],
    percent: int = 50,
    max_epochs: int = 2,
    seed: int = 13,
    tokens: Column | None = None,
    domain: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The chosen documents, one row for each time one is taken.

    Returns ``doc_id, domain, lang, source, epoch, tokens, taken`` and the
    columns in ``keep``; ``taken`` is smaller than ``tokens`` only for the
    document in which a leaf's prefix ends. ``weights`` maps a path such as
    ``("domain0", "en")`` to an integer; nodes without one weigh 1 and a weight
    of 0 takes nothing.

    NULL languages and sources are the empty text; a NULL text has no tokens,
    and documents without tokens are taken where the prefix has not ended
    before them. Rows with a NULL id are ordered as an empty id. Repeated rows
    are documents of their own; rows of equal id stand next to each other in
    every epoch, longer ones first. An empty table gives an empty result. Columns
    that are neither named here nor in ``keep`` are not looked at; one in ``keep`` that is also a column of the
    result must be one of ``doc_id, lang, source``, which are returned once, NULL as the empty text.
    """
    clashing = {"domain", "epoch", "tokens", "taken"} & set(keep)
    if clashing:
        raise ValueError(f"columns {sorted(clashing)} of the result cannot be kept from the documents")
    source = F.col("source")
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"{N}keep_{i}") for i, c in enumerate(keep)],
        F.col("doc_id"),
        (domain if domain is not None else domain_of(source)).alias("domain"),
        known("lang").alias("lang"),
        known(source).alias("source"),
        (tokens if tokens is not None else word_count(F.col("text"))).alias("tokens"),
    )
    narrow = stage(rows.select("doc_id", *LEVELS, "tokens"), "mix_tokens")
    leaves = stage(narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix_leaves")
    positive = _positive(leaves, weights)
    plan = budgets(positive, LEVELS, weights, percent, max_epochs)
    plan = stage(
        plan.select(
            *LEVELS,
            F.when(F.col("tokens") > 0, F.expr("given div tokens")).otherwise(0).alias("whole"),
            F.when(F.col("tokens") > 0, F.expr("given % tokens")).otherwise(0).alias("rest"),
        ),
        "mix_plan",
    )
    placed = _placed(narrow, plan, seed)
    sums = stage(placed.groupBy(*LEVELS, "slice").agg(F.sum("tokens").alias("t"), F.max("rest").alias("rest")), "mix_slices")
    upto = Window.partitionBy(*LEVELS).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = sums.withColumn("before", F.coalesce(F.sum("t").over(upto), F.lit(0))).filter("before < rest")
    last = stage(
        ends.groupBy(*LEVELS).agg(F.max("slice").alias("last"), F.max_by("before", "slice").alias("before")), "mix_ends"
    )
    source_rows = rows if keep else narrow
    ended = stage(plan.join(last, list(LEVELS), "left"), "mix_ended")
    chosen = _placed(source_rows, ended, seed).filter("whole > 0 or slice <= last")
    partial = chosen.withColumn("epoch", F.col("whole").cast("int"))
    times = F.col("whole") + F.coalesce((F.col("slice") < F.col("last")).cast("int"), F.lit(0))
    inside = chosen.withColumn("_times", times.cast("int")).filter("_times > 0")
    inside = inside.withColumn("epoch", F.explode(F.expr("sequence(0, _times - 1)"))).withColumn("taken", F.col("tokens"))
    in_order = Window.partitionBy(*LEVELS).orderBy("key", F.desc("tokens")).rowsBetween(Window.unboundedPreceding, -1)
    edge = (
        partial.filter("slice = last")
        .withColumn("_seen", F.col("before") + F.coalesce(F.sum("tokens").over(in_order), F.lit(0)))
        .filter("_seen < rest")
        .withColumn("taken", F.least(F.col("tokens"), F.col("rest") - F.col("_seen")))
        .drop("_seen")
    )
    out = ["doc_id", *LEVELS, "epoch", "tokens", "taken"]
    kept = [F.col(f"{N}keep_{i}").alias(c) for i, c in enumerate(keep) if c not in out]
    return inside.select(*out, *kept).unionByName(edge.select(*out, *kept))


def _positive(leaves: DataFrame, weights: Mapping[tuple[str, ...], int]) -> DataFrame:
    """Leaves whose path has no node of weight 0."""
    path = [F.col(c) for c in LEVELS]
    for depth in range(1, len(LEVELS) + 1):
        leaves = leaves.filter(_weight(weights, path[:depth]) > 0)
    return leaves


def _placed(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Rows with their leaf's plan, their key in the epoch that is taken in part, and its slice.

    A plan has one row a leaf. It is broadcast if it is small, so rows are not dealt by leaf; otherwise
    leaves with many rows are split.
    """
    joined = lookup_join(rows, plan, list(LEVELS)).filter("whole is not null")
    keyed = joined.withColumn("key", order_key(seed, F.col("whole"), F.col("doc_id")))
    return keyed.withColumn("slice", F.conv(F.substring("key", 1, 3), 16, 10).cast("int"))
