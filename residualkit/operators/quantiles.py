"""Exact quantiles of groups of any size.

Groups of at most ``rows_at_most`` rows are counted by value and summed up in order.
For a larger group, each wanted rank gets a bracket of values first: a mergeable sketch of the rows
inside gives a grid of values, the two grid cells around the rank become the new bracket, and one
pass counts what lies below and inside of it. That is repeated while a bracket holds too many rows; it shrinks
by a factor of about ``GRID`` / 3 a round. Only the rows inside a bracket are then summed up in order. The sketch
never decides a result: a bracket counts only if the exact numbers show the rank inside.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.operators.lookup import lookup_join
from residualkit.staging import stage

GRID = 256
ACCURACY = 16 * GRID
ROWS_AT_MOST = 1 << 20
MAX_ROUNDS = 40


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    rows_at_most: int = ROWS_AT_MOST,
) -> DataFrame:
    """``groups``, ``n`` and ``quantiles``: for each probability p the value at rank p * (n - 1), interpolated.

    Missing values do not count; a group without a present value is not in the result. A
    missing group key is a group of its own. The work of one task is bounded by ``rows_at_most``
    different values, except where a group repeats a few values so often that no
    bracket gets smaller; repeated values are counted before the shuffle.
    """
    if any(not 0 <= p <= 1 for p in probabilities):
        raise ValueError(f"probabilities are between 0 and 1, not {list(probabilities)}")
    keys = [f"_g{i}" for i in range(len(groups))] or ["_all"]
    given = [F.col(c).alias(k) for c, k in zip(groups, keys, strict=False)] or [F.lit(0).alias("_all")]
    present = df.select(*given, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    values = stage(present, "values")
    sizes = stage(values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "sizes")
    large = stage(sizes.filter(F.col("n") > rows_at_most), "large")
    if large.head(1):
        brackets = _narrowed(values, _first_brackets(large, probabilities), keys, rows_at_most)
        marked = lookup_join(values, brackets, keys, null_safe=True)
        whole = marked.filter("_b is null").select(*keys, F.lit(-1).alias("_i"), "_v")
        inside = marked.select(*keys, "_v", F.inline("_b")).filter(_inside()).select(*keys, "_i", "_v")
        ranked = _ranked(whole.unionByName(inside), keys)
    else:
        brackets = None
        ranked = _ranked(values.select(*keys, F.lit(-1).alias("_i"), "_v"), keys)
    answers = _picked(ranked, sizes, brackets, keys, probabilities)
    return answers.select(*[F.col(k).alias(c) for k, c in zip(keys, groups, strict=False)], "n", "quantiles")


def _ranks(n: Column, p: float) -> tuple[Column, Column, Column]:
    """The two 0-based ranks around p * (n - 1), and how far the place is from the first."""
    place = F.lit(float(p)) * (n - 1)
    first = F.floor(place).cast("long")
    return first, F.least(first + 1, n - 1), place - first


def _inside() -> Column:
    return (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))


def _first_brackets(large: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    rows = []
    for i, p in enumerate(probabilities):
        first, second, _ = _ranks(F.col("n"), p)
        rows.append(
            F.struct(
                F.lit(i).alias("_i"),
                first.alias("_first"),
                second.alias("_second"),
                F.lit(float("-inf")).alias("_low"),
                F.lit(float("inf")).alias("_high"),
                F.lit(0).cast("long").alias("_below"),
                F.col("n").alias("_rows"),
                F.lit(False).alias("_done"),
            )
        )
    return large.withColumn("_b", F.array(*rows)).drop("n")


def _narrowed(values: DataFrame, brackets: DataFrame, keys: Sequence[str], rows_at_most: int) -> DataFrame:
    """Brackets that hold their ranks and at most ``rows_at_most`` rows each, unless they cannot shrink."""
    for _ in range(MAX_ROUNDS):
        flat = stage(brackets.select(*keys, F.inline("_b")), "brackets")
        is_open = ~F.col("_done") & (F.col("_rows") > rows_at_most)
        todo = flat.filter(is_open)
        if not todo.head(1):
            return stage(flat.groupBy(*keys).agg(F.collect_list(F.struct(*flat.drop(*keys).columns)).alias("_b")), "narrowed")
        cells = [F.lit(j / GRID) for j in range(GRID + 1)]
        sketch = _facing(values, todo, keys).groupBy(*keys, "_i").agg(
            F.percentile_approx("_v", F.array(*cells), ACCURACY).alias("_grid")
        )
        grid = stage(sketch, "grid")
        tighter = _join_brackets(todo, grid, keys).withColumns({"_new_low": _cell("_first", -1), "_new_high": _cell("_second", 2)})
        proposed = stage(
            tighter.select(
                *keys, "_i", "_first", "_second", F.col("_new_low").alias("_low"), F.col("_new_high").alias("_high"),
                F.col("_low").alias("_old_low"), F.col("_high").alias("_old_high"), F.col("_below").alias("_old_below"),
                F.col("_rows").alias("_old_rows"),
            ),
            "proposed",
        )
        counted = _facing(values, proposed, keys, "_old_low", "_old_high").groupBy(*keys, "_i").agg(
            F.count(F.when(F.col("_v") < F.col("_low"), 1)).alias("_more"), F.count(F.when(_inside(), 1)).alias("_now")
        )
        checked = _join_brackets(proposed, stage(counted, "counted"), keys)
        below = F.col("_old_below") + F.col("_more")
        holds = (below <= F.col("_first")) & (F.col("_second") < below + F.col("_now"))
        smaller = F.col("_now") < F.col("_old_rows")
        use = holds & smaller
        updated = checked.select(
            *keys,
            "_i",
            "_first",
            "_second",
            F.when(use, F.col("_low")).otherwise(F.col("_old_low")).alias("_low"),
            F.when(use, F.col("_high")).otherwise(F.col("_old_high")).alias("_high"),
            F.when(use, below).otherwise(F.col("_old_below")).alias("_below"),
            F.when(use, F.col("_now")).otherwise(F.col("_old_rows")).alias("_rows"),
            (~use).alias("_done"),
        )
        every = flat.filter(~is_open).unionByName(updated)
        brackets = every.groupBy(*keys).agg(F.collect_list(F.struct(*flat.drop(*keys).columns)).alias("_b"))
    raise RuntimeError(f"brackets did not settle in {MAX_ROUNDS} rounds")


def _cell(rank: str, step: int) -> Column:
    """The grid value ``step`` cells from the one the rank falls into."""
    at = F.floor((F.col(rank) - F.col("_below")) * GRID / F.col("_rows")) + step
    return F.element_at("_grid", F.greatest(F.lit(0), F.least(F.lit(GRID), at)).cast("int") + 1)


def _facing(values: DataFrame, brackets: DataFrame, keys: Sequence[str], low: str = "_low", high: str = "_high") -> DataFrame:
    """Values with each bracket of their group that holds them. Only groups above the row limit have brackets."""
    packed = brackets.groupBy(*keys).agg(F.collect_list(F.struct(*[c for c in brackets.columns if c not in keys])).alias("_b"))
    joined = lookup_join(values, stage(packed, "open_brackets"), keys, null_safe=True).filter("_b is not null")
    return joined.select(*keys, "_v", F.inline("_b")).filter((F.col("_v") >= F.col(low)) & (F.col("_v") <= F.col(high)))


def _join_brackets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two bracket tables, which have a row for each large group and probability."""
    other = right.withColumnsRenamed({c: f"_r{c}" for c in (*keys, "_i")})
    same = F.lit(True)
    for c in (*keys, "_i"):
        same = same & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    return left.join(other, same).drop(*[f"_r{c}" for c in (*keys, "_i")])


def _ranked(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values with the 0-based rank of their first row and of the row after their last, within group and bracket."""
    counted = values.groupBy(*keys, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumn("_end", F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))


def _picked(
    ranked: DataFrame, sizes: DataFrame, brackets: DataFrame | None, keys: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """The interpolated values at the wanted ranks."""
    with_size = _null_safe(ranked, sizes, keys)
    if brackets is not None:
        flat = brackets.select(*keys, F.inline("_b")).select(*keys, "_i", "_below")
        with_size = _null_safe(with_size, flat, [*keys, "_i"], "left")
        offset = F.coalesce(F.col("_below"), F.lit(0))
    else:
        offset = F.lit(0)
    picks = []
    for i, p in enumerate(probabilities):
        for side, rank in zip(("a", "b"), _ranks(F.col("n"), p)[:2], strict=True):
            mine = F.col("_i").isin(-1, i)
            here = (F.col("_start") + offset <= rank) & (rank < F.col("_end") + offset)
            picks.append(F.max(F.when(mine & here, F.col("_v"))).alias(f"_{side}{i}"))
    found = with_size.groupBy(*keys, "n").agg(*picks)
    between = []
    for i, p in enumerate(probabilities):
        share = _ranks(F.col("n"), p)[2]
        between.append(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * share)
    return found.select(*keys, "n", F.array(*between).alias("quantiles"))


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by keys of which some may be missing."""
    other = right.withColumnsRenamed({c: f"_r{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    return left.join(other, same, how).drop(*[f"_r{c}" for c in on])


def trim_to_quantiles(
    df: DataFrame, value: str, low: float, high: float, groups: Sequence[str] = (), rows_at_most: int = ROWS_AT_MOST
) -> DataFrame:
    """Rows whose value lies between two quantiles of its group, ends included; rows without a value go."""
    edges = exact_quantiles(df, groups, value, [low, high], rows_at_most)
    keys = list(groups)
    packed = stage(edges.select(*keys, F.col("quantiles").alias("_edges")), "edges")
    if keys:
        joined = lookup_join(df, packed, keys, null_safe=True)
    else:
        found = packed.first()
        joined = df.withColumn("_edges", F.array(*[F.lit(e) for e in found["_edges"]]) if found else F.lit(None).cast("array<double>"))
    return joined.filter(F.col(value).between(F.col("_edges")[0], F.col("_edges")[1])).drop("_edges")


def quantile_profile(
    df: DataFrame, value: str, probabilities: Sequence[float], groups: Sequence[str] = (), rows_at_most: int = ROWS_AT_MOST
) -> DataFrame:
    """``groups``, ``probability``, ``n``, ``value``: one row for each group and probability."""
    found = exact_quantiles(df, groups, value, probabilities, rows_at_most)
    rows = [F.struct(F.lit(float(p)).alias("probability"), F.col("n"), F.col("quantiles")[i].alias("value")) for i, p in enumerate(probabilities)]
    return found.select(*groups, F.inline(F.array(*rows)))
