"""What was known before each row: as-of joins, running totals and statistics of earlier periods.

All of it is one order of (key, time) and what is carried along it. Keys that hold few rows take a
window over the key, with one shuffle. A key with at least 1/``HEAVY_GROUPS`` of the rows is cut into
range blocks, worked off block by block, and what crosses an edge is patched from
a table with at most two rows a block; so a key with a third of all rows is spread over a third of the blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from residualkit.functions.names import grouping_mark
from residualkit.operators.lookup import lookup_chain, set_sizes
from residualkit.operators.ordering import HEAVY_GROUPS, ordered_blocks
from residualkit.staging import stage

# Helper columns of this module.
GROUP, TIME, SIDE, TIE = "_group", "_time", "_side", "_tie"


def split_by_weight(rows: DataFrame, group: str) -> tuple[DataFrame, DataFrame | None]:
    """Staged rows of light groups, and those of heavy groups if there are any; rows without a group are in neither."""
    known = rows.filter(F.col(group).isNotNull())
    counts = stage(known.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")), "group_counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    heavy = counts.filter(F.col("_rows") >= max(2, -(-total // HEAVY_GROUPS))).select(group)
    if not heavy.head(1):
        return known, None
    hot = F.broadcast(heavy)  # at most HEAVY_GROUPS rows
    return known.join(hot, group, "left_anti"), known.join(hot, group, "left_semi")


def carried_forward(rows: DataFrame, group: str, order: Sequence[str], value: str, output: str) -> DataFrame:
    """Add the last present ``value`` among the rows of the group before this one in ``order``.

    ``value`` may be a struct. Rows without a group get NULL. ``rows`` are read several times: stage them.
    """
    light, heavy = split_by_weight(rows, group)
    before = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = light.select(*rows.columns, F.last(value, ignorenulls=True).over(before).alias(output))
    if heavy is not None:
        blocks = ordered_blocks(heavy.select(*rows.columns), [group, *order])
        within = Window.partitionBy("_block", group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        local = blocks.select(*rows.columns, "_block", F.last(value, ignorenulls=True).over(within).alias("_local"))
        last_place = F.when(F.col(value).isNotNull(), F.col("_place"))
        edges = _edges(blocks, group, [F.max_by(value, last_place).alias("_last")])
        earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = edges.select("_block", group, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
        joined = local.join(F.broadcast(carried), ["_block", group], "left")
        found = found.unionByName(joined.select(*rows.columns, F.coalesce("_local", "_carried").alias(output)))
    alone = rows.filter(F.col(group).isNull()).withColumn(output, F.lit(None).cast(found.schema[output].dataType))
    return found.unionByName(alone)


def totals_before(rows: DataFrame, group: str, order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Add, for each ``output: column`` of ``sums``, the sum over the rows of the group before this one in ``order``.

    The sum of nothing, or of missing values only, is 0. Rows without a group get NULL. ``rows`` are read several times: stage them.
    """
    light, heavy = split_by_weight(rows, group)
    before = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = light.select(*rows.columns, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(o) for o, c in sums.items()])
    if heavy is not None:
        blocks = ordered_blocks(heavy.select(*rows.columns), [group, *order])
        within = Window.partitionBy("_block", group).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
        local = blocks.select(*rows.columns, "_block", *[F.sum(c).over(within).alias(f"_l{i}") for i, c in enumerate(sums.values())])
        edges = _edges(blocks, group, [F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())])
        earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = edges.select("_block", group, *[F.sum(f"_s{i}").over(earlier).alias(f"_c{i}") for i in range(len(sums))])
        joined = local.join(F.broadcast(carried), ["_block", group], "left")
        both = [(F.coalesce(f"_l{i}", F.lit(0)) + F.coalesce(f"_c{i}", F.lit(0))).alias(o) for i, o in enumerate(sums)]
        found = found.unionByName(joined.select(*rows.columns, *both))
    alone = rows.filter(F.col(group).isNull())
    return found.unionByName(alone.withColumns({o: F.lit(None).cast(found.schema[o].dataType) for o in sums}))


def _edges(blocks: DataFrame, group: str, aggregates: Sequence[Column]) -> DataFrame:
    """Aggregates of the first and the last group of every block; only these can go on in another block."""
    ends = blocks.groupBy("_block").agg(F.min(group).alias("_low"), F.max(group).alias("_high"))
    at_edge = (F.col(group) == F.col("_low")) | (F.col(group) == F.col("_high"))
    return blocks.join(F.broadcast(ends), "_block").filter(at_edge).groupBy("_block", group).agg(*aggregates)


def asof_rows(
    rows: DataFrame,
    events: DataFrame,
    key: str,
    cutoff: str,
    time: str,
    values: Mapping[str, str],
    tie: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """Add to each row what the last event of its key before its own ``cutoff`` says.

    ``values`` maps a new column to an event column. Events at the very cutoff count only if ``inclusive``. Of events at one
    time the last by the ``tie`` columns counts, which with ``time`` should be a total order.
    The last event counts even where its values are missing. Rows without a key or a cutoff, or with no earlier event, get
    NULL; events without a key or a time are never found.

    Both sides are put in one order and the events carried along it: one shuffle of rows and events, no join by key.
    """
    payload = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    ties = [f"{TIE}{i}" for i in range(len(tie))]
    own = [f"_c{i}" for i in range(len(rows.columns))]
    kinds = dict(zip(own, (f.dataType for f in rows.schema.fields), strict=True))
    tie_kinds = [events.schema[t].dataType for t in tie]
    time_kind = events.schema[time].dataType
    # At the same time, rows come before events, or after them if events at the cutoff count.
    asked = rows.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(rows.columns, own, strict=True)],
        F.when(F.col(cutoff).isNotNull(), F.col(key)).alias(GROUP),
        F.col(cutoff).cast(time_kind).alias(TIME),
        F.lit(1 if inclusive else -1).alias(SIDE),
        *[F.lit(None).cast(k).alias(t) for t, k in zip(ties, tie_kinds, strict=True)],
        F.lit(None).cast(events.select(payload.alias("p")).schema["p"].dataType).alias("_event"),
    )
    known = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    told = known.select(
        *[F.lit(None).cast(kinds[n]).alias(n) for n in own],
        F.col(key).alias(GROUP),
        F.col(time).alias(TIME),
        F.lit(0).alias(SIDE),
        *[F.col(t).alias(n) for t, n in zip(tie, ties, strict=True)],
        payload.alias("_event"),
    )
    merged = stage(asked.unionByName(told), "asof")
    carried = carried_forward(merged, GROUP, [TIME, SIDE, *ties], "_event", "_found")
    answered = carried.filter(F.col(SIDE) != 0)
    back = [F.col(n).alias(c) for c, n in zip(rows.columns, own, strict=True)]
    return answered.select(*back, *[F.col("_found")[name].alias(name) for name in values])


@dataclass(frozen=True)
class EarlierTotals:
    """Per key set, key and period: sums and counts of every value over all strictly earlier periods."""

    key_sets: tuple[tuple[str, ...], ...]
    values: tuple[str, ...]
    period: str
    table: DataFrame
    marks: tuple[int, ...]

    def means(self, index: int, null_groups: bool) -> DataFrame:
        """Keys, period and the mean of each value over the earlier periods (NULL where there is none)."""
        keys = self.key_sets[index]
        rows = self.table.filter(F.col("_set") == self.marks[index])
        for k in keys if not null_groups else ():
            rows = rows.filter(F.col(k).isNotNull())
        return rows.select(*keys, self.period, *[F.try_divide(F.col(f"_s_{v}"), F.col(f"_n_{v}")).alias(v) for v in self.values])


def earlier_totals(
    base: DataFrame, rows: DataFrame, key_sets: Sequence[Sequence[str]], values: Sequence[str], period: str
) -> EarlierTotals:
    """Learn from ``base`` what each period of ``rows`` may know: everything before it, nothing of it.

    Both frames are reduced to one row per key and period for all key sets in one aggregation; the running totals are
    carried over these. Rows of ``base`` without a period are in no total.
    """
    sets = tuple(tuple(s) for s in key_sets)
    keys = list(dict.fromkeys(k for s in sets for k in s))
    known = base.filter(F.col(period).isNotNull()).select(*keys, period, *[F.col(v).cast("double").alias(v) for v in values])
    asked = rows.filter(F.col(period).isNotNull()).select(*keys, period, *[F.lit(None).cast("double").alias(v) for v in values])
    both = known.unionByName(asked)
    grouping = [[F.col(k) for k in (*s, period)] for s in sets]
    parts = both.groupingSets(grouping, *[F.col(k) for k in (*keys, period)]).agg(
        F.grouping_id().alias("_set"),
        *[F.sum(v).alias(f"_sum_{v}") for v in values],
        *[F.count(v).alias(f"_count_{v}") for v in values],
    )
    # The sides of a key are told apart by the set; a missing key is a key here, and left out later where it is no group.
    marked = stage(parts.withColumn(GROUP, F.struct("_set", *keys)), "by_period")
    sums = {f"_s_{v}": f"_sum_{v}" for v in values} | {f"_n_{v}": f"_count_{v}" for v in values}
    totals = totals_before(marked, GROUP, [period], sums).select("_set", *keys, period, *sums)
    marks = tuple(grouping_mark([*keys, period], [*s, period]) for s in sets)
    return EarlierTotals(sets, tuple(values), period, stage(totals, "earlier", partition_by="_set"), marks)


def group_stats_as_of(
    rows: DataFrame, base: DataFrame, key_sets: Sequence[Sequence[str]], values: Sequence[str], period: str
) -> DataFrame:
    """Append ``_mean``, ``_dif`` and ``_ratio`` of every value for every key set, from earlier periods of ``base`` only.

    The leak-free form of group statistics: a row sees neither its own period nor a later one. Rows with a missing key or
    period get NULL.
    """
    learned = earlier_totals(base, rows, key_sets, values, period)
    tables, added = [], []
    for i, keys in enumerate(learned.key_sets):
        name = "_".join(keys)
        means = learned.means(i, null_groups=False).withColumnsRenamed({v: f"{name}_{v}_mean" for v in values})
        tables.append((means, [*keys, period], False))
        for v in values:
            mean = F.col(f"{name}_{v}_mean")
            added += [
                mean,
                (mean - F.col(v)).alias(f"{name}_{v}_dif"),
                F.try_divide(mean - F.col(v), mean).alias(f"{name}_{v}_ratio"),
            ]
    measured = set_sizes(learned.table)
    joined = lookup_chain(rows, tables, [measured.get(m, 0) for m in learned.marks])
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *added)


def target_encode_as_of(
    rows: DataFrame, train: DataFrame, key_sets: Sequence[str | Sequence[str]], target: str, period: str
) -> DataFrame:
    """Add the mean target of each category over earlier periods of ``train``, else that of all earlier rows.

    In a composite key a missing part is a category of its own; a missing single key belongs to none. Before the first
    period nothing is known: NULL.
    """
    sets = [(s,) if isinstance(s, str) else tuple(s) for s in key_sets]
    learned = earlier_totals(train, rows, [*sets, ()], [target], period)
    tables = []
    for i, keys in enumerate(learned.key_sets):
        means = learned.means(i, null_groups=len(keys) > 1).withColumnRenamed(target, f"_enc_{i}")
        tables.append((means, [*keys, period], len(keys) > 1))
    measured = set_sizes(learned.table)
    joined = lookup_chain(rows, tables, [measured.get(m, 0) for m in learned.marks])
    overall = F.col(f"_enc_{len(sets)}")
    names = {"_".join([*keys, target, "enc"]): F.coalesce(F.col(f"_enc_{i}"), overall) for i, keys in enumerate(sets)}
    return joined.withColumns(names).drop(*[f"_enc_{i}" for i in range(len(sets) + 1)])
