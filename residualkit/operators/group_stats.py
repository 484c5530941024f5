"""Group means joined back to rows as mean, difference and ratio features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import grouping_mark
from residualkit.operators.lookup import broadcast_limit, lookup_chain, set_sizes
from residualkit.staging import stage_measured


@dataclass(frozen=True)
class GroupStats:
    """A staged table of group means per key set, all learned in one pass."""

    key_sets: tuple[tuple[str, ...], ...]
    values: tuple[str, ...]
    within: tuple[str, ...]
    table: DataFrame
    table_size: int
    set_ids: tuple[int, ...]

    def means(self, index: int) -> DataFrame:
        """Key columns and one mean per value; rows with a missing key are not groups."""
        keys = [*self.within, *self.key_sets[index]]
        rows = self.table.filter(F.col("_set") == self.set_ids[index])
        for k in keys:
            rows = rows.filter(F.col(k).isNotNull())
        return rows.select(*keys, *self.values)

    def apply(self, df: DataFrame, shuffle: bool = False) -> DataFrame:
        """Append ``_mean``, ``_dif`` and ``_ratio`` of every value for every key set.

        All means are joined first and one projection follows. It is given as SQL
        text, because building hundreds of column objects one by one is slow.
        Where means are too large to broadcast, ``df`` is read once more to count
        its heavy keys; ``shuffle`` treats all means that way.
        """
        tables, added = [], []
        for index, key_set in enumerate(self.key_sets):
            name = "_".join(key_set)
            means = self.means(index).withColumnsRenamed({v: f"{name}_{v}_mean" for v in self.values})
            tables.append((means, [*self.within, *key_set], False))
            for v in self.values:
                mean = f"`{name}_{v}_mean`"
                added += [
                    mean,
                    f"{mean} - `{v}` as `{name}_{v}_dif`",
                    f"try_divide({mean} - `{v}`, {mean}) as `{name}_{v}_ratio`",
                ]
        joined = lookup_chain(df, tables, self.sizes(df, shuffle))
        return joined.selectExpr(*[f"`{c}`" for c in df.columns], *added)

    def sizes(self, df: DataFrame, shuffle: bool) -> list[int]:
        """A bound on the bytes of each key set's means: that of the whole table, unless it is too large to broadcast."""
        if shuffle:
            return [1 << 62] * len(self.set_ids)
        if self.table_size <= broadcast_limit(df.sparkSession):
            return [self.table_size] * len(self.set_ids)
        measured = set_sizes(self.table)
        return [measured.get(mark, 0) for mark in self.set_ids]


def fit_group_stats(
    base: DataFrame,
    key_sets: Sequence[Sequence[str]],
    values: Sequence[str],
    within: Sequence[str] = (),
) -> GroupStats:
    """Learn the mean of every value for every key set from ``base``.

    ``within`` columns (such as the snapshot year) are part of every key set.
    All key sets share one scan and one shuffle through grouping sets; the
    partial aggregation before the shuffle takes care of hot groups.
    """
    sets = tuple(tuple(s) for s in key_sets)
    keys = list(dict.fromkeys([*within, *[k for s in sets for k in s]]))
    grouping = [[F.col(k) for k in [*within, *s]] for s in sets]
    means = [F.avg(F.col(v).cast("double")).alias(v) for v in values]
    table = base.groupingSets(grouping, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_set"), *means
    )
    staged, size = stage_measured(table, "means", partition_by="_set")
    return GroupStats(
        sets,
        tuple(values),
        tuple(within),
        staged,
        size,
        tuple(grouping_mark(keys, [*within, *s]) for s in sets),
    )
