"""Out-of-fold target encoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import grouping_mark
from residualkit.functions.scalars import balanced_sum
from residualkit.operators.folds import checked_fold
from residualkit.operators.lookup import broadcast_limit, lookup_chain, set_sizes
from residualkit.staging import stage_measured


@dataclass(frozen=True)
class TargetEncoding:
    """One key set's means: over all rows, and over all folds but one for each fold.

    In a composite key a missing part is a category of its own; a missing single
    key belongs to no category.
    """

    keys: tuple[str, ...]
    name: str
    table: DataFrame
    table_size: int
    global_mean: float | None
    folds: int

    @property
    def composite(self) -> bool:
        return len(self.keys) > 1

    def apply_train(self, df: DataFrame, fold: str) -> DataFrame:
        """Mean target of the category in the other folds; NULL if it is only in this one."""
        return apply_encodings(df, [self], fold)

    def apply(self, df: DataFrame) -> DataFrame:
        """Mean target of the category over all training rows, else the global mean."""
        return apply_encodings(df, [self])


def apply_encodings(df: DataFrame, encodings: Sequence[TargetEncoding], fold: str | None = None) -> DataFrame:
    """Add several encodings: for ``fold``, the means over the other folds; without it, those over all rows.

    If the encodings are too large to broadcast, heavy keys of all of them are
    counted in one pass over ``df``.
    """
    tables, values = [], {}
    for i, e in enumerate(encodings):
        own = f"_enc_{i}"
        tables.append((e.table.select(*e.keys, F.col("_mean" if fold is None else "_others").alias(own)), e.keys, e.composite))
        if fold is None:
            values[e.name] = F.coalesce(F.col(own), F.lit(e.global_mean).cast("double"))
        else:
            values[e.name] = F.get(F.col(own), checked_fold(fold, e.folds))
    joined = lookup_chain(df, tables, [e.table_size for e in encodings])
    return joined.withColumns(values).drop(*[f"_enc_{i}" for i in range(len(encodings))])


def fit_target_encodings(
    train: DataFrame, key_sets: Sequence[str | Sequence[str]], target: str, fold: str, k: int
) -> list[TargetEncoding]:
    """Learn the encodings of several key sets in one scan and one shuffle.

    Rows are reduced to sums and counts per category and fold before the
    shuffle, so a hot category costs no more than any other. A fold's mean adds
    up the other folds; nothing of its own rows enters it. A missing fold, or
    one that is not between 0 and ``k`` - 1, is an error at run time: its rows would be
    in no mean.
    """
    sets = [(s,) if isinstance(s, str) else tuple(s) for s in key_sets]
    keys = list(dict.fromkeys(c for s in sets for c in s))
    value = F.col(target).cast("double")
    train = train.withColumn(fold, checked_fold(fold, k))
    sums = [F.sum(F.when(F.col(fold) == i, value)).alias(f"_s{i}") for i in range(k)]
    counts = [F.count(F.when(F.col(fold) == i, value)).alias(f"_n{i}") for i in range(k)]
    grouping = [*[[F.col(c) for c in s] for s in sets], []]
    parts = train.groupingSets(grouping, *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("_set"), F.avg(value).alias("_mean"), *sums, *counts
    )

    def mean_of(folds: list[int]):
        total = balanced_sum([F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) for i in folds])
        return F.try_divide(total, balanced_sum([F.col(f"_n{i}") for i in folds]))

    everything = list(range(k))
    means = parts.select(
        "_set",
        *keys,
        "_mean",
        F.array(*[mean_of([j for j in everything if j != i]) for i in everything]).alias("_others"),
    )
    staged, size = stage_measured(means, "encodings", partition_by="_set")
    whole = staged.filter(F.col("_set") == grouping_mark(keys, [])).select("_mean").first()
    overall = whole["_mean"] if whole else None

    limit = broadcast_limit(train.sparkSession)
    measured = set_sizes(staged) if size > limit else {}

    encodings = []
    for s in sets:
        rows = staged.filter(F.col("_set") == grouping_mark(keys, s))
        if len(s) == 1:
            rows = rows.filter(F.col(s[0]).isNotNull())
        name = "_".join([*s, target, "enc"])
        own_size = measured.get(grouping_mark(keys, s), 0) if measured else size
        encodings.append(TargetEncoding(s, name, rows.select(*s, "_mean", "_others"), own_size, overall, k))
    return encodings
