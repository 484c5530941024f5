"""Fold assignment. A fold is an integer column from 0 to k - 1."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from residualkit.functions.scalars import hash_bucket, hash_order
from residualkit.operators.lookup import HEAVY_SHARE, left_join
from residualkit.operators.ordering import block_starts, ordered_blocks, rows_at
from residualkit.staging import stage


def contiguous_folds(df: DataFrame, k: int, order: Sequence[str], name: str = "fold") -> DataFrame:
    """Cut the rows, in ``order``, into k runs; the first ``n mod k`` are one row longer.

    Only the order columns are sorted, to find the k - 1 rows where a fold
    starts. The frame itself then gets its fold by comparison with those rows,
    without a shuffle. ``order`` must be total where folds meet.
    """
    cuts = fold_cuts(df.select(*order), k, order)
    return df.withColumn(name, _count_cuts(df, order, cuts).cast("int"))


def fold_cuts(df: DataFrame, k: int, order: Sequence[str]) -> list[tuple]:
    """The order values of the first row of folds 1 to k - 1."""
    if k < 2:
        raise ValueError("need at least two folds")
    blocks = ordered_blocks(df, order)
    starts = block_starts(blocks)
    total = sum(rows for _, _, rows in starts)
    sizes = [total // k + (1 if i < total % k else 0) for i in range(k)]
    firsts = [p for p in list(accumulate(sizes))[:-1] if p < total]
    found = rows_at(blocks, starts, sorted({p for f in firsts for p in (f - 1, f) if p >= 0}))
    cuts = []
    for first in firsts:
        here = tuple(found[first][c] for c in order)
        if first > 0 and tuple(found[first - 1][c] for c in order) == here:
            raise ValueError(f"{list(order)} is not a total order: two rows share {here}")
        cuts.append(here)
    return cuts


def _count_cuts(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    types = dict(df.dtypes)
    place = F.struct(*[F.col(c) for c in order])
    count = F.lit(0)
    for cut in cuts:
        start = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, cut, strict=True)])
        count = count + (place >= start).cast("int")
    return count


def shuffled_folds(df: DataFrame, key: str, k: int, seed: int, exact: bool = False, name: str = "fold") -> DataFrame:
    """Random-looking folds by a seeded hash of a unique key.

    By default a pure expression with sizes equal up to chance. ``exact=True``
    cuts the hash order into folds whose sizes differ by at most one.
    """
    if not exact:
        return df.withColumn(name, hash_bucket(key, k, seed))
    marked = df.withColumn("_hash", hash_order(key, seed))
    return contiguous_folds(marked, k, ["_hash", key], name).drop("_hash")


def group_folds(
    df: DataFrame, group: str, k: int, seed: int, name: str = "fold", row_key: str | None = None
) -> DataFrame:
    """Folds by a seeded hash of the group: a group never straddles two folds.

    A row without a group is a group of its own and is placed by ``row_key``.
    Where there is no such column, or it is missing too, the row is an error at
    run time, because a row without a fold would be trained on by no model.
    """
    own = hash_bucket(group, k, seed)
    alone = F.raise_error(F.lit(f"a row has no {group}; name a row_key")).cast("int")
    if row_key is not None:
        alone = F.coalesce(hash_bucket(row_key, k, seed), alone)
    return df.withColumn(name, F.coalesce(own, alone))


@dataclass(frozen=True)
class BalancedFolds:
    """Which fold each heavy group and each bucket of other groups goes to, and the rows of every fold."""

    group: str
    k: int
    seed: int
    heavy: tuple[tuple[object, int], ...]
    buckets: tuple[int, ...]
    sizes: tuple[int, ...]
    largest: int

    def apply(self, df: DataFrame, name: str = "fold", row_key: str | None = None) -> DataFrame:
        """Add the fold; no shuffle, the heavy groups are a broadcast of at most ``HEAVY_SHARE`` rows."""
        of_bucket = F.array(*[F.lit(f) for f in self.buckets])
        light = F.element_at(of_bucket, _bucket_of(self.group, row_key, len(self.buckets), self.seed) + 1)
        if not self.heavy:
            return df.withColumn(name, light)
        schema = T.StructType([T.StructField(self.group, df.schema[self.group].dataType), T.StructField("_fold", T.IntegerType())])
        known = F.broadcast(df.sparkSession.createDataFrame(list(self.heavy), schema))
        joined = left_join(df, known, [self.group])
        return joined.withColumn(name, F.coalesce("_fold", light)).drop("_fold")


def _bucket_of(group: str, row_key: str | None, buckets: int, seed: int) -> Column:
    """The bucket of a group, or of a row that has none."""
    alone = F.raise_error(F.lit(f"a row has no {group}; name a row_key")).cast("int")
    if row_key is not None:
        alone = F.coalesce(hash_bucket(row_key, buckets, seed), alone)
    return F.coalesce(hash_bucket(group, buckets, seed), alone)


def fit_balanced_folds(
    df: DataFrame, group: str, k: int, seed: int, row_key: str | None = None, buckets: int = 1024
) -> BalancedFolds:
    """Folds of whole groups with sizes as equal as the groups allow.

    Groups that hold at least 1/``HEAVY_SHARE`` of the rows are counted one by one; all others are dealt by a seeded hash into
    buckets, which are counted. Largest first, each heavy group and each bucket goes to the fold that has the
    fewest rows. Two folds then differ by no more than the largest of them. A row without a group is a group of its own and is
    dealt by ``row_key``.
    """
    if k < 2:
        raise ValueError("need at least two folds")
    rows = df.select(F.col(group).alias("_group"), _bucket_of(group, row_key, buckets, seed).alias("_bucket"))
    counts = stage(rows.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("n")), "group_sizes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    bar = max(2, -(-total // HEAVY_SHARE))
    is_heavy = F.col("_group").isNotNull() & (F.col("n") >= bar)
    heavy = [(r["n"], 0, str(r["_group"]), r["_group"]) for r in counts.filter(is_heavy).select("_group", "n").collect()]
    light = counts.filter(~is_heavy).groupBy("_bucket").agg(F.sum("n").alias("n")).collect()
    items = sorted([*heavy, *[(r["n"], 1, f"{r['_bucket']:06d}", r["_bucket"]) for r in light]], key=lambda i: (-i[0], i[1], i[2]))
    loads, placed, of_bucket = [0] * k, [], [0] * buckets
    for n, kind, _, item in items:
        fold = min(range(k), key=lambda f: (loads[f], f))
        loads[fold] += n
        if kind == 0:
            placed.append((item, fold))
        else:
            of_bucket[item] = fold
    return BalancedFolds(group, k, seed, tuple(placed), tuple(of_bucket), tuple(loads), max((i[0] for i in items), default=0))


def checked_fold(fold: str, k: int) -> Column:
    """The fold, or an error at run time where it is missing or not between 0 and ``k`` - 1."""
    wrong = F.concat(F.lit(f"{fold} must be 0 to {k - 1}, not "), F.coalesce(F.col(fold).cast("string"), F.lit("missing")))
    return F.when(F.col(fold).between(0, k - 1), F.col(fold)).otherwise(F.raise_error(wrong).cast("int"))
