"""Linear models and their cross-validation from moments: one pass over the rows, whatever the folds and penalties.

For each fold the pass gives the number of rows, the means, and the central second moments of features and
label. Moments of several folds are merged, so every fold's model, which is learned on the other folds, and
its squared error on either side follow from one small row a fold. Central moments are kept, not raw sums,
because these would cancel where means are large.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.functions.scalars import balanced_sum
from residualkit.operators.folds import checked_fold

#: More aggregates than this go to a further pass: an aggregation of thousands of columns leaves generated code.
AGGREGATES = 600


@dataclass(frozen=True)
class Moments:
    """Rows, means, and central second moments (sums of squares divided by the rows) of the features and, last, the label."""

    n: int
    means: np.ndarray
    central: np.ndarray

    def merged(self, other: Moments) -> Moments:
        if self.n == 0 or other.n == 0:
            return other if self.n == 0 else self
        n = self.n + other.n
        gap = other.means - self.means
        share = other.n / n
        central = (self.n * self.central + other.n * other.central) / n + (self.n / n) * share * np.outer(gap, gap)
        return Moments(n, self.means + gap * share, central)


@dataclass(frozen=True)
class Line:
    """An intercept and one coefficient for each feature."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        terms = [F.col(c).cast("double") * F.lit(w) for c, w in zip(self.features, self.coefficients, strict=True)]
        return balanced_sum([F.lit(self.intercept), *terms])

    def apply(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.column())

    def squared_error(self, moments: Moments) -> float | None:
        """Mean squared error on the rows the moments are of, without reading them."""
        if moments.n == 0:
            return None
        weights = np.append(-np.asarray(self.coefficients), 1.0)
        bias = float(weights @ moments.means) - self.intercept
        return float(weights @ moments.central @ weights) + bias * bias


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int) -> list[Moments]:
    """Moments of each fold. Rows missing the label or a feature do not count; a missing or unknown fold is an error."""
    names = [*features, label]
    given = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)]
    rows = df.select(checked_fold(fold, k).alias("_fold"), *given).dropna(subset=[f"_x{i}" for i in range(len(names))])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    wanted = [F.count(F.lit(1)).alias("n"), *[F.avg(f"_x{i}").alias(f"m{i}") for i in range(len(names))]]
    wanted += [F.covar_pop(f"_x{i}", f"_x{j}").alias(f"c{i}_{j}") for i, j in pairs]
    found: dict[int, dict[str, float]] = {i: {} for i in range(k)}
    for begin in range(0, len(wanted), AGGREGATES):
        for row in rows.groupBy("_fold").agg(*wanted[begin : begin + AGGREGATES]).collect():
            found[row["_fold"]] |= row.asDict()
    size = len(names)
    moments = []
    for i in range(k):
        own = found[i]
        if not own:
            moments.append(Moments(0, np.zeros(size), np.zeros((size, size))))
            continue
        central = np.zeros((size, size))
        for a, b in pairs:
            central[a, b] = central[b, a] = own[f"c{a}_{b}"]
        moments.append(Moments(own["n"], np.array([own[f"m{a}"] for a in range(size)]), central))
    return moments


def ridge(moments: Moments, features: Sequence[str], penalty: float = 0.0) -> Line:
    """The line of least mean squared error plus ``penalty`` times the squared coefficients.

    Where features depend on each other and nothing is penalised, the smallest coefficients are taken.
    """
    if moments.n == 0:
        raise ValueError("no row has a label and all features")
    p = len(features)
    system = moments.central[:p, :p] + penalty * np.eye(p)
    cross = moments.central[:p, p]
    solved = np.linalg.solve(system, cross) if penalty > 0 else np.linalg.lstsq(system, cross, rcond=1e-12)[0]
    intercept = float(moments.means[p] - solved @ moments.means[:p])
    return Line(tuple(features), tuple(float(w) for w in solved), intercept)


@dataclass(frozen=True)
class RidgeValidation:
    """For each penalty one line a fold, and the squared errors of each line on the other folds and on its own."""

    penalties: tuple[float, ...]
    lines: tuple[tuple[Line, ...], ...]
    train_error: tuple[tuple[float, ...], ...]
    valid_error: tuple[tuple[float | None, ...], ...]
    sizes: tuple[int, ...]

    def best(self) -> int:
        """The penalty with the least squared error over all validation rows; of equal ones the first."""
        def total(i: int) -> float:
            return sum(n * e for n, e in zip(self.sizes, self.valid_error[i], strict=True) if e is not None)

        return min(range(len(self.penalties)), key=lambda i: (total(i), i))

    def out_of_fold(self, df: DataFrame, fold: str, penalty: int | None = None, output: str = "prediction") -> DataFrame:
        """Every row's prediction by the line of its fold, without a join."""
        chosen = self.lines[self.best() if penalty is None else penalty]
        cases = F.lit(None).cast("double")
        for i, line in enumerate(chosen):
            cases = F.when(F.col(fold) == i, line.column()).otherwise(cases)
        return df.withColumn(output, cases)


def cross_validate_ridge(
    df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, penalties: Sequence[float] = (0.0,)
) -> RidgeValidation:
    """Fit and judge k lines for each penalty from a single pass over ``df``."""
    own = fold_moments(df, features, label, fold, k)
    others = [reduce(Moments.merged, [m for j, m in enumerate(own) if j != i]) for i in range(k)]
    lines = tuple(tuple(ridge(o, features, p) for o in others) for p in penalties)
    train = tuple(tuple(line.squared_error(o) for line, o in zip(row, others, strict=True)) for row in lines)
    valid = tuple(tuple(line.squared_error(m) for line, m in zip(row, own, strict=True)) for row in lines)
    return RidgeValidation(tuple(penalties), lines, train, valid, tuple(m.n for m in own))
