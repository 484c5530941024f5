"""Importance of features for any model: how much worse it gets when one feature is permuted.

Row positions 0 to n - 1 are permuted by a seeded bijection of their own for each feature, ``(a * position + b) mod n`` with
``a`` prime to n. Every row sends its value of each feature to the position it is permuted to, all in one shuffle, and
one further pass predicts every row as it is and with each feature replaced in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.operators.ordering import row_index
from residualkit.staging import stage

#: A model as a function: a frame with the feature columns and the name of a new column to the frame with that column.
Predict = Callable[[DataFrame, str], DataFrame]
MULTIPLIERS = 1 << 20
LOSSES = {"mae": F.abs, "mse": lambda e: e * e}


def bijection(n: int, seed: int, index: int) -> tuple[int, int]:
    """Factor and offset of a bijection on 0 to n - 1, from the md5 of seed and feature number.

    Factors are about ``MULTIPLIERS`` at most, so that products stay whole in 64 bits: the first one prime to ``n`` from the hash on.
    """
    digest = hashlib.md5(f"{seed}_{index}".encode()).hexdigest()
    factor = max(1, int(digest[:8], 16) % MULTIPLIERS)
    while gcd(factor, n) != 1:
        factor += 1
    return factor, int(digest[8:16], 16) % n


def permuted_features(df: DataFrame, features: Sequence[str], order: Sequence[str], seed: int) -> DataFrame:
    """``df`` with ``_position`` and, for the i-th feature, ``_permuted_i``: the value of another row, by bijection.

    ``order`` is a total order that gives the positions.
    """
    placed = stage(row_index(df, order, "_position"), "positions")
    n = placed.count()
    if n == 0:
        return placed.withColumns({f"_permuted_{i}": F.col(c) for i, c in enumerate(features)})
    sent = []
    for i, c in enumerate(features):
        factor, offset = bijection(n, seed, i)
        target = F.pmod(F.col("_position") * F.lit(factor) + F.lit(offset), F.lit(n))
        values = [(F.col(c) if j == i else F.lit(None).cast(df.schema[o].dataType)).alias(f"_permuted_{j}") for j, o in enumerate(features)]
        sent.append(F.struct(target.alias("_position"), *values))
    received = placed.select(F.inline(F.array(*sent))).groupBy("_position").agg(
        *[F.max(f"_permuted_{i}").alias(f"_permuted_{i}") for i in range(len(features))]
    )
    return placed.join(received, "_position")


def permutation_importance(
    df: DataFrame,
    predict: Predict,
    features: Sequence[str],
    label: str,
    order: Sequence[str],
    seed: int = 0,
    loss: str = "mae",
) -> DataFrame:
    """``feature, loss, permuted_loss, importance``: the mean loss as is, with the feature permuted, and the difference.

    Rows without a label or a prediction do not count. All features share one pass.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss {loss} is none of {sorted(LOSSES)}")
    frame = predict(permuted_features(df, features, order, seed), "_p")
    for i, c in enumerate(features):
        swapped = frame.withColumns({f"_own_{i}": F.col(c), c: F.col(f"_permuted_{i}")})
        frame = predict(swapped, f"_p_{i}").withColumn(c, F.col(f"_own_{i}")).drop(f"_own_{i}")
    whole = LOSSES[loss](F.col(label) - F.col("_p"))
    parts = [LOSSES[loss](F.col(label) - F.col(f"_p_{i}")) for i in range(len(features))]
    means = frame.agg(F.avg(whole).alias("_base"), *[F.avg(e).alias(f"_e{i}") for i, e in enumerate(parts)])
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col("_base").alias("loss"),
            F.col(f"_e{i}").alias("permuted_loss"),
            (F.col(f"_e{i}") - F.col("_base")).alias("importance"),
        )
        for i, c in enumerate(features)
    ]
    return means.select(F.inline(F.array(*rows)))
