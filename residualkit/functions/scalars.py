"""Column expressions. All are built-in Spark expressions; none is a UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_error(estimate: Column | str, price: Column | str) -> Column:
    """The residual target: ``ln(estimate) - ln(price)``, NULL unless both are positive."""
    return F.ln(_column(estimate)) - F.ln(_column(price))


def month_block(date: Column | str, base_year: int) -> Column:
    """Months counted from January of ``base_year``, which is month 1."""
    d = _column(date)
    return ((F.year(d) - F.lit(base_year)) * 12 + F.month(d)).cast("int")


def calendar_columns(date: Column | str, base_year: int) -> dict[str, Column]:
    d = _column(date)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "month_block": month_block(d, base_year),
    }


def log_offset(c: Column | str, offset: float = 0.1) -> Column:
    """``ln(c + offset)``; NULL where the sum is not positive."""
    return F.ln(_column(c).cast("double") + F.lit(float(offset)))


def winsorize(c: Column | str, low: float = -1.0, high: float = 1.0) -> Column:
    """Clip to ``[low, high]``. The guard keeps NULL, which ``least`` would skip."""
    x = _column(c)
    clipped = F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))
    return F.when(x.isNotNull(), clipped)


def inside(c: Column | str, bound: float) -> Column:
    """Whether the magnitude is at most ``bound``; the predicate of :func:`trim`."""
    return F.abs(_column(c)) <= F.lit(float(bound))


def round_half_even(c: Column | str, digits: int = 4) -> Column:
    return F.bround(_column(c), digits)


def flag(c: Column | str) -> Column:
    """1 where the value is present, else 0."""
    return _column(c).isNotNull().cast("int")


def nan_to_null(c: Column | str) -> Column:
    x = _column(c)
    return F.when(~F.isnan(x), x)


def text_or_nan(c: Column | str) -> Column:
    """Text form in which a missing value is the category ``nan``."""
    return F.coalesce(_column(c).cast("string"), F.lit("nan"))


def composite_text(*parts: Column | str) -> Column:
    """Readable text of a composite key. Joins and groupings use the tuple itself,
    because the text of two different tuples can coincide."""
    joined = F.concat_ws("_", *[text_or_nan(p) for p in parts])
    return F.btrim(joined, F.lit("_"))


def balanced_sum(terms: list[Column]) -> Column:
    """Sum as a balanced tree, so that hundreds of terms stay a shallow expression."""
    while len(terms) > 2:
        terms = [reduce(lambda a, b: a + b, terms[i : i + 2]) for i in range(0, len(terms), 2)]
    return reduce(lambda a, b: a + b, terms)


def null_count(columns: list[str]) -> Column:
    """How many of the named columns are NULL in this row."""
    if not columns:
        return F.lit(0)
    groups = [columns[i : i + 32] for i in range(0, len(columns), 32)]
    sums = ["(" + " + ".join(f"int(`{c}` is null)" for c in group) + ")" for group in groups]
    return F.expr(" + ".join(sums))


def hash_bucket(key: Column | str, buckets: int, seed: int) -> Column:
    """A bucket from the first eight hex digits of ``md5(key_seed)``.

    A function of the key alone: no shuffle, and the same on every run and in
    every engine that has md5.
    """
    digest = F.md5(F.concat(_column(key).cast("string"), F.lit(f"_{seed}")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return (number % F.lit(buckets)).cast("int")


def hash_order(key: Column | str, seed: int) -> Column:
    """A pseudo-random sort key: the whole ``md5(key_seed)`` text."""
    return F.md5(F.concat(_column(key).cast("string"), F.lit(f"_{seed}")))
