"""What was known about an entity from its earlier transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import require
from residualkit.functions.scalars import flag
from residualkit.operators.as_of import asof_rows
from residualkit.operators.lookup import HEAVY_SHARE, keyed_join
from residualkit.operators.ordering import number_and_previous
from residualkit.staging import stage


def sale_history(
    sales: DataFrame,
    key: str,
    order: Sequence[str],
    period: str = "month_block",
    target: str = "logerror",
    number: str | None = None,
) -> DataFrame:
    """Add the previous sale's period and target, the gap to it, and a history flag.

    The flag says that the previous *target* is present. ``number`` names an
    optional column with the 1-based position of the sale among those of its key.
    """
    numbered = number_and_previous(
        sales, key, order, {"prev_month": period, "prev_logerror": target}, number or "_number"
    )
    result = numbered.withColumns(
        {
            "month_interval": F.col(period) - F.col("prev_month"),
            "has_history": flag("prev_logerror"),
        }
    )
    return result if number else result.drop("_number")


def last_sales(
    sales: DataFrame,
    key: str,
    horizons: Sequence[int],
    order: Sequence[str],
    period: str = "month_block",
    target: str = "logerror",
) -> DataFrame:
    """Per key, the last sale strictly before each horizon, as columns ``_h<horizon>``.

    One aggregation answers all horizons. It is combined before the shuffle, so
    a key with very many sales sends one row per input partition. Order columns that fit into
    one number (see :func:`packed_order`) make it a hash aggregation; others
    are compared as a struct, for which Spark sorts by key.
    """
    require(sales, order, "an order is needed because rows have none of their own")
    sale = {"prev_month": F.col(period), "prev_logerror": F.col(target)}
    packed = packed_order(sales, order)
    known = []
    for h in horizons:
        early = F.col(period) < h
        if packed is not None:
            place = F.when(early, packed)
            last = F.struct(*[F.max_by(value, place).alias(name) for name, value in sale.items()])
        else:
            place = F.when(early, F.struct(*[F.col(c) for c in order]))
            last = F.max_by(F.struct(*[value.alias(name) for name, value in sale.items()]), place)
        known.append(last.alias(f"_h{h}"))
    early = sales.filter(F.col(period) < max(horizons))
    return early.groupBy(key).agg(*known)


# Decimal digits that the values of a type take, and the smallest of them.
_WHOLE = {"tinyint": (3, -(2**7)), "smallint": (5, -(2**15)), "int": (10, -(2**31)), "bigint": (20, -(2**63)), "date": (10, -(2**31))}


def packed_order(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One number that orders rows as the given columns do, missing values first; None if they do not fit.

    Whole numbers and dates fit, up to the 38 digits of a decimal: a date and a long, for example. A decimal can be
    updated in place by a hash aggregation, a struct cannot.
    """
    kinds = dict(df.dtypes)
    if len(order) == 1:
        return F.col(order[0])
    if any(kinds[c] not in _WHOLE for c in order) or sum(_WHOLE[kinds[c]][0] for c in order) > 37:
        return None
    total, digits = None, 0
    for c in reversed(order):
        width, least = _WHOLE[kinds[c]]
        whole = F.unix_date(c) if kinds[c] == "date" else F.col(c)
        shifted = whole.cast(f"decimal({width}, 0)") - F.lit(str(least - 1)).cast("decimal(20, 0)")
        part = F.coalesce(shifted, F.lit(0).cast("decimal(21, 0)")).cast(f"decimal({width}, 0)")
        part = part if digits == 0 else part * F.lit(str(10**digits)).cast(f"decimal({digits + 1}, 0)")
        total = part if total is None else total + part
        digits += width
    return total


def _history_struct(horizon: int) -> list[Column]:
    sale = F.col(f"_h{horizon}")
    return [
        sale["prev_month"].alias("prev_month"),
        sale["prev_logerror"].alias("prev_logerror"),
        (F.lit(horizon) - sale["prev_month"]).alias("month_interval"),
        flag(sale["prev_logerror"]).alias("has_history"),
    ]


def asof_history(
    keys: DataFrame,
    sales: DataFrame,
    key: str,
    horizons: Sequence[int],
    order: Sequence[str],
    period: str = "month_block",
    target: str = "logerror",
) -> DataFrame:
    """One row per key and horizon with the last sale strictly before the horizon."""
    known = keys.join(last_sales(sales, key, horizons, order, period, target), key, "left")
    rows = [F.struct(F.lit(h).alias("horizon"), *_history_struct(h)) for h in horizons]
    return known.select(*keys.columns, F.inline(F.array(*rows)))


def asof_history_wide(
    keys: DataFrame,
    sales: DataFrame,
    key: str,
    horizons: dict[int, dict[int, int]],
    order: Sequence[str],
    year_name: str,
    period: str = "month_block",
    target: str = "logerror",
) -> DataFrame:
    """One row per key and year with history columns suffixed by month.

    ``horizons`` maps a year to its months and their period numbers, for example
    ``{2016: {10: 10, 11: 11}, 2017: {10: 22, 11: 23}}``. Years have the same months.
    """
    every = sorted({h for months in horizons.values() for h in months.values()})
    known = keys.join(last_sales(sales, key, every, order, period, target), key, "left")
    rows = []
    for year, months in horizons.items():
        columns = [F.lit(year).alias(year_name)]
        for month, horizon in months.items():
            names = ("prev_month", "prev_logerror", "month_interval", "has_history")
            columns += [c.alias(f"{n}_{month}") for n, c in zip(names, _history_struct(horizon), strict=True)]
        rows.append(F.struct(*columns))
    return known.select(*keys.columns, F.inline(F.array(*rows)))


def repeat_sale_pairs(sales: DataFrame, key: str, order: Sequence[str], target: str = "logerror") -> DataFrame:
    """Keys with more than one present target: the first present one and that of the second sale.

    The first skips missing targets; the second is whatever the second row holds.
    """
    numbered = number_and_previous(sales.select(key, *order, target), key, order, {"_before": target}, "_number")
    place = F.struct(*[F.col(c) for c in order])
    seen = F.when(F.col(target).isNotNull(), place)
    return (
        numbered.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(target).alias("user_history"),
            F.min_by(target, seen).alias("logerror_first"),
            F.max(F.when(F.col("_number") == 2, F.col(target))).alias("logerror_second"),
        )
        .filter(F.col("user_history") > 1)
    )


def sales_of_repeat_keys(sales: DataFrame, key: str, target: str = "logerror") -> DataFrame:
    """The sales of keys that have more than one present target."""
    counted = stage(sales.groupBy(key).agg(F.count(target).alias("_present"), F.count(F.lit(1)).alias("_rows")), "key_counts")
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    bar = max(2, -(-total // HEAVY_SHARE))
    heavy = counted.filter(F.col("_rows") >= bar).select(key).collect()
    repeated = counted.filter((F.col("_present") > 1) & F.col(key).isNotNull()).select(key, "_present")
    return keyed_join(sales, repeated, [key], heavy=heavy).filter(F.col("_present").isNotNull()).drop("_present")


def keep_spaced(
    sales: DataFrame,
    key: str,
    date: str,
    order: Sequence[str],
    days: int = 31,
    reasonable: Column | None = None,
    max_rounds: int = 64,
) -> DataFrame:
    """Keep the first sale of each key, and then each next one more than ``days`` days after the last one kept.

    Unlike :func:`drop_close_repeats`, a sale that was dropped does not count: of sales on days 0, 20, 40 and 60 those on
    days 0 and 40 are kept. ``order`` must be a total order that begins with ``date``. Rows without a key or a date are
    all kept. ``reasonable`` is an optional predicate; sales that fail it are set aside first.

    A sale more than ``days`` days after the row before it is kept whatever came earlier, so
    only runs of close sales need a search. In them, every sale points to the first one far enough after it: an as-of search by date
    gives the position. From the first of each run the kept ones are those reached along the pointers, found by
    doubling: with each written round pointers reach twice as far, so rounds grow with the logarithm of the longest run.
    """
    if not order or order[0] != date:
        raise ValueError(f"the order must begin with {date}")
    chosen = sales if reasonable is None else sales.filter(reasonable)
    usable = F.col(key).isNotNull() & F.col(date).isNotNull()
    own = [f"_c{i}" for i in range(len(chosen.columns))]
    renamed = {c: n for c, n in zip(chosen.columns, own, strict=True)}
    numbered = number_and_previous(chosen.filter(usable), key, order, {"_previous": date}, "_number")
    gap = F.datediff(F.col(date), F.col("_previous"))
    placed = stage(numbered.withColumn("_head", gap.isNull() | (gap > days)), "numbered_sales")

    narrow = placed.select(F.col(key).alias("_key"), "_number", F.col(date).cast("date").alias("_date"), "_head")
    # A head followed by a head is a run of one, and needs no pointer.
    pointing = stage(_with_next_head(narrow), "run_members").filter("not _head or not _next_head")
    reach = pointing.select("_key", "_number", F.date_add("_date", days).alias("_until"), "_head")
    found = asof_rows(reach, narrow, "_key", "_until", "_date", {"_last": "_number"}, ["_number"], inclusive=True)
    links = found.select("_key", "_number", (F.col("_last") + 1).alias("_to"), "_head")
    # A pointer to a head, or past the last sale, reaches nothing that is not kept anyway.
    inner = narrow.filter(~F.col("_head")).select("_key", F.col("_number").alias("_to"))
    pointers = stage(links.join(inner, ["_key", "_to"], "left_semi").select("_key", "_number", "_to", "_head"), "pointers")
    reached = stage(pointers.filter("_head").select("_key", "_number"), "reached")
    pointers = pointers.drop("_head")
    for _ in range(max_rounds):
        if not pointers.head(1):
            break
        ahead = reached.join(pointers, ["_key", "_number"]).select("_key", F.col("_to").alias("_number"))
        reached = stage(reached.unionByName(ahead).distinct(), "reached")
        second = pointers.select("_key", F.col("_number").alias("_to"), F.col("_to").alias("_then"))
        pointers = stage(pointers.join(second, ["_key", "_to"]).select("_key", "_number", F.col("_then").alias("_to")), "pointers")
    else:
        raise RuntimeError(f"a run of close sales did not end in {max_rounds} rounds")

    more = reached.withColumnsRenamed({"_key": "_r_key", "_number": "_r_number"})
    heads = placed.filter("_head")
    others = placed.filter(~F.col("_head")).withColumnsRenamed(renamed)
    same = (F.col(renamed[key]) == F.col("_r_key")) & (F.col("_number") == F.col("_r_number"))
    others = others.join(more, same, "left_semi")
    back = [F.col(n).alias(c) for c, n in renamed.items()]
    kept = heads.select(*chosen.columns).unionByName(others.select(*back))
    return kept.unionByName(chosen.filter(~F.coalesce(usable, F.lit(False))))


def _with_next_head(numbered: DataFrame) -> DataFrame:
    """Whether the sale after this one is the first of a run; the last sale of a key counts as followed by one.

    Found by a join on the position, so that a key with very many sales is spread over all tasks.
    """
    following = numbered.select("_key", (F.col("_number") - 1).alias("_number"), F.col("_head").alias("_next_head"))
    return numbered.join(following, ["_key", "_number"], "left").fillna(True, ["_next_head"])


def drop_close_repeats(
    sales: DataFrame,
    key: str,
    date: str,
    order: Sequence[str],
    days: int = 31,
    reasonable: Column | None = None,
) -> DataFrame:
    """Drop a sale that follows the previous sale of its key within ``days`` days.

    The previous sale is the row before, whether or not it was dropped itself:
    of sales on days 0, 20, 40 and 60 only the first is kept.

    ``reasonable`` is an optional predicate; sales that fail it are set aside first.
    """
    kept = sales if reasonable is None else sales.filter(reasonable)
    numbered = number_and_previous(kept, key, order, {"_previous_date": date}, "_number")
    gap = F.datediff(F.col(date), F.col("_previous_date"))
    return numbered.filter(gap.isNull() | (gap > days)).drop("_previous_date", "_number")
