"""Category repair and coding, learned on one frame and applied to others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residualkit.functions.names import grouping_mark
from residualkit.functions.scalars import text_or_nan
from residualkit.operators.lookup import broadcast_limit, lookup_chain, set_sizes
from residualkit.operators.ordering import row_index
from residualkit.operators.snapshots import union_by_name
from residualkit.staging import size_columns, size_of, stage_measured


@dataclass(frozen=True)
class RareCategories:
    """Per column: a staged list of rare values, a bound on its bytes, and the value that stands for them all."""

    tables: Mapping[str, DataFrame]
    sizes: Mapping[str, int]
    replacements: Mapping[str, object]

    def apply(self, df: DataFrame, twins: Mapping[str, str] | None = None) -> DataFrame:
        """Collapse the rare values. ``twins`` names further columns, each with the
        fitted column whose list it uses."""
        sources = {c: s for c, s in {**{c: c for c in self.tables}, **(twins or {})}.items() if s in self.tables}
        tables = [
            (self.tables[s].withColumnRenamed(s, c).withColumn(f"_rare_{i}", F.lit(True)), [c], False)
            for i, (c, s) in enumerate(sources.items())
        ]
        joined = lookup_chain(df, tables, [self.sizes[s] for s in sources.values()])
        values = {
            c: F.when(F.col(f"_rare_{i}"), F.lit(self.replacements[s]).cast(df.schema[c].dataType)).otherwise(F.col(c))
            for i, (c, s) in enumerate(sources.items())
        }
        return joined.withColumns(values).select(*[f"`{c}`" for c in df.columns]) if values else df


def fit_rare(df: DataFrame, columns: Sequence[str], threshold: int = 100) -> RareCategories:
    """Find values with fewer than ``threshold`` rows; the smallest of them replaces all.

    All columns are counted in one pass with grouping sets. Missing values form
    no category. A column without rare values is left alone.
    """
    sets = [[F.col(c)] for c in columns]
    counted = (
        df.groupingSets(sets, *[F.col(c) for c in columns])
        .agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") < threshold)
    )
    rare, size = stage_measured(counted, "rare", partition_by="_set")
    marks = {c: grouping_mark(columns, [c]) for c in columns}
    lows = rare.agg(*[F.min(F.when(F.col("_set") == marks[c], F.col(c))).alias(c) for c in columns]).first()
    replacements = {c: lows[c] for c in columns if lows[c] is not None}
    tables = {
        c: rare.filter((F.col("_set") == marks[c]) & F.col(c).isNotNull()).select(c) for c in replacements
    }
    # One list too large to broadcast does not send the others through a shuffle.
    measured = set_sizes(rare) if size > broadcast_limit(df.sparkSession) else {}
    sizes = {c: measured.get(marks[c], 0) if measured else size for c in replacements}
    return RareCategories(tables, sizes, replacements)


@dataclass(frozen=True)
class LabelCodes:
    """Per column: a staged table from text to its rank in sorted order, and its bytes."""

    tables: Mapping[str, DataFrame]
    sizes: Mapping[str, int]

    def apply(self, df: DataFrame, unseen: str = "error") -> DataFrame:
        """Replace text by codes. A value that was not learned is an error at run
        time, or NULL with ``unseen="null"``."""
        if unseen not in ("error", "null"):
            raise ValueError(f"unseen must be error or null, not {unseen}")
        if not self.tables:
            return df
        keyed = df.withColumns({f"_text_{i}": text_or_nan(c) for i, c in enumerate(self.tables)})
        tables = [
            (table.withColumnsRenamed({"_text": f"_text_{i}", "_code": f"_code_{i}"}), [f"_text_{i}"], False)
            for i, table in enumerate(self.tables.values())
        ]
        joined = lookup_chain(keyed, tables, [self.sizes[c] for c in self.tables])
        codes = {}
        for i, column in enumerate(self.tables):
            codes[column] = F.col(f"_code_{i}")
            if unseen == "error":
                message = F.concat(F.lit(f"unseen value in {column}: "), F.col(f"_text_{i}"))
                codes[column] = F.coalesce(codes[column], F.raise_error(message).cast("int"))
        return joined.withColumns(codes).select(*[f"`{c}`" for c in df.columns])


def fit_labels(frames: Sequence[DataFrame], columns: Sequence[str]) -> LabelCodes:
    """Learn sorted codes over the values of all frames together, missing as ``nan``.

    All columns are read in one pass. Codes come from a range-partitioned index
    over the distinct values, so their number is not limited by one task.
    """
    if not columns:
        return LabelCodes({}, {})
    pairs = [F.struct(F.lit(c).alias("_column"), text_or_nan(c).alias("_text")) for c in columns]
    values = union_by_name([frame.select(F.inline(F.array(*pairs))) for frame in frames]).distinct()
    ranked = row_index(values, ["_column", "_text"], "_index")
    measured = ranked.groupBy("_column").agg(F.min("_index").alias("_first"), *size_columns(ranked.schema)).collect()
    firsts = {r["_column"]: r["_first"] for r in measured}
    sizes = {r["_column"]: size_of(list(r)[2:], len(ranked.columns)) for r in measured}
    tables = {
        c: ranked.filter(F.col("_column") == c).select(
            "_text", (F.col("_index") - firsts[c]).cast("int").alias("_code")
        )
        for c in columns
        if c in firsts
    }
    return LabelCodes(tables, sizes)
