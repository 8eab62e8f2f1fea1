"""Descriptive aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F


from valora.operators import ranks
from valora.operators.relational import join_groups, known


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; null is not counted."""
    return df.transform(known, column).groupBy(column).agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), column)


def group_stats(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Exact median, mean and maximum per group."""
    # All three come from the (group, value) counts, so the rows are read and shuffled once.
    counts = ranks.value_counts(df, groups, value)
    n, x = F.col("n"), F.col("__x")
    basic = counts.groupBy(*groups).agg((F.sum(x * n) / F.sum("n")).alias("mean"), F.max(x).alias("max"))
    median = ranks.quantile_of_counts(counts, groups)
    if not groups:
        return basic.withColumn("median", median.scalar()).select("median", "mean", "max")
    return join_groups(basic, median, groups).select(*groups, "median", "mean", "max")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs in long form, pairwise without nulls.

    One pass over the data: every pair is an aggregate of the same job.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"c{i}").alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin number from 1; the last bin is closed on the right."""
    width = (high - low) / bins
    number = F.floor((value - low) / F.nullif(width, F.lit(0.0))) + 1
    return F.greatest(F.lit(1), F.least(F.lit(bins), F.coalesce(number, F.lit(1)))).cast("int")


def histogram(df: DataFrame, value: str, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """Counts of equal-width bins between minimum and maximum, per group if asked."""
    present = df.transform(known, value, *groups).select(*groups, F.col(value).cast("double").alias("__v"))
    # Counted per value before anything is shuffled by group.
    present = present.groupBy(*groups, "__v").agg(F.count("*").alias("__n"))
    if groups:
        bounds = present.groupBy(*groups).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        ranged = present.join(bounds, list(groups))
    else:
        ranged = present.withColumns({"__lo": present.agg(F.min("__v")).scalar(),
                                    "__hi": present.agg(F.max("__v")).scalar()})
    binned = bin_of(F.col("__v"), F.col("__lo"), F.col("__hi"), bins)
    return ranged.groupBy(*groups, binned.alias("bin")).agg(
        F.sum("__n").alias("n"),
        F.min(F.col("__lo") + (F.col("__hi") - F.col("__lo")) / bins * (binned - 1)).alias("bin_start"))


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str], lg_k: int = 14) -> DataFrame:
    """One sketch of the distinct values per key and column, of ``2 ** lg_k`` bytes at most however many rows there are.

    Nulls are no value. Sketches of equal ``lg_k`` can be stored and merged later, so that a new season is counted without reading the others.
    """
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(c) for c in columns])


def merged_distinct(sketches: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values of stored sketches per group: one standard error is about ``0.9 / 2 ** (lg_k / 2)`` of the count."""
    return sketches.groupBy(*groups).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"{c}_count") for c in columns])
