"""Roll membership rows (entity, period, group) up to one row per entity and period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from valora.operators.order import OrderColumn, is_fixed_width, row_order, with_row_orders
from valora.operators.relational import known


@dataclass(frozen=True)
class WeightedMean:
    """``sum(value * weight) / sum(weight)``, null unless the weights sum above zero.

    The denominator counts rows whose value is missing. When every value is missing the
    result is null, or 0.0 with ``zero_if_all_null``.
    """

    value: str
    weight: str
    zero_if_all_null: bool = False

    def column(self) -> Column:
        weight = F.sum(self.weight)
        weighted = F.sum(F.col(self.value) * F.col(self.weight))
        if self.zero_if_all_null:
            weighted = F.coalesce(weighted, F.lit(0.0))
        return F.when(weight > 0, weighted / weight).alias(self.value)


def first_non_null(column: str, order: Column) -> Column:
    """First value that is not null in the given order; every column picks its own row."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), order)).alias(column)


def rollup(df: DataFrame, keys: Sequence[str], first: Sequence[str], sums: Sequence[str],
           means: Sequence[WeightedMean], order_cols: Sequence[OrderColumn],
           extra: Sequence[Column] = ()) -> DataFrame:
    """First values, null-aware sums and weighted means, combined map-side: a hot key costs one row per map task in the shuffle.

    Numbers and dates are one hash aggregate, as their buffers and the packed order are of fixed width. Texts are not: they are
    first combined by their values, each kind of row of a key with its least order, again in a hash table; what is left, a row
    per key unless its texts differ, is picked from. ``extra`` columns are aggregates of the rows.
    """
    rows = with_row_orders(df.transform(known, *keys), {"__order": order_cols})
    texts = [c for c in first if not is_fixed_width(df.schema[c].dataType)]
    if not is_fixed_width(rows.schema["__order"].dataType):
        texts = []  # sorted anyway
    rolled = rows.groupBy(*keys).agg(
        *[first_non_null(c, F.col("__order")) for c in first if c not in texts],
        *[F.sum(c).alias(c) for c in sums],
        *[m.column() for m in means],
        *extra,
    )
    if not texts:
        return rolled
    kinds = rows.groupBy(*keys, *texts).agg(F.min("__order").alias("__order"))
    named = kinds.groupBy(*keys).agg(*[first_non_null(c, F.col("__order")) for c in texts])
    added = [c for c in rolled.columns if c not in (*keys, *first)]
    return rolled.join(named, list(keys)).select(*keys, *first, *added)


def primary_member(df: DataFrame, columns: Sequence[str], weight: str, ties: Sequence[OrderColumn]) -> list[Column]:
    """The ``columns`` of the row with the largest weight; missing weights rank last. Each is an aggregate over one common order."""
    order = row_order(df, [F.isnull(weight), F.coalesce(-F.col(weight), F.lit(0).cast(df.schema[weight].dataType)), *ties])
    return [F.min_by(c, order).alias(c) for c in columns]


def group_mean(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))
