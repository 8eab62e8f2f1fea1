"""Selections, joins and de-duplication with explicit order and null rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from valora.operators.order import OrderColumn, is_fixed_width, with_row_orders


def columns_with(df: DataFrame, prefix: str | None = None, suffix: str | None = None,
                 exclude: Sequence[str] = ()) -> list[str]:
    """Names picked at plan time by prefix, suffix and exclusion, in frame order."""
    return [
        c for c in df.columns
        if c not in exclude
        and (prefix is None or c.startswith(prefix))
        and (suffix is None or c.endswith(suffix))
    ]


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a null in the columns. Plain null tests, unlike ``dropna``, reach the scan
    and are recognised when a join implies them, which keeps shared subplans equal."""
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])) if columns else df


def keep_other_than(df: DataFrame, column: str, value: str) -> DataFrame:
    """Case-insensitive inequality that keeps rows with a null value."""
    return df.filter(~F.lower(F.col(column)).eqNullSafe(F.lit(value.lower())))


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[OrderColumn],
                  columns: Sequence[str] | None = None) -> DataFrame:
    """First row per key in the given order. An aggregate, not a window: copies of a hot
    key are reduced before the shuffle, in a hash table where all columns kept are of fixed width."""
    rest = [c for c in (columns or df.columns) if c not in keys]
    rows = with_row_orders(df, {"__order": order_cols})
    if all(is_fixed_width(rows.schema[c].dataType) for c in [*rest, "__order"]):
        return rows.groupBy(*keys).agg(*[F.min_by(c, "__order").alias(c) for c in rest])
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), "__order").alias("kept")).select(*keys, "kept.*")


def first_kind_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[OrderColumn], columns: Sequence[str]) -> DataFrame:
    """``first_per_key`` for texts, numbers and dates that repeat in a key: each kind of row is first combined with its least order, in a hash
    table, and only kinds are sorted. Doubles are no kinds, as equal ones may differ in their sign."""
    rows = with_row_orders(df, {"__order": order_cols})
    if is_fixed_width(rows.schema["__order"].dataType) and not any(rows.schema[c].dataType.simpleString() in ("double", "float") for c in columns):
        rows = rows.groupBy(*keys, *columns).agg(F.min("__order").alias("__order"))
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*columns), "__order").alias("kept")).select(*keys, "kept.*")


def semi_filter(df: DataFrame, ids: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids``; ``on`` maps left to right names."""
    # Distinct ids: a key that fills the id table must not gather its rows in one task.
    right = ids.select(*[F.col(r).alias(f"__{l}") for l, r in on.items()]).distinct()
    condition = [F.col(l) == F.col(f"__{l}") for l in on]
    return df.join(right, condition, "left_semi")


def or_semi_filter(df: DataFrame, columns: Sequence[str], ids: DataFrame | Mapping[str, DataFrame],
                   id_column: str | None = None) -> DataFrame:
    """Rows where any of ``columns`` occurs in its id set, each row once.

    One equi-join per column against distinct ids; a disjunction inside a single
    semi-join would plan as a nested loop.
    """
    sets = ids if isinstance(ids, Mapping) else {c: ids for c in columns}
    marks = []
    out = df
    for i, c in enumerate(columns):
        mark = f"__hit{i}"
        source = sets[c]
        key = id_column or source.columns[0]
        distinct = source.select(F.col(key).alias(f"__id{i}")).distinct().withColumn(mark, F.lit(True))
        out = out.join(distinct, F.col(c) == F.col(f"__id{i}"), "left").drop(f"__id{i}")
        marks.append(mark)
    hit = F.coalesce(*[F.col(m) for m in marks]).isNotNull()
    return out.filter(hit).drop(*marks)


def left_join(df: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join where rows with a null key, which cannot match, stay out of the shuffle
    instead of gathering in one task. The key alone is joined on, so a side that is partitioned by it is not shuffled again."""
    added = [c for c in right.columns if c not in on]
    nullable = [c for c in on if df.schema[c].nullable]
    if not nullable:
        return df.join(right, list(on), "left").select(*df.columns, *added)
    matched = df.transform(known, *nullable).join(right, list(on), "left").select(*df.columns, *added)
    unknown = reduce(Column.__or__, [F.col(c).isNull() for c in nullable])
    return matched.unionByName(df.filter(unknown).select(*df.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in added]))


def spread_left_join(df: DataFrame, right: DataFrame, on: Sequence[str], row_key: Sequence[str]) -> DataFrame:
    """Left equi-join in one pass: rows with a null key, which cannot match, are dealt over all tasks by their ``row_key``."""
    unknown = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    # Zero for every row, but not a literal: the optimizer would fold that, and the join would not be dealt by it.
    side = right.withColumnsRenamed({c: f"__on_{c}" for c in on}).withColumn("__on", F.pmod(F.xxhash64(*[f"__on_{c}" for c in on]), F.lit(1).cast("long")))
    spread = F.when(unknown, F.xxhash64(*row_key)).otherwise(F.lit(0).cast("long"))
    condition = reduce(Column.__and__, [F.col(c) == F.col(f"__on_{c}") for c in on], spread == F.col("__on"))
    return df.join(side, condition, "left").select(*df.columns, *[c for c in right.columns if c not in on])


def attach(df: DataFrame, table: DataFrame, on: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a table with one row per key; null keys never match."""
    return left_join(df, table if columns is None else table.select(*on, *columns), on)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two aggregates of one frame on their group columns. A null group meets itself, and
    no null test is pushed into one side only, so both keep sharing the exchange below."""
    renamed = right.withColumnsRenamed({k: f"__join_{k}" for k in keys})
    condition = [F.col(k).eqNullSafe(F.col(f"__join_{k}")) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"__join_{k}" for k in keys])


def previous_period(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str],
                    suffix: str = "_prev") -> DataFrame:
    """Value of the directly preceding period by a shifted self join; a gap gives null.

    ``df`` holds one row per key and period, so no key can multiply rows.
    """
    before = df.select(
        *keys, (F.col(period) + 1).cast(df.schema[period].dataType).alias(period),
        *[F.col(c).alias(f"{c}{suffix}") for c in columns],
    )
    return df.join(before, [*keys, period], "left")


def period_delta(df: DataFrame, keys: Sequence[str], period: str, columns: Sequence[str]) -> DataFrame:
    joined = previous_period(df, keys, period, columns)
    deltas = [(F.col(c) - F.col(f"{c}_prev")).alias(f"delta_{c}") for c in columns]
    return joined.select(*df.columns, *deltas)


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def large_groups(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    """Rows of groups with at least ``minimum`` rows; group sizes come from one aggregate."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") >= minimum)
    return df.join(sizes.drop("__n"), list(keys), "left_semi")


def latest_split(df: DataFrame, period: str = "season") -> tuple[DataFrame, DataFrame]:
    """All earlier periods, and the latest one."""
    latest = df.agg(F.max(period)).scalar()
    return df.filter(F.col(period) < latest), df.filter(F.col(period) == latest)
