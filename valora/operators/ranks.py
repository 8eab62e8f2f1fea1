"""Exact ranks, quantiles and rank correlation without one-task windows.

A rank over a group that holds a large share of all rows must not sort the group in one
task. Values are first counted per (group, value), which collapses repeats before the
shuffle. Distinct values are then placed in buckets by a monotone function of the value: intervals between quantiles of
the group, inside them equal steps, and inside those steps of magnitude, so that neither narrow groups, nor values far from zero,
nor values over many orders of magnitude share a bucket. Bucket totals are prefix-summed per group (one row per bucket
and group, so without groups a single task sees at most the distinct buckets), and a second window ranks inside each
(group, bucket).

The quantiles come from a sketch per group, merged from partial ones. They need not be exact, as any increasing edges give the same
ranks, but every reader must see the same ones: they are stored, and so are the counts, from which they are made. Only groups with at least
one in ``_SHARES`` of all distinct values have edges of their own, which bounds their number; the values of any other group
are few enough for one task however they lie.

Infinities are the least and the greatest values, NaN is above them, nulls have no rank.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from valora.operators.relational import known
from valora.session import materialize

_STEPS_PER_OCTAVE = 2048
_OFFSET = 1100 * _STEPS_PER_OCTAVE  # above the magnitude of the smallest double exponent
_BEYOND = 4 * _OFFSET  # bucket of infinity
_LINEAR_STEPS = 2 ** 20
_SHARES = 2048  # at most as many groups have edges of their own: 4 MB of them
_INTERVALS = 256
_ACCURACY = 4096  # the sketch is wrong by this part of a group's values at most


def is_finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) < float("inf"))


def magnitude_bucket(x: Column) -> Column:
    """Monotone bucket number: logarithmic steps of 0.03 % on both sides of zero."""
    size = F.floor(F.log2(F.abs(x)) * _STEPS_PER_OCTAVE) + _OFFSET
    return F.when(F.isnan(x), F.lit(_BEYOND + 1).cast("long")).when(F.abs(x) == float("inf"), F.signum(x).cast("long") * _BEYOND) \
        .when(x == 0, F.lit(0).cast("long")).when(x > 0, size).otherwise(-size)


def linear_bucket(x: Column, low: Column, high: Column, steps: int | Column = _LINEAR_STEPS) -> Column:
    """Monotone bucket number: equal steps from ``low`` to ``high``; halves keep the difference of large bounds finite."""
    width = high / 2 - low / 2
    step = F.floor(F.when(width > 0, (x / 2 - low / 2) / width * steps).otherwise(0.0))
    return F.when(is_finite(x), F.coalesce(step, F.lit(0).cast("long"))) \
        .otherwise(F.when(F.isnan(x) | (x > 0), F.lit(_LINEAR_STEPS + 1)).otherwise(F.lit(-1)).cast("long"))


def interval_of(x: Column, edges: Column) -> Column:
    """Index of the last of the increasing ``edges`` not above ``x``, 0 if there is none; found by halving."""
    halves = F.array(*[F.lit(2 ** i) for i in range(_INTERVALS.bit_length() - 1, -1, -1)])
    return F.aggregate(halves, F.lit(0), lambda at, step: F.when(F.get(edges, at + step) <= x, at + step).otherwise(at))


def group_edges(counts: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``__edges`` of each group (named ``__g0`` …) that holds at least one in ``_SHARES`` of all distinct finite values: its least and
    greatest value and about ``_INTERVALS`` quantiles of its distinct values between them."""
    x = F.col(value)
    named = counts.filter(is_finite(x)).select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], x.alias("__v"))
    keys = [f"__g{i}" for i in range(len(groups))]
    sizes = named.groupBy(*keys).agg(F.count("*").alias("__size"))
    if groups:
        large = sizes.filter(F.col("__size") * _SHARES >= sizes.agg(F.sum("__size")).scalar())
        large = large.select(*[F.col(k).alias(f"{k}_") for k in keys])
        named = named.join(F.broadcast(large), [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], "left_semi")
    parts = [i / _INTERVALS for i in range(1, _INTERVALS)]
    inner = F.percentile_approx("__v", parts, _ACCURACY)
    edges = F.array_sort(F.array_distinct(F.concat(F.array(F.min("__v"), F.max("__v")), inner)))
    return named.groupBy(*keys).agg(edges.alias("__edges"))


def bucket_of(x: Column, edges: Column) -> Column:
    """Monotone bucket: interval between edges, equal step inside it, step of magnitude; at most ``_LINEAR_STEPS`` of the first two."""
    at = interval_of(x, edges)
    low, high = F.get(edges, at), F.coalesce(F.get(edges, at + 1), F.get(edges, at))
    step = linear_bucket(x, low, high, F.floor(F.lit(_LINEAR_STEPS) / F.size(edges)))
    return F.struct(at.alias("interval"), step.alias("step"), magnitude_bucket(x).alias("size"))


def bucketed_counts(counts: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Stored (group, value) counts with their bucket as ``__b``; a job stores the edges of groups."""
    edges = materialize(group_edges(counts, groups, value), "edges")
    x = F.col(value)
    if groups:
        finite = counts.filter(is_finite(x))
        whole = F.array(finite.agg(F.min(value)).scalar(), finite.agg(F.max(value)).scalar())
        same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
        # At most _SHARES rows of _INTERVALS + 1 numbers.
        counts_with = counts.join(F.broadcast(edges), same, "left").withColumn("__edges", F.coalesce("__edges", whole))
    else:
        counts_with = counts.withColumn("__edges", edges.select("__edges").scalar())
    return counts_with.withColumn("__b", bucket_of(x, F.col("__edges"))).select(*counts.columns, "__b")


def value_positions(counts: DataFrame, groups: Sequence[str], value: str, n: str = "n",
                    buckets: Column | None = None) -> DataFrame:
    """Add ``below`` (rows with a smaller value in the group) and ``total`` to a stored table of
    distinct (group, value) counts.

    ``buckets`` restricts the result to buckets that fulfil a condition on ``base`` (rows in
    lower buckets), ``inside`` (rows in the bucket) and ``total``.
    """
    bucketed = bucketed_counts(counts, groups, value)
    per_bucket = bucketed.groupBy(*groups, "__b").agg(F.sum(n).alias("__m"))
    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    running = by_group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(g).alias(f"__k{i}") for i, g in enumerate(groups)], F.col("__b").alias("__kb"),
        F.coalesce(F.sum("__m").over(running), F.lit(0)).alias("base"), F.col("__m").alias("inside"),
        F.sum("__m").over(by_group).alias("total"),
    )
    if buckets is not None:
        offsets = offsets.filter(buckets)
    # Null-safe equality holds for a null group, and implies no null test on the bucket: the
    # optimizer would push one into one reader of the counts, which then could not share
    # its exchange with the others.
    condition = [F.col("__b").eqNullSafe(F.col("__kb"))]
    condition += [F.col(g).eqNullSafe(F.col(f"__k{i}")) for i, g in enumerate(groups)]
    inside = Window.partitionBy(*groups, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.join(offsets, condition).withColumn(
        "below", F.col("base") + F.coalesce(F.sum(n).over(inside), F.lit(0)))
    return placed.select(*groups, value, n, "below", "total")


def average_rank() -> Column:
    """Rank of a value with ties sharing their mean rank, from ``below`` and ``n``."""
    return F.col("below") + (F.col("n") + 1) / 2


def value_counts(df: DataFrame, groups: Sequence[str], value: str, alias: str = "__x") -> DataFrame:
    """Rows per (group, value) as ``n``, stored; null values are left out."""
    counts = df.select(*groups, F.col(value).cast("double").alias(alias)).transform(known, alias) \
        .groupBy(*groups, alias).agg(F.count("*").alias("n"))
    return materialize(counts, "value-counts")


def pct_rank(df: DataFrame, groups: Sequence[str], columns: Sequence[str] | Mapping[str, str], keys: Sequence[str] | None = None) -> DataFrame:
    """Add average-tie percentile ranks within ``groups``; null values and groups stay null.

    Values are looked up by group and value, so a row and its rank must not disagree in the last bit: store ``df`` first when its values are
    floating-point sums that may change when they are computed again.

    With ``keys`` that name each row, all columns are ranked in one pass over narrow rows (keys, groups, column, value), whose ranks
    come back to the rows in one join by key: the wide rows are shuffled once, by a key without skew. Without, they are joined once per column, by value.
    """
    outputs = dict(columns) if isinstance(columns, Mapping) else {c: f"{c}_pct" for c in columns}
    if keys is not None:
        return df.join(_melted_ranks(df, groups, outputs, keys), list(keys), "left").select(*df.columns, *outputs.values())
    out = df
    for source, target in outputs.items():
        counts = value_counts(df.transform(known, *groups), groups, source)
        ranks = value_positions(counts, groups, "__x").select(
            *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], "__x",
            (average_rank() / F.col("total")).alias(target))
        condition = [F.col(source).cast("double") == F.col("__x")]
        condition += [F.col(g) == F.col(f"__g{i}") for i, g in enumerate(groups)]
        out = out.join(ranks, condition, "left").drop("__x", *[f"__g{i}" for i in range(len(groups))])
    return out


def _melted_ranks(df: DataFrame, groups: Sequence[str], outputs: Mapping[str, str], keys: Sequence[str]) -> DataFrame:
    """The keys and one column of ranks per output: rows melted to one value each, ranked per column and group, and turned back."""
    sources = list(outputs)
    values = F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("double").alias("__x")) for i, c in enumerate(sources)])
    long = df.transform(known, *keys, *groups).select(*keys, *groups, F.explode(values).alias("__v")).select(*keys, *groups, "__v.__c", "__v.__x").transform(known, "__x")
    by = [*groups, "__c"]
    ranks = value_positions(value_counts(long, by, "__x"), by, "__x") \
        .select(*[F.col(g).alias(f"__k{i}") for i, g in enumerate(by)], F.col("__x").alias("__kx"), (average_rank() / F.col("total")).alias("__rank"))
    condition = [F.col("__x") == F.col("__kx"), *(F.col(g) == F.col(f"__k{i}") for i, g in enumerate(by))]
    return long.join(ranks, condition).groupBy(*keys).agg(*[F.max(F.when(F.col("__c") == i, F.col("__rank"))).alias(outputs[c]) for i, c in enumerate(sources)])


def quantiles_of_counts(counts: DataFrame, groups: Sequence[str], parts: Sequence[float], alias: str = "quantile", part: str = "p",
                        value: str = "__x") -> DataFrame:
    """Exact interpolated quantiles per group from (group, value) counts, a row per group and one of ``parts``: the values are placed once for all of them."""
    at = [(F.col("total") - 1) * F.lit(float(q)) for q in parts]

    def covers(position: Column, start: str = "below", size: str = "n") -> Column:
        return (F.col(start) <= position) & (position < F.col(start) + F.col(size))

    # Only the one or two buckets around each position need ranks of single values.
    near = reduce(or_, [covers(edge(x), "base", "inside") for x in at for edge in (F.floor, F.ceil)])
    placed = value_positions(counts, groups, value, buckets=near)
    picked = placed.filter(reduce(or_, [covers(edge(x)) for x in at for edge in (F.floor, F.ceil)])).groupBy(*groups).agg(F.array(*[
        F.struct(F.lit(float(q)).alias("q"), F.max(F.when(covers(F.floor(x)), F.col(value))).alias("lo"),
                 F.max(F.when(covers(F.ceil(x)), F.col(value))).alias("hi"), F.max(x - F.floor(x)).alias("over"))
        for q, x in zip(parts, at)]).alias("__all"))
    each = picked.select(*groups, F.explode("__all").alias("__one"))
    low, high, over = (F.col(f"__one.{c}") for c in ("lo", "hi", "over"))
    return each.select(*groups, (low + (high - low) * over).alias(alias), F.col("__one.q").alias(part))


def quantile_of_counts(counts: DataFrame, groups: Sequence[str], q: float = 0.5, alias: str = "median",
                       value: str = "__x") -> DataFrame:
    return quantiles_of_counts(counts, groups, [q], alias, "__p", value).drop("__p")


def exact_quantile(df: DataFrame, groups: Sequence[str], value: str, q: float = 0.5,
                   alias: str = "median") -> DataFrame:
    return quantile_of_counts(value_counts(df, groups, value), groups, q, alias)


def value_pairs(df: DataFrame, groups: Sequence[str], a: str, b: str) -> DataFrame:
    """Rows per (group, a, b) as ``first, second, w``; pairs with a null are left out."""
    pairs = df.select(*groups, F.col(a).cast("double").alias("first"), F.col(b).cast("double").alias("second"))
    return pairs.transform(known, "first", "second").groupBy(*groups, "first", "second").agg(F.count("*").alias("w"))


def spearman_of_pairs(pairs: DataFrame, groups: Sequence[str], alias: str = "spearman") -> DataFrame:
    def scaled_ranks(column: str, name: str) -> DataFrame:
        counts = materialize(pairs.groupBy(*groups, column).agg(F.sum("w").alias("n")), "value-counts")
        # Centred and scaled to [-1/2, 1/2]: sums of squares keep their precision.
        centred = (average_rank() - (F.col("total") + 1) / 2) / F.col("total")
        return value_positions(counts, groups, column).select(
            *[F.col(g).alias(f"__{name}{i}") for i, g in enumerate(groups)],
            F.col(column).alias(f"__{name}x"), centred.alias(name))

    ranked = pairs
    for column, name in (("first", "ra"), ("second", "rb")):
        condition = [F.col(column) == F.col(f"__{name}x")]
        condition += [F.col(g).eqNullSafe(F.col(f"__{name}{i}")) for i, g in enumerate(groups)]
        ranked = ranked.join(scaled_ranks(column, name), condition)
    w, ra, rb = F.col("w"), F.col("ra"), F.col("rb")
    sums = ranked.groupBy(*groups).agg(
        F.sum(w * ra * rb).alias("ab"), F.sum(w * ra * ra).alias("aa"), F.sum(w * rb * rb).alias("bb"))
    score = F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.col("ab") / F.sqrt(F.col("aa") * F.col("bb")))
    return sums.select(*groups, score.alias(alias))


def spearman(df: DataFrame, groups: Sequence[str], a: str, b: str, alias: str = "spearman") -> DataFrame:
    """Rank correlation per group, ties averaged; null where a side is constant."""
    return spearman_of_pairs(materialize(value_pairs(df, groups, a, b), "pairs"), groups, alias)
