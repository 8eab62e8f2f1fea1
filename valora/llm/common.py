"""Helpers shared by the operators: words, row keys, checked broadcasts, ragged arrays, connected components."""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from valora.session import materialize, scratch_tables

# The contracts' word patterns, in Java's notation.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """A null text is an empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of one byte per character may take the quick built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)) \
        .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words_of(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text: two 64-bit hashes of different seeds."""
    return [F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2")]


def broadcast_if_small(df: DataFrame, most: int) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``most`` rows, counted here; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def digest64(data: bytes) -> int:
    """A hash that is equal in every process."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


class Memo(dict):
    """Values of a function by key, for repeated words; emptied when it holds ``most`` of them, so memory stays bounded."""

    def __init__(self, function, most: int = 300_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[s:s+n] of all (s, n), one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[index]


def slices(batches, rows: int = 500):
    """The record batches in slices of few rows, so that a task's memory does not grow with Arrow's batches."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def text_slices(batches, column: int | str, most: int = 2_000_000, rows: int = 500):
    """The record batches in slices whose texts sum up to about ``most`` bytes, so that long texts do not gather either; a longer one stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for begin, end in chunks(sizes, most):
            for at in range(begin, end, rows):
                yield batch.slice(at, min(rows, end - at))


def chunks(sizes: list[int], most: int):
    """Ranges of consecutive rows whose sizes sum up to about ``most``; a larger row stands alone."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with their place ``name``, from 0, in the ``order`` of their ``group``, as a kept table.

    One range sort over all groups; a group may lie in many ranges, and a sum over the sizes of its ranges gives each one's first place. Nulls are a
    group, and come first in the order. Equal rows are told apart by where they were read, so that even these are spread over ranges.
    """
    rows = df.withColumn("__tie", F.monotonically_increasing_id())
    by = [group, *order, "__tie"]
    with scratch_tables(df.sparkSession):
        ranges = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
                             .withColumn("__range", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "ranges")
        parts = ranges.groupBy(F.col(group).alias("__group"), F.col("__range").alias("__part")).agg(F.min("__at").alias("__first"), F.count("*").alias("__size"))
        # One row per group and range.
        before = Window.partitionBy("__group").orderBy("__part")
        parts = materialize(parts.select("__group", "__part", (F.sum("__size").over(before) - F.col("__size") - F.col("__first")).alias("__shift")), "parts")
        placed = ranges.join(parts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__range") == F.col("__part")))
        return materialize(placed.withColumn(name, F.col("__at") + F.col("__shift")).select(*df.columns, name), "numbered", kept=True)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable by links, for every node that has one.

    Alternates the large-star and small-star steps until the links no longer change. Every step is one
    aggregation and one join on the node, and each round's links are a table, so that lineage stays short.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    state, more = None, True
    with scratch_tables(spark):
        edges = materialize(edges, "links")
        while more:
            both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
            large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(low, "u").select(
                F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
            ).select("e.*").filter("u <> v").distinct()
            edges = materialize(small, "links")
            before, state = state, edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            more = state != before
        member = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        return materialize(member.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components", kept=True)
