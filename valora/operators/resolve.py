"""Entity resolution between two sources without a shared key.

Tiers: equal full name and block, equal last name and block, most similar full name in the
block, unmatched. A block is an attribute both sides must agree on (a birth date).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from valora import config
from valora.functions.similarity import (
    LEFT_LONG, MIN_THRESHOLD, PROFILE, RIGHT_LONG, bigrams_of, may_be_similar, signature_udf, size_band, token_set_similarity,
)
from valora.operators.order import OrderColumn, row_order
from valora.operators.relational import known, left_join
from valora.session import materialize

#: Bigrams that are ordered by how often they occur; rarer ones come before them, by their letters.
RANKED_GRAMS = 20_000
#: A name is some hundred rows on keys: a block with at most so many pairs for each of its names is cheaper tested pair by pair.
SMALL_BLOCK = 100
#: Pairs that are tested for the price of one meeting on a key; measured: 96 million pairs in 110 task seconds, 90 million meetings of the same names in 1,200.
MEETING = 8.0
#: Names of each side in a cell of a block's pairs.
CELL = 1_000
KEY = ["block", "band", "a", "b"]
SIDES = [("lname", "l"), ("rname", "r")]


def exact_ids(right: DataFrame, keys: Sequence[str], id_column: str, order_cols: Sequence[OrderColumn],
              keep: str = "last", alias: str | None = None) -> DataFrame:
    """One id per key of the right side: the first or last of its duplicates in order."""
    pick = {"first": F.min_by, "last": F.max_by}[keep]
    return right.transform(known, *keys).groupBy(*keys).agg(
        pick(id_column, row_order(right, order_cols)).alias(alias or id_column))


def exact_match(left: DataFrame, right: DataFrame, keys: Sequence[str], id_column: str,
                order_cols: Sequence[OrderColumn], keep: str = "last", alias: str | None = None) -> DataFrame:
    """Left equi-join against de-duplicated ids; keys with a null never match."""
    return left_join(left, exact_ids(right, keys, id_column, order_cols, keep, alias), keys)


def gram_ranks(names: DataFrame, name: str) -> dict[int, int]:
    """The most frequent bigrams of all names with their rank, the most frequent one last. Any order finds all pairs; this one emits few."""
    counts = names.select(F.explode(bigrams_of(name)).alias("gram")).groupBy("gram").count()
    frequent = counts.orderBy(F.desc("count"), "gram").limit(RANKED_GRAMS).collect()
    return {row.gram: len(frequent) - i for i, row in enumerate(frequent)}


def _keyed(names: DataFrame, name: str, alias: str, threshold: float) -> DataFrame:
    """One row per key of a name: two bigrams in a band of lengths, or one hashed token (pair). Only token rows carry the token keys."""
    left = alias == "l"
    tokens = lambda keys, kind: F.transform(keys, lambda k: F.struct(F.lit(0).alias("band"), k.alias("a"), F.lit(kind).cast("long").alias("b")))
    grams, band = F.col("s.grams"), size_band(F.col("s.length"), threshold)
    pairs = F.flatten(F.transform(grams, lambda x, i: F.transform(F.slice(grams, i + 2, F.size(grams)), lambda y: F.struct(band.alias("band"), x.alias("a"), y.alias("b")))))
    if left:
        pairs = F.flatten(F.transform(pairs, lambda k: F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.struct((k["band"] + d).alias("band"), k["a"], k["b"]))))
    keys = F.concat(tokens(F.col("s.own" if left else "s.whole"), LEFT_LONG), tokens(F.col("s.whole" if left else "s.own"), RIGHT_LONG), pairs)
    rows = names.select("block", name, "s", F.explode(keys).alias("key"))
    token_row = F.col("key.b") < 0
    return rows.select(F.col("block").alias(f"{alias}_block"), F.col("key.band").alias(f"{alias}_band"), F.col("key.a").alias(f"{alias}_a"), F.col("key.b").alias(f"{alias}_b"),
                       name, F.struct("s.grams", *[f"s.{c}" for c in PROFILE], *[F.when(token_row, F.col(f"s.{c}")).alias(c) for c in ("own", "whole")]).alias(alias))


def _tasks(names: DataFrame) -> int:
    return int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _spread(names: DataFrame, name: str) -> DataFrame:
    """Names are few bytes but many keys each, so their size must not decide in how many tasks they are keyed. Spark would leave out a
    repartition by (block, name), as they lie already."""
    return names.repartition(_tasks(names), name, "block")


def _met(l_rows: DataFrame, r_rows: DataFrame) -> DataFrame:
    """(block, met): how often names of both sides meet on a key of their block."""
    counts = [rows.groupBy(*[F.col(f"{side}_{c}").alias(c) for c in KEY]).agg(F.count("*").alias(f"{side}_n")) for side, rows in (("l", l_rows), ("r", r_rows))]
    return counts[0].hint("merge").join(counts[1], KEY).groupBy("block").agg(F.sum(F.col("l_n").cast("double") * F.col("r_n")).alias("met"))


def _with_ways(signed: list[DataFrame], threshold: float) -> list[DataFrame]:
    """The signed names of blocks that both sides have, stored, with the number of names of their block, ``l_n`` and ``r_n``, and whether all of them are ``paired``:
    this is the way of small blocks, and of those whose names meet on keys so often that their pairs cost less, as where all are made of the same words."""
    l_n, r_n = (names.groupBy("block").agg(F.count("*").alias(n)) for names, n in zip(signed, ("l_n", "r_n")))
    pairs = F.col("l_n").cast("double") * F.col("r_n")
    sizes = materialize(l_n.join(r_n, "block").withColumn("paired", pairs <= (F.col("l_n") + F.col("r_n")) * SMALL_BLOCK), "blocks")
    large = sizes.filter("NOT paired")
    if not large.isEmpty():
        l_rows, r_rows = (_keyed(names.join(large.select("block"), "block", "left_semi"), name, side, threshold) for names, (name, side) in zip(signed, SIDES))
        met = _met(l_rows, r_rows)
        sizes = materialize(sizes.join(met, "block", "left").withColumn("paired", F.col("paired") | F.coalesce(pairs <= F.col("met") * MEETING, F.lit(False))).drop("met"), "blocks")
    return [materialize(names.join(sizes, "block"), "names") for names in signed]


def _all_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """The pairs of a block that may reach the threshold, each tested once: both sides are dealt over cells of about ``CELL`` names by ``CELL`` names."""
    across, down = (F.ceil(F.col(n) / CELL).cast("int") for n in ("l_n", "r_n"))
    cells = lambda most: F.explode(F.sequence(F.lit(0), most - 1))
    at = lambda name, most: F.pmod(F.xxhash64(name), most).cast("int")
    l_rows = left.select(F.col("block").alias("l_block"), "lname", F.col("s").alias("l"), at("lname", across).alias("l_x"), cells(down).alias("l_y"))
    r_rows = right.select(F.col("block").alias("r_block"), "rname", F.col("s").alias("r"), cells(across).alias("r_x"), at("rname", down).alias("r_y"))
    # A cell is few bytes and many pairs: sizes must not decide in how many tasks they are tested.
    l_rows, r_rows = (rows.repartition(_tasks(rows), f"{side}_block", f"{side}_x", f"{side}_y") for side, rows in (("l", l_rows), ("r", r_rows)))
    same = [F.col(f"l_{c}") == F.col(f"r_{c}") for c in ("block", "x", "y")]
    alike = may_be_similar("l", "r", threshold) & (F.size(F.array_intersect("l.grams", "r.grams")) >= 2)
    fit = alike | F.arrays_overlap("l.own", "r.whole") | F.arrays_overlap("l.whole", "r.own")
    return l_rows.hint("merge").join(r_rows, reduce(Column.__and__, same) & fit).select(F.col("l_block").alias("block"), "lname", "rname")


def _pairs_by_keys(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """The pairs of a block that may reach the threshold, met on shared keys.

    A pair is emitted at one of its keys only, the first one it
    shares: at its two rarest shared bigrams if these and the profiles do not rule it out, else at its least shared token key. What a key's rows must carry for
    that are a few numbers; no pair is shuffled to find its double.
    """
    l_rows, r_rows = (_keyed(names, name, side, threshold) for names, (name, side) in zip((left, right), SIDES))
    common = F.array_intersect("l.grams", "r.grams")
    fitting = may_be_similar("l", "r", threshold)
    alike = fitting & (F.size(common) >= 2)
    by_left, by_right = F.array_intersect("l.own", "r.whole"), F.array_intersect("l.whole", "r.own")
    # The few integer operations come before the sets of bigrams: where a block is full of names of the same words, most pairs end there.
    here = F.when(F.col("l_b") >= 0, fitting & (F.slice(common, 1, 2) == F.array("l_a", "l_b"))) \
        .when(F.col("l_b") == LEFT_LONG, (F.array_min(by_left) == F.col("l_a")) & ~alike) \
        .otherwise((F.size(by_left) == 0) & (F.array_min(by_right) == F.col("l_a")) & ~alike)
    same = [F.col(f"l_{c}") == F.col(f"r_{c}") for c in KEY]
    # Spark's estimate of a side's size knows nothing of the keys per name: without the hint it would broadcast gigabytes.
    return l_rows.hint("merge").join(r_rows, reduce(Column.__and__, same) & here).select(F.col("l_block").alias("block"), "lname", "rname")


def candidate_pairs(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """(block, lname, rname): pairs that may reach the threshold, each once, from (block, lname) and (block, rname).

    Each block goes the way that costs less: all its names with each other, or those that meet on the keys that similar names must share.
    """
    signed = signature_udf(threshold, gram_ranks(right, "rname"))
    rows = [materialize(_spread(names, name).select("block", name, signed(name).alias("s")), "signatures") for names, (name, _) in zip((left, right), SIDES)]
    ways = _with_ways(rows, threshold)
    pairs = _all_pairs(*[names.filter("paired") for names in ways], threshold)
    if ways[0].filter("NOT paired").isEmpty():
        return pairs
    return pairs.union(_pairs_by_keys(*[names.filter("NOT paired") for names in ways], threshold))


def best_similar(left: DataFrame, right: DataFrame, threshold: float = config.FUZZY_THRESHOLD) -> DataFrame:
    """Best right name per left ``(block, lname)`` scoring at least ``threshold``.

    ``right`` has one row per ``(block, rname)`` with its first order ``ord`` and an ``id``. No pair at or above the threshold is lost, and
    a block of any size is spread over its keys.
    """
    if threshold <= MIN_THRESHOLD:
        raise ValueError(f"threshold must be above {MIN_THRESHOLD:.1f}")
    names = left.select("block", "lname").filter("block IS NOT NULL AND lname <> ''").distinct()
    index = right.select("block", "rname").filter("block IS NOT NULL AND rname <> ''")
    scored = candidate_pairs(names, index, threshold) \
        .withColumn("score", token_set_similarity("lname", "rname")).filter(F.col("score") >= threshold)
    # Equal scores: the candidate that comes first in the right order wins.
    best = F.min_by(F.struct("id", "score"), F.struct(-F.col("score"), F.col("ord"))).alias("best")
    return scored.join(right.select("block", "rname", "id", "ord"), ["block", "rname"]) \
        .groupBy("block", "lname").agg(best).select("block", "lname", "best.id", "best.score")


def exact_tiers(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, full: str, last: str,
                block: str, order_cols: Sequence[OrderColumn]) -> DataFrame:
    """Left rows with ``__full_id`` (last duplicate wins) and ``__last_id`` (first wins)."""
    by_full = exact_ids(right, [full, block], right_id, order_cols, "last", "__full_id")
    by_last = exact_ids(right, [last, block], right_id, order_cols, "first", "__last_id")
    people = left.select(left_id, full, last, block)
    return left_join(left_join(people, by_full, [full, block]), by_last, [last, block])


def method_of(*tiers: tuple[str, str]) -> Column:
    """Name of the first tier whose id column is set, else ``unmatched``."""
    method = F.lit("unmatched")
    for column, name in reversed(tiers):
        method = F.when(F.col(column).isNotNull(), name).otherwise(method)
    return method


def resolve(left: DataFrame, right: DataFrame, *, left_id: str, right_id: str, full: str, last: str, block: str,
            order_cols: Sequence[OrderColumn], output_id: str = "matched_id", threshold: float = config.FUZZY_THRESHOLD) -> DataFrame:
    """Cascade exact full name, exact last name, similar name, unmatched.

    ``left`` has one row per ``left_id``; both sides carry normalised ``full`` and ``last``
    names and the ``block``. Returns ``left_id, output_id, match_method``. Duplicate right
    keys resolve to the last id for the full-name tiers and the first id for the last-name tier.
    """
    right = right.transform(known, block)
    # Stored: the tiers are read for the open names and again for the result.
    exact = materialize(exact_tiers(left, right, left_id=left_id, right_id=right_id, full=full, last=last,
                                    block=block, order_cols=order_cols), "exact-tiers")
    still_open = exact.filter("__full_id IS NULL AND __last_id IS NULL").transform(known, block)
    pending = still_open.transform(known, full).select(
        F.col(block).alias("block"), F.col(full).alias("lname"))
    order = row_order(right, order_cols)
    candidates = right.transform(known, full).groupBy(F.col(block).alias("block"), F.col(full).alias("rname")).agg(
        F.max_by(right_id, order).alias("id"), F.min(order).alias("ord"))
    similar = best_similar(pending, candidates, threshold).select(
        F.col("block").alias(block), F.col("lname").alias(full), F.col("id").alias("__near_id"))

    # Only names that are still open look for a similar one, so the join is on those rows.
    done = exact.filter("__full_id IS NOT NULL OR __last_id IS NOT NULL OR " f"`{block}` IS NULL")
    near_type = dict(right.dtypes)[right_id]
    tiers = still_open.join(similar, [full, block], "left").unionByName(
        done.withColumn("__near_id", F.lit(None).cast(near_type)))
    return tiers.select(
        left_id, F.coalesce("__full_id", "__last_id", "__near_id").alias(output_id),
        method_of(("__full_id", "exact_full"), ("__last_id", "exact_last"), ("__near_id", "fuzzy"))
        .alias("match_method"))


def match_rate(crosswalk: DataFrame, output_id: str = "matched_id") -> DataFrame:
    """Totals, matched share in percent and a count per method, as one row."""
    matched = F.count(output_id)
    methods = ["exact_full", "exact_last", "fuzzy", "unmatched"]
    return crosswalk.agg(
        F.count("*").alias("total"), matched.alias("matched"),
        F.coalesce(F.try_divide(100.0 * matched, F.count("*")), F.lit(0.0)).alias("match_pct"),
        *[F.count_if(F.col("match_method") == m).alias(m) for m in methods],
    )
