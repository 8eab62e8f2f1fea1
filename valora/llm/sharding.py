"""Shards of a data set by jump consistent hashing.

A row's key is hashed to 64 bits, and its shard follows from that number and the number of shards alone: the number seeds a generator of jumps, and
the last jump below the number of shards is the shard. No ring, no table and no state; when shards are appended, a row stays or goes to
one of the new ones, and the share that goes is the new ones' share of all. Within a shard, rows are numbered over a range sort, so that
no shard passes through one task. Only what orders the rows is sorted; texts are moved where shards are written, once.

Rows: key columns count as their text, each with its length, so that a null, an empty text and neighbouring columns are told apart. Rows of one key share a
shard whatever their number: that is what a key law means; their slots, and the files of a written shard, are still spread over tasks. Equal rows get
slots of their own. A null text has no bytes. Other columns are kept. Empty tables give empty shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from valora.llm.common import numbered

# The multiplier of the generator and the range of its jumps.
MULTIPLIER, JUMP_RANGE = np.uint64(2862933555777941757), float(2**31)


def key_hash(*columns: str | Column) -> Column:
    """64 bits of the SHA-256 of the columns: each its number of characters, a colon and its text, ``-`` where null."""
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    digest = F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("long")


def jumps(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. All keys jump together; those that have jumped beyond the last shard are done."""
    state, shard = keys.astype(np.int64).view(np.uint64).copy(), np.zeros(len(keys), np.int64)
    moving, at = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    while len(moving):
        shard[moving] = at
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        at = ((shard[moving] + 1).astype(np.float64) * (JUMP_RANGE / drawn)).astype(np.int64)
        moving, at = moving[at < shards], at[at < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """The shard, from 0, of a 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard")

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jumps(keys.to_numpy(), shards).astype(np.int32))

    return jump(key)


def assigned(rows: DataFrame, keys: list[str], shards: int, *, shard_col: str = "shard") -> DataFrame:
    """The rows with their shard: one pass, nothing is shuffled."""
    return rows.withColumn(shard_col, shard_of(key_hash(*keys), shards))


def slotted(rows: DataFrame, order: list[str], *, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """The rows with their place in the shard, without gaps from 0, in the ``order`` given."""
    return numbered(rows, shard_col, order, slot_col)


def moved(rows: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """The rows whose shard differs between two numbers of shards, with ``from_shard`` and ``to_shard``: all that growing has to copy."""
    key = key_hash(*keys)
    return rows.withColumns({"from_shard": shard_of(key, before), "to_shard": shard_of(key, after)}).filter("from_shard <> to_shard")


def write_shards(rows: DataFrame, path: str, keys: list[str], shards: int, *, files: int = 1, mode: str = "errorifexists") -> None:
    """Write the rows below ``path`` as one folder per shard, each of about ``files`` files or more, by one shuffle.

    A shard's rows are dealt over its files by where they were read, so a key that many rows share fills all files of its shard.
    """
    dealt = assigned(rows, keys, shards).withColumn("__file", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files)))
    dealt.repartition(shards * files, "shard", "__file").drop("__file").write.partitionBy("shard").mode(mode).parquet(path)


def text_sizes(documents: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """(id, size, text_crc32, shard, grown_shard, slot): where each document goes now, and with one more shard. ``size`` is its bytes and ``overhead``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = documents.select(F.col(id_col), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"))
    placed = sized.withColumns({"shard": shard_of(key_hash(id_col), shards), "grown_shard": shard_of(key_hash(id_col), shards + 1)})
    return slotted(placed, [id_col, "size", "text_crc32"])
