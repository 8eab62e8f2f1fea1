"""Training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, later copies of repeated line runs go, and with them the documents that had words and have none left; one document of each
group of near duplicates stays, documents that hold benchmark passages go, and what is left is encoded. Each stage works on all that the one
before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from valora.llm import bpe, decontaminate, jaccard, linededup, toxicity
from valora.llm.common import SPACED_WORD, text_of
from valora.llm.registry import table
from valora.session import materialize

TOXIC_SCORE = 0.3
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out())
    scored = toxicity.score(docs, model, score_col="toxicity_score")
    return scored.filter(F.col("toxicity_score") < TOXIC_SCORE).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that had words and have none after go; null texts and texts without words stay."""
    worded = text_of().rlike(SPACED_WORD)
    left = linededup.without_later_copies(docs.withColumn("__worded", worded)).filter(~F.col("__worded") | worded)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document; ``decoded_sha256`` is the digest of the bytes that they decode to."""
    from public_tokenizers import path
    ids = bpe.encode(docs, path(VOCABULARY)).drop("offsets", "text")
    return bpe.decode(ids, path(VOCABULARY)).withColumn("n_tokens", F.size("ids").cast("long")) \
        .withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_level_bpe", tokenize),
]

#: No SQL says the toxicity model, the similarity components or the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
