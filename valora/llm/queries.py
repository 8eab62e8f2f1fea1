"""The operators applied to the given tables; digest columns are derived from the operators' own outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from valora.llm import (
    bpe, decontaminate, htmltext, jaccard, lexical, licenses, linededup, manifest, oracles, quality, secretscan, sharding, toxicity, wordpiece,
)
from valora.llm.registry import query, table


@query("op4_benchmark_decontamination", oracles.CONTAMINATION)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, words hit, items hit and whether it counts as contaminated."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        F.coalesce(decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")), F.lit(False)).alias("contaminated"))


@query("op10_ngram_jaccard_join", oracles.COMPONENTS)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: distinct 3-word shingles and the smallest doc_id linked to it at a Jaccard similarity of 0.9."""
    found = jaccard.similarity_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


@query("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the lines left of it once later copies of repeated runs are gone."""
    documents = table(spark, sf_dir, "documents")
    left = linededup.without_later_copies(documents.withColumn("before", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")))
    return left.select("doc_id", F.col("before").alias("n_lines"), F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


@query("op1_byte_level_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the bytes they decode to."""
    from public_tokenizers import path
    ranks = path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks).select("doc_id", "ids")
    return bpe.decode(ids, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: a toxicity score learned from the rows that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), learn=~toxicity.held_out())
    return toxicity.score(documents.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op3_secret_scans")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: secrets by kind, a digest of the base spans, and all spans."""
    found = secretscan.secrets(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secretscan.BASE_RULES]))
    return found.select("doc_id", number("assign"), number("access"), number("hex"),
                        F.sha2(secretscan.written(base), 256).alias("base_sha256"), secretscan.written(F.col("spans")).alias("spans"))


@query("op6_quality_rules", oracles.QUALITY)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the base statistics, whether the base rule fails and whether the certified rules keep it."""
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_license_scans")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: places of the base phrases, and the labels of phrases and of covered templates."""
    found = licenses.license_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    starts, base = F.transform("phrases", lambda x: x["start"]), F.transform("phrases", lambda x: x["label"])
    every = F.concat(base, F.transform("spans", lambda x: x["label"]))
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0))
    return found.select("doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                        F.array_max(starts).alias("last_word"), listed(base).alias("base_labels"), listed(every).alias("labels"),
                        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(best).alias("score"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, greedy word pieces and words that the vocabulary cannot spell."""
    from public_tokenizers import path
    initial, further = wordpiece.sentence_pieces(path("piece_bpe_32k.model"))
    return wordpiece.piece_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), initial, further).drop("text")


@query("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text and the text's length in code points."""
    return htmltext.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query("op11_ranked_lexical_search", oracles.RANKED)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per benchmark item: its 50 best documents by whole-number scores."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


@query("op12_merkle_manifest", oracles.MANIFEST)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, the roots above, a digest of its witness, and the root that the witness gives after some counts were changed."""
    documents = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = manifest.leaf_of("doc_id", "source", "lang", F.col("n_chars") + 1, "text")
    touched = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    found = manifest.manifest(documents, fields=fields, carry={"tampered": F.when(touched, F.unhex(changed))})
    folded = manifest.folded(F.coalesce(manifest.hexed("tampered"), F.col("leaf")), "witness")
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(manifest.siblings("witness"), ""), 256).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_sharding", oracles.SHARDS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its shard of 24 by its id, its place there, and its shard of 25."""
    return sharding.text_sizes(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
