"""Prediction quality per group, in log space and in euros."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from valora.operators.ranks import spearman_of_pairs, value_pairs
from valora.operators.relational import join_groups
from valora.session import materialize

METRICS = ["rmse_log", "mae_log", "r2_log", "spearman_log", "rmse_eur", "mae_eur"]
RESULT_KEYS = ["model", "stage", "position"]


def regression_metrics(df: DataFrame, groups: Sequence[str], truth: str = "y_true", prediction: str = "y_pred",
                       count: str = "n_samples") -> DataFrame:
    """Six metrics per group. R² is null below two rows; a constant target gives 1 for a
    perfect prediction and 0 otherwise. Spearman is null where a side is constant."""
    # Everything is a function of the (truth, prediction) pair counts: predictions are
    # computed, read and shuffled once.
    # Stored: ranks are joined back by value, so no reader may see a recomputed prediction.
    pairs = materialize(value_pairs(df, groups, truth, prediction), "pairs")
    y, p, w = F.col("first"), F.col("second"), F.col("w")
    error, eur = y - p, F.expm1(y) - F.expm1(p)
    n = F.sum("w")
    sums = pairs.groupBy(*groups).agg(
        n.alias(count),
        F.sqrt(F.sum(w * error * error) / n).alias("rmse_log"), (F.sum(w * F.abs(error)) / n).alias("mae_log"),
        F.sum(w * error * error).alias("__sse"),
        F.when(F.min(y) < F.max(y), F.sum(w * y * y) - F.sum(w * y) * F.sum(w * y) / n).otherwise(0.0).alias("__sst"),
        F.sqrt(F.sum(w * eur * eur) / n).alias("rmse_eur"), (F.sum(w * F.abs(eur)) / n).alias("mae_eur"))
    sse, sst = F.col("__sse"), F.col("__sst")
    r2 = F.when(F.col(count) >= 2, F.when(sst > 0, 1 - sse / sst).when(sse == 0, 1.0).otherwise(0.0))
    ranked = spearman_of_pairs(pairs, groups, "spearman_log")
    sums = sums.withColumn("r2_log", r2)
    if not groups:
        return sums.select(count, "rmse_log", "mae_log", "r2_log", ranked.scalar().alias("spearman_log"),
                           "rmse_eur", "mae_eur")
    return join_groups(sums, ranked, groups).select(*groups, count, *METRICS)


def results_table(results: DataFrame) -> DataFrame:
    """Presentation of model results: three decimals, euros in millions with one."""
    return results.select(
        "stage", "position", "model", F.col("n_samples").alias("n"),
        F.bround("r2_log", 3).alias("r2"), F.bround("rmse_log", 3).alias("rmse_log"),
        F.bround("mae_log", 3).alias("mae_log"), F.bround("spearman_log", 3).alias("spearman"),
        F.bround(F.col("mae_eur") / 1e6, 1).alias("mae_eur_m"))


def result_pivot(results: DataFrame, row: str, column: str, value: str, columns: Sequence[str]) -> DataFrame:
    """Value per row and column label; absent combinations count as 0."""
    return results.groupBy(row).pivot(column, list(columns)).agg(F.first(value)).fillna(0, list(columns))
