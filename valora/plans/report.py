"""Answers from scored rows: mispricing ranking, lookup, comparison with paid fees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from valora import config
from valora.functions.dates import parse_date, season_label, season_start_year
from valora.functions.labels import mispricing, verdict_code, verdict_text
from valora.functions.numeric import parse_number, round_half_even, to_millions
from valora.functions.text import full_name, matches
from valora.operators.relational import attach, first_per_key, semi_filter

MODEL, MARKET = config.WINNER_MODEL, config.WINNER_MARKET


def with_names(df: DataFrame, joined: DataFrame, order_cols: Sequence[str | Column],
               keys: Sequence[str] = ("api_player_id", "season")) -> DataFrame:
    """Attach ``name`` from the first joined row per key; rows are not multiplied."""
    names = first_per_key(joined, list(keys), order_cols, ["firstname", "lastname"])
    attached = attach(df, names, list(keys))
    return attached.withColumn("name", full_name(F.col("firstname"), F.col("lastname"))).drop("firstname", "lastname")


def gap_columns(predicted: str = "predicted_eur", actual: str = "market_value_in_eur") -> dict[str, Column]:
    model_m, market_m = to_millions(F.col(predicted), 1), to_millions(F.col(actual), 1)
    return {"market_m": market_m, "model_m": model_m, "gap_m": round_half_even(model_m - market_m, 1)}


def undervalued(scored: DataFrame, ties: Sequence[str], predicted: str = "predicted_eur",
                actual: str = "market_value_in_eur") -> DataFrame:
    """Rows the model prices above the market, largest gap first. The gap is taken from
    values rounded to 0.1 million."""
    return scored.withColumns(gap_columns(predicted, actual)).filter("gap_m > 0") \
        .orderBy(F.desc_nulls_last("gap_m"), *ties)


def lookup(scored: DataFrame, pattern: str, name: str = "name", predicted: str = "predicted_eur",
           actual: str = "market_value_in_eur", season: str = "season", literal: bool = False) -> DataFrame:
    """Rows whose name matches, newest season first, with season label and verdict."""
    p, a = F.col(predicted), F.col(actual)
    return scored.filter(matches(F.col(name), pattern, literal)).withColumns({
        "season_label": season_label(F.col(season)), "market_m": to_millions(a, 1), "model_m": to_millions(p, 1),
        "ratio": mispricing(p, a), "verdict_code": verdict_code(p, a), "verdict": verdict_text(p, a),
    }).orderBy(F.desc_nulls_last(season), name)


def clean_fees(transfers: DataFrame, pivot: int | None = None) -> DataFrame:
    """Paid transfers with numeric fee and value, parsed date and season year."""
    return transfers.withColumnRenamed("player_id", "tm_player_id").withColumns({
        "transfer_fee": parse_number(F.col("transfer_fee"), 0.0),
        "market_value_in_eur": parse_number(F.col("market_value_in_eur"), 0.0),
        "transfer_date": parse_date(F.col("transfer_date").cast("string")),
        "season_year": season_start_year(F.col("transfer_season"), pivot),
    }).filter("transfer_fee > 0")


def transfer_benchmark(transfers: DataFrame, predictions: DataFrame,
                       target_season_year: int | None = None, ordered: bool = True) -> DataFrame:
    """Paid transfers of one season next to market and model value, largest fee first unless the caller needs no order.

    Without a target it is the newest season in which any predicted player was transferred.
    Several predictions of a player give several rows; no overlap gives an empty frame.
    """
    fees = clean_fees(transfers)
    if target_season_year is None:
        overlap = semi_filter(fees, predictions, {"tm_player_id": "tm_player_id"})
        window = fees.filter(F.col("season_year") == overlap.agg(F.max("season_year")).scalar())
    else:
        window = fees.filter(F.col("season_year") == target_season_year)
    merged = window.join(predictions.select("tm_player_id", "predicted_eur"), "tm_player_id")
    fee, market, model = (to_millions(F.col(c)) for c in ("transfer_fee", "market_value_in_eur", "predicted_eur"))
    benchmark = merged.select(
        "player_name", "from_club_name", "to_club_name", fee.alias("actual_fee_M"), market.alias("tm_value_M"),
        model.alias("model_value_M"), F.abs(model - fee).alias("error_model_M"), F.abs(market - fee).alias("error_tm_M"))
    if not ordered:
        return benchmark
    return benchmark.orderBy(F.desc_nulls_last("actual_fee_M"), "player_name", "from_club_name", "to_club_name")


def benchmark_winner(benchmark: DataFrame) -> DataFrame:
    """Mean errors and the closer side; a tie goes to the market."""
    summary = benchmark.agg(F.count("*").alias("matched"), F.avg("error_model_M").alias("mae_model"),
                            F.avg("error_tm_M").alias("mae_tm"))
    return summary.withColumn("winner", F.when(F.col("mae_model") < F.col("mae_tm"), MODEL).otherwise(MARKET))
