"""Presentation text: verdicts and currency."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from valora import config


def mispricing(predicted: Column, actual: Column) -> Column:
    """Relative gap of the prediction; null where the actual value is not positive."""
    return F.when(actual > 0, (predicted - actual) / actual)


def verdict_code(predicted: Column, actual: Column, threshold: float = config.VERDICT_THRESHOLD) -> Column:
    gap = mispricing(predicted, actual)
    return (
        F.when(gap.isNull(), "unknown")
        .when(gap > threshold, "UNDERVALUED")
        .when(gap < -threshold, "OVERVALUED")
        .otherwise("FAIR VALUE")
    )


def verdict_text(predicted: Column, actual: Column, threshold: float = config.VERDICT_THRESHOLD) -> Column:
    gap = mispricing(predicted, actual)
    # rint gives the half-to-even rounding the wording is defined with; the cast drops -0.
    percent = F.rint(gap * 100).cast("long")
    return (
        F.when(gap.isNull(), "unknown")
        .when(gap > threshold, F.format_string("UNDERVALUED  (model sees +%d%% upside)", percent))
        .when(gap < -threshold, F.format_string("OVERVALUED   (model sees %d%% downside)", percent))
        .otherwise(F.concat(
            F.lit("FAIR VALUE   (within "),
            F.when(gap < 0, "-").otherwise("+"),
            F.abs(percent).cast("string"),
            F.lit("% of TM)"),
        ))
    )


def money_text(c: Column, digits: int = 1) -> Column:
    """Amount as text in millions of euros."""
    return F.format_string(f"€%.{digits}fM", F.rint(c / 1e6 * 10.0**digits) / 10.0**digits)
