"""Null-aware numeric expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null for a zero or missing denominator."""
    return numerator / zero_to_null(denominator.cast("double"))


def per90(c: Column, minutes: Column) -> Column:
    return c / (zero_to_null(minutes.cast("double")) / 90)


def clip_lower(c: Column, bound: float = 0) -> Column:
    """Raise values below the bound to it; null stays null (``greatest`` would drop it)."""
    return F.when(c < bound, F.lit(bound)).otherwise(c)


def parse_number(c: Column, default: float | None = None) -> Column:
    number = c.try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def lookup(c: Column, table: Mapping[str, object]) -> Column:
    """Literal map lookup; a miss gives null."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.create_map(*pairs)[c]


def indicator(c: Column) -> Column:
    """Condition to 1.0 / 0.0; an unknown condition counts as false."""
    return F.coalesce(c.cast("double"), F.lit(0.0))


def one_hot(c: Column, categories: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per category of a fixed list; null or unknown gives all zeros."""
    return {f"{prefix}{v}": indicator(c == F.lit(v)) for v in categories}


def one_hot_label(columns: Sequence[str], prefix: str) -> Column:
    """Name of the largest 0/1 column without its prefix; the first maximum wins."""
    values = F.array(*[F.col(c) for c in columns])
    names = F.array(*[F.lit(c.removeprefix(prefix)) for c in columns])
    return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))


def to_millions(c: Column, digits: int | None = None) -> Column:
    scaled = c / 1e6
    return scaled if digits is None else round_half_even(scaled, digits)


def round_half_even(c: Column, digits: int) -> Column:
    scale = 10.0**digits
    return F.rint(c * scale) / scale
