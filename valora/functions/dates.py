"""Date and season expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(c: Column, fmt: str | None = None) -> Column:
    """Text to date; anything unparseable becomes null, also under ANSI mode."""
    stamp = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return stamp.cast("date")


def season_day(season: Column, shift: int = 1, month: int = 7, day: int = 1) -> Column:
    """A fixed calendar day of the year ``season + shift``."""
    return F.make_date(season.cast("int") + shift, F.lit(month), F.lit(day))


def day_distance(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def age_at_season_end(dob: Column, season: Column) -> Column:
    """Years from birth to June 30 of the next year, one decimal, half to even."""
    return F.rint(F.datediff(season_day(season, 1, 6, 30), dob) / F.lit(365.25) * 10) / 10


def season_start_year(label: Column, pivot: int | None = None) -> Column:
    """``'24/25'`` to 2024. Two-digit years count from 2000; with ``pivot`` those at or
    above it count from 1900. Text that is no number gives null."""
    number = F.trim(F.split(label, "/")[0]).try_cast("int")
    century = F.lit(2000) if pivot is None else F.when(number >= pivot, 1900).otherwise(2000)
    return F.when(number < 100, number + century).otherwise(number)


def season_label(season: Column) -> Column:
    """2024 to ``'2024/25'``."""
    following = F.lpad(F.pmod(season.cast("int") + 1, F.lit(100)).cast("string"), 2, "0")
    return F.concat(season.cast("int").cast("string"), F.lit("/"), following)
