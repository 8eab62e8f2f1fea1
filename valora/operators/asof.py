"""As-of joins of dated values onto yearly reference days.

All probes of a season share one calendar day, so dated rows fall into yearly intervals
between two such days. One aggregate keeps the earliest and the latest dated row per
(key, interval); map-side combine shrinks a hot key to a row per interval before the
shuffle. Windows then only run over intervals, of which a key has one per calendar year,
and dated rows are never multiplied by probes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from valora.functions.dates import season_day
from valora.operators.order import OrderColumn, with_row_orders
from valora.operators.relational import known


def _interval(date: Column, shift: int, month: int, day: int) -> Column:
    """Season whose reference day is the first one on or after the date."""
    year = F.year(date)
    after = date > F.make_date(year, F.lit(month), F.lit(day))
    return year + after.cast("int") - shift


def _timeline(values: DataFrame, probes: DataFrame, *, key: str, date: str, value: str, season: str,
              ties: Sequence[OrderColumn], shift: int, month: int, day: int, forward: bool) -> DataFrame:
    """One row per key and season: edge rows of the interval and whether it is probed."""
    present = values.transform(known, key, date, value).withColumn(date, F.col(date).cast("date"))
    days = F.unix_date(F.col(date))
    present = with_row_orders(present, {"__latest": [-days, *ties]} | ({"__earliest": [days, *ties]} if forward else {}))
    dated = present.select(
        F.col(key), _interval(F.col(date), shift, month, day).alias(season), F.lit(False).alias("probe"),
        F.col(date).alias("date"), F.col(value).alias("value"), *[c for c in ("__latest", "__earliest") if c in present.columns],
    )
    asked = probes.transform(known, key, season).select(
        F.col(key), F.col(season).cast("int").alias(season), F.lit(True).alias("probe"),
    )
    # Dates, values and orders of fixed width are combined in a hash table, without a sort.
    wanted = {"last": "__latest"} | ({"first": "__earliest"} if forward else {})
    edges = [F.min_by(c, order).alias(f"{name}_{c}") for name, order in wanted.items() for c in ("date", "value")]
    line = dated.unionByName(asked, allowMissingColumns=True).groupBy(key, season).agg(F.max("probe").alias("probe"), *edges)
    return line.select(key, season, "probe", *[
        F.when(F.col(f"{name}_date").isNotNull(), F.struct(F.col(f"{name}_date").alias("date"), F.col(f"{name}_value").alias("value"))).alias(f"{name}_hit")
        for name in wanted])


def asof_backward(values: DataFrame, probes: DataFrame, *, key: str, date: str, value: str, season: str,
                  outputs: dict[str, int], ties: Sequence[OrderColumn] = (), shift: int = 0,
                  month: int = 7, day: int = 1) -> DataFrame:
    """Latest value on or before the reference day of ``season + offset``.

    ``outputs`` maps an output column to its season offset (0 or negative); all offsets come
    out of one pass. Values of the reference day itself count. Among values of one date the
    first in ``ties`` order wins.
    """
    line = _timeline(values, probes, key=key, date=date, value=value, season=season, ties=ties,
                     shift=shift, month=month, day=day, forward=False)
    by_season = Window.partitionBy(key).orderBy(season)
    picks = {
        name: F.last("last_hit", ignorenulls=True).over(
            by_season.rangeBetween(Window.unboundedPreceding, offset))
        for name, offset in outputs.items()
    }
    found = line.withColumns(picks).filter("probe")
    return found.select(key, season, *[F.col(f"{n}.value").alias(n) for n in outputs])


def asof_nearest(values: DataFrame, probes: DataFrame, *, key: str, date: str, value: str, season: str,
                 output: str | None = None, ties: Sequence[OrderColumn] = (), shift: int = 1, month: int = 7, day: int = 1,
                 direction: str = "nearest", tolerance_days: int | None = None) -> DataFrame:
    """Value closest to the reference day of the season, before or after it.

    At equal distance the earlier date wins, within a date the first in ``ties`` order.
    ``direction`` may restrict the search to ``backward`` or ``forward``.
    Returns key, season, value and its date for every probe that finds one.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    line = _timeline(values, probes, key=key, date=date, value=value, season=season, ties=ties,
                     shift=shift, month=month, day=day, forward=True)
    before = Window.partitionBy(key).orderBy(season).rangeBetween(Window.unboundedPreceding, 0)
    # Descending order turns "any later interval" into a running frame as well.
    after = Window.partitionBy(key).orderBy(F.desc(season)).rangeBetween(Window.unboundedPreceding, -1)
    target = season_day(F.col(season), shift, month, day)
    line = line.withColumns({
        "b": F.last("last_hit", ignorenulls=True).over(before),
        "a": F.last("first_hit", ignorenulls=True).over(after),
    }).filter("probe").withColumns({
        "b_days": F.datediff(target, F.col("b.date")), "a_days": F.datediff(F.col("a.date"), target),
    })
    if direction == "forward":
        # A value on the day itself lies in the interval that ends there.
        pick = F.when(F.col("b_days") == 0, F.col("b")).otherwise(F.col("a"))
    elif direction == "backward":
        pick = F.col("b")
    else:
        pick = F.when(F.col("a_days") < F.col("b_days"), F.col("a")).otherwise(F.coalesce("b", "a"))
    found = line.select(key, season, pick.alias("pick"), target.alias("target")).filter("pick IS NOT NULL")
    if tolerance_days is not None:
        found = found.filter(F.abs(F.datediff("pick.date", "target")) <= tolerance_days)
    return found.select(key, season, F.col("pick.value").alias(output or value), F.col("pick.date").alias(date))
