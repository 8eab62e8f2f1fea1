"""Feature stages 1 to 5, each one row per player and season.

All stages are projections and small joins around one roll-up of the joined rows. Stages
that read the roll-up several times (ranks, changes) store it once in the shared folder;
``rolled`` passes a stored roll-up to several stages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from valora import config
from valora.functions.dates import age_at_season_end
from valora.functions.numeric import clip_lower, indicator, lookup, one_hot, per90, ratio
from valora.operators.asof import asof_backward
from valora.operators.ranks import pct_rank
from valora.operators.relational import known, period_delta, spread_left_join
from valora.operators.rollup import WeightedMean, primary_member, rollup
from valora.session import materialize

KEY = ["api_player_id", "season"]
BASE = ["api_player_id", "season", "tm_player_id", "market_value_in_eur"]


def aggregate_multi_club(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",),
                         null_if_all_null: bool = False) -> DataFrame:
    """One row per player and season: sums, weighted accuracy and rating, first known
    descriptive values and the club with the most minutes."""
    extra = []
    primary = [c for c in ("team_id", "league_id") if c in joined.columns]
    if primary:
        extra += primary_member(joined, primary, "minutes", order_cols)
    means = [WeightedMean("passes_accuracy", "passes_total", zero_if_all_null=not null_if_all_null),
             WeightedMean("rating", "minutes")]
    return rollup(joined, KEY, config.META_COLUMNS, config.SUM_COLUMNS, means, order_cols, extra)


def stored_rollup(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",)) -> DataFrame:
    return materialize(aggregate_multi_club(joined, order_cols), "rollup")


def with_age(df: DataFrame) -> DataFrame:
    return df.withColumn("age", age_at_season_end(F.col("dob"), F.col("season")))


def with_position_group(df: DataFrame) -> DataFrame:
    """Map the position to its group; rows of other positions are dropped."""
    group = lookup(F.lower("position"), config.POSITION_GROUPS)
    return df.withColumn("position_group", group).filter("position_group IS NOT NULL")


def _prepared(joined: DataFrame | None, rolled: DataFrame | None, order_cols) -> DataFrame:
    return with_position_group(with_age(rolled if rolled is not None else aggregate_multi_club(joined, order_cols)))


def _finish(df: DataFrame, features: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    positions = one_hot(F.col("position_group"), config.POSITION_LABELS, "pos_")
    return df.select(
        *BASE, *features, *[c.alias(n) for n, c in positions.items()],
        F.log1p("market_value_in_eur").alias("log_market_value"), *carry,
    ).transform(known, "log_market_value", "age", "minutes")


def build_stage1(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",),
                 rolled: DataFrame | None = None) -> DataFrame:
    """Age, playing time, goals, assists, cards, position."""
    features = ["age", "minutes", "appearances", "goals", "assists", "yellow_cards", "red_cards"]
    return _finish(_prepared(joined, rolled, order_cols), features)


def rate_columns() -> dict[str, Column]:
    """Per-90 rates and success shares over rolled-up counts (``np_goals`` must exist)."""
    minutes = F.col("minutes")
    rates = {f"{c}_p90": per90(F.col(c), minutes) for c in config.PER90_COLUMNS}
    return rates | {
        "duels_won_pct": ratio(F.col("duels_won"), F.col("duels_total")),
        "shot_accuracy": ratio(F.col("shots_on"), F.col("shots_total")),
        "dribble_success_pct": ratio(F.col("dribbles_success"), F.col("dribbles_attempts")),
    }


def non_penalty_goals() -> Column:
    return clip_lower(F.col("goals") - F.coalesce(F.col("penalty_goals"), F.lit(0)))


def _stage2(prepared: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    df = prepared.withColumn("np_goals", non_penalty_goals()).withColumns(rate_columns())
    features = ["age", "minutes", "appearances", *[f"{c}_p90" for c in config.PER90_COLUMNS],
                "passes_accuracy", "duels_won_pct", "shot_accuracy", "dribble_success_pct", "rating"]
    return _finish(df, features, carry)


def build_stage2(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",),
                 rolled: DataFrame | None = None) -> DataFrame:
    """Per-90 rates, success shares and rating in place of raw counts."""
    return _stage2(_prepared(joined, rolled, order_cols))


def value_history(df: DataFrame, valuations: DataFrame) -> DataFrame:
    """Value known at the season start and its growth over the year before."""
    values = valuations.select(F.col("player_id").alias("tm_player_id"), "date", "market_value_in_eur")
    probes = df.transform(known, "tm_player_id").select("tm_player_id", "season").distinct()
    snaps = asof_backward(values, probes, key="tm_player_id", date="date", value="market_value_in_eur",
                          season="season", outputs={"__now": 0, "__before": -1}, ties=["market_value_in_eur"])
    dated = spread_left_join(df, snaps, ["tm_player_id", "season"], KEY)
    return dated.select(
        *df.columns, F.log1p("__now").alias("log_tm_prev_value"),
        (F.log1p("__now") - F.log1p("__before")).alias("tm_value_trend"))


def _stage3(joined: DataFrame, rolled: DataFrame, valuations: DataFrame | None, with_delta: bool,
            rank_groups: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    df = with_position_group(with_age(rolled))
    if with_delta:
        deltas = period_delta(rolled.select(*KEY, "goals", "assists", "minutes"), ["api_player_id"], "season",
                              ["goals", "assists", "minutes"])
        deltas = deltas.select(*KEY, "delta_goals", "delta_assists", "delta_minutes")
    df = _stage2(df, carry).withColumn("age_sq", F.col("age") * F.col("age"))
    df = pct_rank(df, rank_groups, ["goals_p90", "assists_p90", "minutes"], keys=KEY)
    if valuations is not None:
        df = value_history(df, valuations)
    return df.join(deltas, KEY, "left") if with_delta else df


def build_stage3(joined: DataFrame, valuations: DataFrame | None = None,
                 order_cols: Sequence[str | Column] = ("rec_ord",), rolled: DataFrame | None = None,
                 with_delta: bool = True, rank_groups: Sequence[str] = ("pos_FWD",)) -> DataFrame:
    """Age squared, percentile ranks, changes against the previous season and, when
    valuations are given, the value history."""
    rolled = stored_rollup(joined, order_cols) if rolled is None else rolled
    return _stage3(joined, rolled, valuations, with_delta, rank_groups)


def team_quality(joined: DataFrame, exclude_self: bool = False) -> DataFrame:
    """Mean value of a team's player rows per season; sum and count allow leaving one out."""
    return joined.transform(known, "team_id", "season").groupBy("team_id", "season").agg(
        F.avg("market_value_in_eur").alias("team_avg_value"),
        F.sum("market_value_in_eur").alias("__team_sum"), F.count("market_value_in_eur").alias("__team_n"))


def build_stage4(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",),
                 rolled: DataFrame | None = None, with_delta: bool = True,
                 league_ids: Sequence[int] | None = None, include_raw_league_id: bool = True,
                 exclude_self: bool = False, unknown_league: bool = False,
                 rank_groups: Sequence[str] = ("pos_FWD",)) -> DataFrame:
    """Involvement and defence rates, minutes per match, team quality and league.

    The team mean holds the player's own value; ``exclude_self`` leaves it out.
    """
    rolled = stored_rollup(joined, order_cols) if rolled is None else rolled
    minutes = F.col("minutes")
    extra = {
        "goal_involvement_p90": per90(F.col("goals") + F.col("assists"), minutes),
        "defensive_actions_p90": per90(F.col("tackles") + F.col("interceptions") + F.col("blocks"), minutes),
        "minutes_per_app": ratio(minutes, F.col("appearances")),
    }
    if "league_id" in rolled.columns:
        leagues = league_ids if league_ids is not None else [v[0] for v in config.LEAGUES.values()]
        labels = sorted(str(v) for v in leagues)
        if include_raw_league_id:
            extra["league_id"] = F.col("league_id")
        extra |= one_hot(F.col("league_id").cast("string"), labels, "league_")
        if unknown_league:
            extra["league_<NA>"] = F.col("league_id").isNull().cast("double")
    carried = rolled.withColumns(extra)
    team = ["team_id"] if "team_id" in rolled.columns else []
    df = _stage3(joined, carried, None, with_delta, rank_groups, [*extra, *team])
    if not team:
        return df
    mean = F.col("team_avg_value")
    if exclude_self:
        mean = (F.col("__team_sum") - F.col("market_value_in_eur")) / F.nullif(F.col("__team_n") - 1, F.lit(0))
    leagues_last = [c for c in extra if c.startswith("league_")]
    others = [c for c in df.columns if c not in leagues_last and c != "team_id"]
    return spread_left_join(df, team_quality(joined), ["team_id", "season"], KEY).select(
        *others, F.log1p(mean).alias("log_team_avg_value"), *leagues_last)


def with_age_curve(df: DataFrame) -> DataFrame:
    """Distance from the peak age of the position, years to resale age, youth and interactions."""
    age = F.col("age")
    peak = F.lit(config.DEFAULT_PEAK_AGE)
    for label, years in config.PEAK_AGE.items():
        peak = F.when(F.col(f"pos_{label}") == 1.0, F.lit(years)).otherwise(peak)
    return df.withColumns({
        "age_vs_pos_peak": age - peak,
        "years_to_30": clip_lower(F.lit(config.RESALE_AGE) - age),
        "is_young": indicator(age < config.YOUNG_AGE),
        "age_x_goal_inv": age * F.coalesce("goal_involvement_p90", F.lit(0.0)),
        "age_x_minutes": age * F.coalesce(F.col("minutes").cast("double"), F.lit(0.0)),
    })


def build_stage5(joined: DataFrame, order_cols: Sequence[str | Column] = ("rec_ord",), **options) -> DataFrame:
    """Stage 4 plus the age curve."""
    return with_age_curve(build_stage4(joined, order_cols, **options))


STAGES = {"stage1": build_stage1, "stage2": build_stage2, "stage3": build_stage3,
          "stage4": build_stage4, "stage5": build_stage5}
