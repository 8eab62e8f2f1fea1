"""From player records and market tables to the joined player-season-club data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from valora import config
from valora.functions.dates import parse_date
from valora.functions.numeric import parse_number
from valora.functions.text import full_name, normalize_name
from valora.operators.asof import asof_nearest
from valora.operators.order import Bits, row_order
from valora.operators.relational import attach, first_kind_per_key, first_per_key, keep_other_than, known, semi_filter
from valora.operators.resolve import resolve
from valora.sources.tables import MarketTables

# The order of records packed into one LONG: bits of season, league, team in the league, page, record on the page, entry of the record.
_RECORD_ORDER = {"season_idx": 12, "league_idx": 9, "team_idx": 12, "page": 10, "pos": 12, "stat_pos": 8}


def flatten_players(records: DataFrame, dedup: bool = False) -> DataFrame:
    """One row per statistics entry; a record without entries gives no row.

    ``dedup`` keeps one row per player, season, team and league where the source repeats entries.
    """
    stats = records.select(
        "season", "league_id", "player", *[F.coalesce(f"rec_ord.{c}", F.lit(0)).alias(c) for c in _RECORD_ORDER if c != "stat_pos"],
        F.posexplode("statistics").alias("stat_pos", "s"))
    text = lambda path: F.coalesce(F.col(path), F.lit(""))
    flat = stats.select(
        F.col("player.id").alias("api_player_id"), "season",
        text("player.firstname").alias("firstname"), text("player.lastname").alias("lastname"),
        parse_date(F.col("player.birth.date")).alias("dob"),
        text("player.nationality").alias("nationality"), text("s.games.position").alias("position"),
        F.col("s.team.name").alias("team_name"), F.col("s.team.id").alias("team_id"),
        F.col("s.games.appearences").alias("appearances"), F.col("s.games.minutes").alias("minutes"),
        F.col("s.goals.total").alias("goals"), F.col("s.goals.assists").alias("assists"),
        F.col("s.cards.yellow").alias("yellow_cards"), F.col("s.cards.red").alias("red_cards"),
        F.col("s.shots.total").alias("shots_total"), F.col("s.shots.on").alias("shots_on"),
        F.col("s.passes.total").alias("passes_total"), F.col("s.passes.key").alias("passes_key"),
        F.col("s.passes.accuracy").alias("passes_accuracy"),
        F.col("s.tackles.total").alias("tackles"), F.col("s.tackles.interceptions").alias("interceptions"),
        F.col("s.tackles.blocks").alias("blocks"),
        F.col("s.duels.total").alias("duels_total"), F.col("s.duels.won").alias("duels_won"),
        F.col("s.dribbles.attempts").alias("dribbles_attempts"),
        F.col("s.dribbles.success").alias("dribbles_success"),
        F.col("s.fouls.drawn").alias("fouls_drawn"), F.col("s.fouls.committed").alias("fouls_committed"),
        parse_number(F.col("s.games.rating")).alias("rating"),
        F.col("s.penalty.scored").alias("penalty_goals"), "league_id",
        row_order(stats, [Bits(c, bits) for c, bits in _RECORD_ORDER.items()]).alias("rec_ord"),
    ).withColumns({
        "full_name_norm": normalize_name(full_name(F.col("firstname"), F.col("lastname"))),
        "last_name_norm": normalize_name(F.col("lastname")),
    })
    if dedup:
        columns = flat.columns
        flat = first_per_key(flat, ["api_player_id", "season", "team_id", "league_id"], ["rec_ord"]).select(columns)
    return flat


def build_crosswalk(rows: DataFrame, market_players: DataFrame,
                    threshold: float = config.FUZZY_THRESHOLD) -> DataFrame:
    """``api_player_id, tm_player_id, match_method``, one row per player of the flat rows."""
    people = first_kind_per_key(rows.transform(known, "api_player_id"), ["api_player_id"], ["rec_ord"],
                                ["full_name_norm", "last_name_norm", "dob"])
    market = market_players.select(
        "player_id", normalize_name(F.col("name")).alias("full_name_norm"),
        normalize_name(F.col("last_name")).alias("last_name_norm"), F.col("date_of_birth").cast("date").alias("dob"))
    return resolve(people, market, left_id="api_player_id", right_id="player_id", full="full_name_norm",
                   last="last_name_norm", block="dob", order_cols=["player_id"], output_id="tm_player_id",
                   threshold=threshold)


def build_joined_dataset(rows: DataFrame, market: MarketTables, crosswalk: DataFrame | None = None,
                         direction: str = "nearest", tolerance_days: int | None = None) -> DataFrame:
    """Field players with the market value nearest to July 1 after the season; rows without
    a value are dropped."""
    if crosswalk is None:
        crosswalk = build_crosswalk(rows, market.players)
    matched = crosswalk.transform(known, "tm_player_id")
    tagged = attach(rows, matched, ["api_player_id"], ["tm_player_id"])
    tagged = keep_other_than(tagged, "position", config.EXCLUDED_POSITION)

    values = market.valuations.select(F.col("player_id").alias("tm_player_id"), "date", "market_value_in_eur")
    values = semi_filter(values, matched, {"tm_player_id": "tm_player_id"})
    probes = tagged.transform(known, "tm_player_id").select("tm_player_id", "season").distinct()
    snapped = asof_nearest(values, probes, key="tm_player_id", date="date", value="market_value_in_eur",
                           season="season", ties=["market_value_in_eur"], direction=direction,
                           tolerance_days=tolerance_days).drop("date")
    return tagged.join(snapped, ["tm_player_id", "season"]).transform(known, "market_value_in_eur") \
        .select(*rows.columns, "tm_player_id", "market_value_in_eur")
