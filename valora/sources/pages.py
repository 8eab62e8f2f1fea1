"""Cached JSON response pages of the statistics source.

File (or directory) names carry the request: ``players_page-1_season-2022_team-33.json``,
``teams_league-140_season-2022.json``. One scan reads all pages of all seasons, leagues and
teams; what the requests meant is recovered from the path as columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from valora import config
from valora.session import exists, materialize, scratch_tables

STATISTICS = (
    "STRUCT<team: STRUCT<id: BIGINT, name: STRING>, league: STRUCT<id: INT>, "
    "games: STRUCT<appearences: INT, minutes: INT, position: STRING, rating: STRING>, "
    "goals: STRUCT<total: INT, assists: INT>, cards: STRUCT<yellow: INT, red: INT>, "
    "shots: STRUCT<total: INT, `on`: INT>, passes: STRUCT<total: INT, key: INT, accuracy: DOUBLE>, "
    "tackles: STRUCT<total: INT, interceptions: INT, blocks: INT>, duels: STRUCT<total: INT, won: INT>, "
    "dribbles: STRUCT<attempts: INT, success: INT>, fouls: STRUCT<drawn: INT, committed: INT>, "
    "penalty: STRUCT<scored: INT>>"
)
RECORD = (
    "STRUCT<player: STRUCT<id: BIGINT, firstname: STRING, lastname: STRING, "
    f"birth: STRUCT<date: STRING>, nationality: STRING>, statistics: ARRAY<{STATISTICS}>>"
)
# ``errors`` is an empty list or an object, so it is kept as text.
PLAYER_PAGE = f"errors STRING, paging STRUCT<total: INT>, response ARRAY<{RECORD}>"
TEAM_PAGE = "errors STRING, response ARRAY<STRUCT<team: STRUCT<id: BIGINT>>>"
EXPORTED = "endpoint={endpoint}"
REQUEST_KEYS = ("league", "page", "season", "team")


def request_slug(endpoint: str, **params: object) -> str:
    """Name of the cached response of a request: parameters sorted by name."""
    name = "_".join([endpoint.replace("/", "_"), *[f"{k}-{params[k]}" for k in sorted(params)]])
    return f"{name}.json"


def request_slug_column(endpoint: str, **params: Column) -> Column:
    parts = [F.lit(endpoint.replace("/", "_"))]
    for key in sorted(params):
        parts += [F.lit(f"_{key}-"), params[key].cast("string")]
    return F.concat(*parts, F.lit(".json"))


def request_params(path: Column, keys: Sequence[str] = REQUEST_KEYS) -> dict[str, Column]:
    found = {k: F.regexp_extract(path, rf"_{k}-(\d+)[_.]", 1) for k in keys}
    return {k: F.nullif(v, F.lit("")).cast("int") for k, v in found.items()}


def scan_pages(spark: SparkSession, path: str, schema: str = PLAYER_PAGE, multiline: bool = True) -> DataFrame:
    """Pages with the request parameters of their path as columns.

    ``multiline`` reads one document per file; otherwise one document per line, which
    Spark can split and which suits large exports; these name their request themselves.
    """
    pages = spark.read.json(path, schema=f"{schema}, request STRING", multiLine=multiline)
    fields = T.StructType.fromDDL(schema).fieldNames()
    in_path = F.regexp_extract("_metadata.file_path", r"([a-z]+_[^/=]*-\d+\.json)", 1)
    scanned = pages.select(*fields, F.coalesce("request", in_path).alias("request"))
    return scanned.withColumns(request_params(F.col("request")))


def has_errors(errors: Column) -> Column:
    return F.coalesce(~F.trim(errors).isin("", "[]", "{}", "null"), F.lit(False))


def split_errors(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable pages, and the error responses set aside for a new request."""
    bad = has_errors(F.col("errors"))
    return pages.filter(~bad), pages.filter(bad)


def cap_pages(pages: DataFrame, cap: int | None = None) -> DataFrame:
    """Pages up to the total the first page announces, at most ``cap`` per team and season if a quota sets one.

    Where the first page is missing or announces nothing, the pages that exist stay.
    """
    announced = pages.filter(F.col("page") == 1).groupBy("team", "season").agg(F.max("paging.total").alias("__total"))
    allowed = pages if cap is None else pages.filter(F.col("page") <= cap)
    return allowed.join(announced, ["team", "season"], "left") \
        .filter(F.col("__total").isNull() | (F.col("page") <= F.col("__total"))).drop("__total")


def league_teams(spark: SparkSession, league_ids: Sequence[int], seasons: Sequence[int],
                 team_pages: DataFrame | None = None,
                 fixed: Mapping[int, Sequence[int]] | None = None) -> DataFrame:
    """Which league listed a team in a season: ``league, season, team, league_idx, team_idx``.

    A league with a fixed team list uses it for every season; the others come from the
    cached team responses.
    """
    fixed = {config.DEFAULT_LEAGUE: config.DEFAULT_LEAGUE_TEAMS} if fixed is None else fixed
    schema = "league INT, season INT, team BIGINT, league_idx INT, team_idx INT"
    order = {league: i for i, league in enumerate(league_ids)}
    rows = [(league, season, team, order[league], i)
            for league in league_ids if league in fixed for season in seasons
            for i, team in enumerate(fixed[league])]
    listed = spark.createDataFrame(rows, schema)
    dynamic = [league for league in league_ids if league not in fixed]
    if dynamic and team_pages is not None:
        index = F.create_map(*[F.lit(x) for league in dynamic for x in (league, order[league])])
        found = split_errors(team_pages)[0].filter(F.col("league").isin(dynamic) & F.col("season").isin(list(seasons)))
        listed = listed.unionByName(found.select(
            "league", "season", F.posexplode("response").alias("team_idx", "entry"),
        ).select("league", "season", F.col("entry.team.id").alias("team"),
                 index[F.col("league")].alias("league_idx"), "team_idx"))
    return listed


def has_league(statistics: Column, league: Column) -> Column:
    return F.exists(statistics, lambda s: s["league"]["id"] == league)


def only_league(statistics: Column, league: Column) -> Column:
    return F.filter(statistics, lambda s: s["league"]["id"] == league)


def player_records(pages: DataFrame, owners: DataFrame, season_order: Sequence[int] | None = None,
                   page_cap: int | None = None) -> DataFrame:
    """One row per player record with its statistics trimmed to the league that listed the team.

    ``rec_ord`` reproduces the order in which the source would be walked: seasons, leagues,
    teams, pages, records.
    """
    season_idx = F.col("season") if season_order is None else F.array_position(
        F.array(*[F.lit(s) for s in season_order]), F.col("season")).cast("int")
    usable = split_errors(pages)[0]
    owned = cap_pages(usable, page_cap).join(owners, ["team", "season"])
    records = owned.select(
        "season", F.col("league").alias("league_id"), season_idx.alias("season_idx"), "league_idx", "team_idx",
        "page", F.posexplode("response").alias("pos", "record"))
    mine = has_league(F.col("record.statistics"), F.col("league_id"))
    return records.filter(mine).select(
        "season", "league_id", F.col("record.player").alias("player"),
        only_league(F.col("record.statistics"), F.col("league_id")).alias("statistics"),
        F.struct("season_idx", "league_idx", "team_idx", "page", "pos").alias("rec_ord"))


def load_statistics(spark: SparkSession, directory: str, seasons: Sequence[int] | None = None,
                    league_ids: Sequence[int] | None = None, multiline: bool = True,
                    fixed_teams: Mapping[int, Sequence[int]] | None = None,
                    files: str = "{endpoint}_*.json", page_cap: int | None = None) -> DataFrame:
    """All cached player records of the seasons and leagues in one distributed scan.

    ``files`` is the name pattern of one endpoint; exports of ``write_pages`` use ``EXPORTED``.
    """
    seasons = list(seasons or config.DEFAULT_SEASONS)
    league_ids = list(league_ids or [config.DEFAULT_LEAGUE])
    fixed = {config.DEFAULT_LEAGUE: config.DEFAULT_LEAGUE_TEAMS} if fixed_teams is None else fixed_teams
    team_pages = None
    if any(league not in fixed for league in league_ids):
        team_pages = scan_pages(spark, f"{directory}/{files.format(endpoint='teams')}", TEAM_PAGE, multiline)
    owners = league_teams(spark, league_ids, seasons, team_pages, fixed)
    pages = scan_pages(spark, f"{directory}/{files.format(endpoint='players')}", PLAYER_PAGE, multiline)
    pages = pages.drop("league").filter(F.col("season").isin(seasons))
    return player_records(pages, owners, seasons, page_cap)


def write_pages(pages: DataFrame, path: str) -> None:
    """Response pages as JSON lines that name their request, below one directory per endpoint and season.

    Rebalancing groups the rows of a season into few files and splits a season that
    holds a large share of them.
    """
    _with_partitions(pages).hint("rebalance", "endpoint", "season").write.mode("append").partitionBy("endpoint", "season").json(path)


def _with_partitions(pages: DataFrame) -> DataFrame:
    return pages.withColumn("endpoint", F.regexp_extract("request", r"^([a-z]+)_", 1)) \
        .withColumn("season", request_params(F.col("request"))["season"])


def refresh_pages(pages: DataFrame, path: str) -> None:
    """Merge new responses into the cache that ``write_pages`` keeps at ``path``; every season that has new ones is left with one response per request.

    A usable response replaces an error, never the other way round. Of two alike the newer one stays: the new ones before what is stored, later files before earlier
    ones, and of those of one time always the same. Only the folders of these seasons are read and replaced, when the job commits; all others keep their files.
    Stored responses are kept as text, with fields that no schema names. Lines that name no request stay, equal ones once.
    """
    spark = pages.sparkSession
    fresh = _with_partitions(pages)
    with scratch_tables(spark):
        fresh = materialize(fresh.select("endpoint", "season", F.to_json(F.struct(*pages.columns)).alias("value")), "fresh-pages")
        # One row per folder.
        touched = fresh.select("endpoint", "season").distinct().collect()
        rows = fresh.select("*", F.lit(1).alias("new"), F.lit(0).cast("long").alias("time"))
        if touched and exists(spark, path):
            here = reduce(or_, [F.col("endpoint").eqNullSafe(r.endpoint) & F.col("season").eqNullSafe(r.season) for r in touched])
            rows = rows.unionByName(spark.read.text(path).filter(here).select(
                "endpoint", F.col("season").cast("int").alias("season"), "value", F.lit(0).alias("new"), F.unix_micros("_metadata.file_modification_time").alias("time")))
        usable = ~has_errors(F.get_json_object("value", "$.errors"))
        request = F.coalesce(F.get_json_object("value", "$.request"), F.xxhash64("value").cast("string"))
        merged = rows.groupBy("endpoint", "season", request.alias("request")).agg(
            F.max_by("value", F.struct(usable, "new", "time", F.xxhash64("value"), "value")).alias("value"))
        # Stored before the folders it was read from are replaced.
        merged = materialize(merged.drop("request"), "merged-pages")
        if touched:
            merged.hint("rebalance", "endpoint", "season").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("endpoint", "season").text(path)
