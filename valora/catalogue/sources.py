"""Source and sink operators: files are written from whole driver tables and read back."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from valora.catalogue.registry import query, table
from valora.functions.numeric import parse_number
from valora.plans import dataset
from valora.session import scratch_dir
from valora.sources import pages, tables


@query("json_explode", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, e.pos, e.league, e.amount FROM (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, unnest([
    {'pos': 0, 'league': CAST(l_linenumber % 3 AS INTEGER), 'amount': l_quantity},
    {'pos': 1, 'league': CAST(l_suppkey % 3 AS INTEGER), 'amount': l_tax},
    {'pos': 2, 'league': 1, 'amount': l_discount}]) AS e FROM lineitem)
WHERE e.league = 1""")
def json_explode(spark, sf):
    """Nested entries through JSON text, filtered inside the array, then one row per entry."""
    line = table(spark, sf, "lineitem")

    def entry(pos, league, amount):
        return F.struct(F.lit(pos).alias("pos"), F.struct(league.cast("int").alias("id")).alias("league"),
                        F.struct(amount.alias("amount")).alias("games"))

    statistics = F.array(entry(0, F.col("l_linenumber") % 3, F.col("l_quantity")),
                         entry(1, F.col("l_suppkey") % 3, F.col("l_tax")),
                         entry(2, F.lit(1), F.col("l_discount")))
    schema = "ARRAY<STRUCT<pos: INT, league: STRUCT<id: INT>, games: STRUCT<amount: DOUBLE>>>"
    keys = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    packed = line.select(*keys, F.to_json(statistics).alias("text"))
    parsed = packed.select(*keys, F.from_json("text", schema).alias("statistics"))
    mine = parsed.select(*keys, pages.only_league(F.col("statistics"), F.lit(1)).alias("statistics"))
    # The inner form would infer "array not empty" and parse the text again to test it.
    return mine.select(*keys, F.posexplode_outer("statistics").alias("i", "s")).filter("s IS NOT NULL").select(
        *keys, "s.pos", F.col("s.league.id").alias("league"), F.col("s.games.amount").alias("amount"))


_LEAGUES = [1, 2]


def _response_pages(orders):
    """Orders as response pages: status = team, year = season, priority = page. Every row is
    a page line with one record of two entries, so no group is collected."""
    season = F.year("o_orderdate")
    team = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    page = F.left("o_orderpriority", F.lit(1)).cast("int")
    league = (F.col("o_custkey") % 2 + 1).cast("int")

    def entry(league_id, minutes):
        return F.struct(
            F.struct(team.cast("long").alias("id"), F.col("o_orderstatus").alias("name")).alias("team"),
            F.struct(league_id.alias("id")).alias("league"),
            F.struct(minutes.cast("int").alias("minutes"), (minutes % 10).cast("string").alias("rating")).alias("games"))

    minutes = F.floor(F.col("o_totalprice") / 1000)
    record = F.struct(F.struct(F.col("o_orderkey").alias("id")).alias("player"),
                      F.array(entry(league, minutes), entry(F.lit(2), minutes + 1)).alias("statistics"))
    failed = (team == 3) & (season == 1997) & (page == 1)
    return orders.select(
        pages.request_slug_column("players", team=team, season=season, page=page).alias("request"),
        F.when(failed, '{"rateLimit":"exceeded"}').otherwise("[]").alias("errors"),
        F.struct(F.when(season == 1996, 2).otherwise(5).alias("total")).alias("paging"),
        F.array(record).alias("response"))


def _team_pages(spark):
    rows = [(pages.request_slug("teams", league=league, season=season), "[]", [((team,),) for team in teams])
            for season in range(1995, 2003) for league, teams in ((1, [1, 3]), (2, [2]))]
    return spark.createDataFrame(rows, "request STRING, " + pages.TEAM_PAGE)


def _cached_orders(spark, sf) -> str:
    path = scratch_dir(spark, "pages")
    pages.write_pages(_response_pages(table(spark, sf, "orders")), path)
    pages.write_pages(_team_pages(spark), path)
    return path


_PAGED_SQL = """
o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(o_orderpriority[1:1] AS INTEGER) AS page,
             CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS team,
             CAST(o_custkey % 2 + 1 AS INTEGER) AS first_league, CAST(floor(o_totalprice / 1000) AS INTEGER) AS minutes
      FROM orders),
usable AS (SELECT * FROM o WHERE NOT (team = 3 AND season = 1997 AND page = 1)),
announced AS (SELECT DISTINCT team, season, CASE WHEN season = 1996 THEN 2 ELSE 5 END AS total FROM usable WHERE page = 1),
kept AS (SELECT usable.*, CASE WHEN usable.team = 2 THEN 2 ELSE 1 END AS league FROM usable
         LEFT JOIN announced USING (team, season) WHERE total IS NULL OR page <= total),
entries AS (
  SELECT season, league, o_orderkey, page, 0 AS entry_no, minutes FROM kept WHERE first_league = league
  UNION ALL SELECT season, league, o_orderkey, page, 1, minutes + 1 FROM kept WHERE league = 2)"""


@query("paged_scan", f"""
WITH {_PAGED_SQL}
SELECT season, league AS league_id, o_orderkey AS player_id, page, minutes, CAST(minutes % 10 AS DOUBLE) AS rating
FROM entries""")
def paged_scan(spark, sf):
    """Cached pages of all teams and seasons: error pages set aside (one team-season lost its first page), announced totals, league ownership."""
    path = _cached_orders(spark, sf)
    records = pages.load_statistics(spark, path, seasons=range(1995, 2003), league_ids=_LEAGUES, multiline=False,
                                    fixed_teams={}, files=pages.EXPORTED)
    return records.select("season", "league_id", "player.id", "rec_ord.page", F.explode("statistics").alias("s")).select(
        "season", "league_id", F.col("id").alias("player_id"), "page", F.col("s.games.minutes").alias("minutes"),
        parse_number(F.col("s.games.rating")).alias("rating"))


@query("page_quarantine", """
SELECT CAST(count(*) FILTER (o_orderstatus = 'P' AND year(o_orderdate) = 1997 AND o_orderpriority = '1-URGENT') AS BIGINT) AS failed,
       CAST(count(*) FILTER (NOT (o_orderstatus = 'P' AND year(o_orderdate) = 1997 AND o_orderpriority = '1-URGENT')) AS BIGINT) AS usable
FROM orders""")
def page_quarantine(spark, sf):
    scanned = pages.scan_pages(spark, f"{_cached_orders(spark, sf)}/{pages.EXPORTED.format(endpoint='players')}",
                               multiline=False)
    return scanned.agg(F.count_if(pages.has_errors(F.col("errors"))).alias("failed"),
                       F.count_if(~pages.has_errors(F.col("errors"))).alias("usable"))


_REFRESH_SQL = """
o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(floor(o_totalprice / 1000) AS INTEGER) AS minutes FROM orders),
m AS (SELECT o_orderkey, season, season <= 1995 AND (o_orderkey % 2 = 0 OR o_orderkey % 7 = 0) AS asked, o_orderkey % 7 <> 0 AS stored,
             o_orderkey % 5 = 0 AS was_error, o_orderkey % 3 = 0 AS is_error, minutes FROM o)"""


@query("page_refresh", f"""
WITH {_REFRESH_SQL}
SELECT season, o_orderkey AS page, asked AND NOT stored AS added, minutes + CASE WHEN asked AND NOT is_error THEN 1 ELSE 0 END AS minutes
FROM m WHERE CASE WHEN asked AND NOT is_error THEN true WHEN stored THEN NOT was_error ELSE false END""")
def page_refresh(spark, sf):
    """A cache of one page per order, refreshed in some seasons: error pages replaced, newer responses, late pages added; new errors replace nothing."""
    orders = table(spark, sf, "orders")
    season, key = F.year("o_orderdate"), F.col("o_orderkey")
    request = pages.request_slug_column("players", team=F.lit(1), season=season, page=key)
    minutes = F.floor(F.col("o_totalprice") / 1000).cast("int")

    def responses(rows, failed, value):
        entry = F.struct(F.struct(value.alias("minutes")).alias("games"))
        return rows.select(request.alias("request"), F.when(failed, '{"rateLimit":"exceeded"}').otherwise("[]").alias("errors"),
                           F.array(F.struct(F.struct(key.alias("id")).alias("player"), F.array(entry).alias("statistics"))).alias("response"))

    path = scratch_dir(spark, "refreshed")
    pages.write_pages(responses(orders.filter(key % 7 != 0), key % 5 == 0, minutes), path)
    pages.refresh_pages(responses(orders.filter((season <= 1995) & ((key % 2 == 0) | (key % 7 == 0))), key % 3 == 0, minutes + 1), path)
    scanned = pages.scan_pages(spark, f"{path}/{pages.EXPORTED.format(endpoint='players')}", multiline=False)
    usable = pages.split_errors(scanned)[0].select("season", "page", F.explode("response").alias("record"))
    return usable.select("season", F.col("page").cast("long").alias("page"), ((F.col("page") % 7 == 0) & (F.col("season") <= 1995)).alias("added"),
                         F.get("record.statistics", F.lit(0)).games.minutes.alias("minutes"))


_TEAMS, _KEYS_A_PAGE = 40, 100_000


def _page_documents(orders):
    """(name, value): orders as response pages of the client, one indented document each; team, year and a range of order keys make a page, so none grows with the table."""
    team, season, page = F.col("o_custkey") % _TEAMS, F.year("o_orderdate"), F.floor(F.col("o_orderkey") / _KEYS_A_PAGE) + 1
    key, minutes = F.col("o_orderkey"), F.floor(F.col("o_totalprice") / 1000).cast("int")

    def entry(league, played):
        return F.struct(
            F.struct(team.cast("long").alias("id"), F.col("o_orderstatus").alias("name")).alias("team"), F.struct(league.alias("id")).alias("league"),
            F.struct((played % 38).alias("appearences"), played.alias("minutes"), F.when(key % 3 == 0, "Attacker").when(key % 3 == 1, "Defender").alias("position"),
                     F.when(key % 4 > 0, F.concat((played % 10).cast("string"), F.lit(".5"))).alias("rating")).alias("games"),
            F.struct(F.when(key % 2 == 0, played % 7).alias("total")).alias("goals"), F.struct((key % 3).cast("int").alias("yellow")).alias("cards"),
            F.struct((key % 100).cast("double").alias("accuracy")).alias("passes"))

    born = F.when(key % 9 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    player = F.struct(key.alias("id"), F.when(F.col("o_orderstatus") != "P", "Zoë").alias("firstname"), F.concat(F.lit("Öst "), "o_orderstatus").alias("lastname"),
                      F.struct(born.alias("date")).alias("birth"))
    league = F.when(key % 2 == 0, 1).otherwise(2)
    record = F.struct(key.alias("at"), F.struct(player.alias("player"), F.array(entry(league, minutes), entry(F.lit(1), minutes + 1)).alias("statistics")).alias("record"))
    grouped = orders.groupBy(team.alias("team"), season.alias("season"), page.alias("page")).agg(F.array_sort(F.collect_list(record)).alias("rows"))
    failed = (F.col("team") == 3) & (F.col("season") == 1997) & (F.col("page") == 1)
    return grouped.select(
        pages.request_slug_column("players", **{k: F.col(k) for k in ("page", "season", "team")}).alias("name"),
        F.concat(F.lit('{\n  "errors": '), F.when(failed, '{"rateLimit": "exceeded"}').otherwise("[]"), F.lit(',\n  "paging": {"total": '),
                 F.when(F.col("season") == 1996, 1).otherwise(100).cast("string"), F.lit('},\n  "response": '), F.to_json("rows.record"), F.lit("\n}")).alias("value"))


@query("flat_rows", f"""
WITH o AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS INTEGER) AS season, o_custkey % {_TEAMS} AS team, o_orderkey // {_KEYS_A_PAGE} + 1 AS page, o_orderstatus AS st,
                  CAST(floor(o_totalprice / 1000) AS INTEGER) AS minutes, CAST(o_orderdate AS DATE) AS born FROM orders),
usable AS (SELECT * FROM o WHERE NOT (team = 3 AND season = 1997 AND page = 1)),
announced AS (SELECT DISTINCT team, season, CASE WHEN season = 1996 THEN 1 ELSE 100 END AS total FROM usable WHERE page = 1),
kept AS (SELECT usable.* FROM usable LEFT JOIN announced USING (team, season) WHERE total IS NULL OR page <= total),
e AS (SELECT *, minutes AS played FROM kept WHERE k % 2 = 0 UNION ALL SELECT *, minutes + 1 FROM kept)
SELECT k AS api_player_id, season, CASE WHEN st = 'P' THEN '' ELSE 'Zoë' END AS firstname, 'Öst ' || st AS lastname, CASE WHEN k % 9 <> 0 THEN born END AS dob,
       CASE k % 3 WHEN 0 THEN 'Attacker' WHEN 1 THEN 'Defender' ELSE '' END AS position, st AS team_name, team AS team_id, played % 38 AS appearances, played AS minutes,
       CASE WHEN k % 2 = 0 THEN played % 7 END AS goals, CAST(k % 3 AS INTEGER) AS yellow_cards, CAST(k % 100 AS DOUBLE) AS passes_accuracy,
       CASE WHEN k % 4 > 0 THEN played % 10 + 0.5::DOUBLE END AS rating, 1 AS league_id,
       CASE WHEN st = 'P' THEN '' ELSE 'zoe ' END || 'ost ' || lower(st) AS full_name_norm, 'ost ' || lower(st) AS last_name_norm,
       CAST(row_number() OVER (PARTITION BY season, team ORDER BY page, k, played) AS INTEGER) AS place
FROM e""")
def flat_rows(spark, sf):
    """Pages as the client writes them, one indented document per file, to flat rows in the order of the source."""
    path = scratch_dir(spark, "documents")
    _page_documents(table(spark, sf, "orders")).write.partitionBy("name").text(path)
    records = pages.load_statistics(spark, path, seasons=range(1990, 2003), league_ids=[1], fixed_teams={1: list(range(_TEAMS))}, files="name={endpoint}_*.json")
    flat = dataset.flatten_players(records)
    order = Window.partitionBy("season", "team_id").orderBy("rec_ord")
    return flat.select("api_player_id", "season", "firstname", "lastname", "dob", "position", "team_name", "team_id", "appearances", "minutes", "goals", "yellow_cards",
                       "passes_accuracy", "rating", "league_id", "full_name_norm", "last_name_norm", F.row_number().over(order).alias("place"))


@query("csv_json_roundtrip", """
SELECT s_suppkey, s_name, s_acctbal, n_name, n_regionkey, CAST(coalesce(k, 0) AS BIGINT) AS customers
FROM supplier JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN (SELECT c_nationkey, count(*) AS k FROM customer GROUP BY ALL) ON c_nationkey = s_nationkey""")
def csv_json_roundtrip(spark, sf):
    """Suppliers through CSV, nations through partitioned Parquet, customers through JSON."""
    path = scratch_dir(spark, "roundtrip")
    tables.write_csv(table(spark, sf, "supplier"), f"{path}/supplier")
    tables.write_table(table(spark, sf, "nation"), f"{path}/nation", ["n_regionkey"])
    table(spark, sf, "customer").write.json(f"{path}/customer")
    supplier = tables.read_csv(spark, f"{path}/supplier",
                               "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")
    nation = tables.read_table(spark, f"{path}/nation", "n_nationkey INT, n_name STRING, n_regionkey INT")
    customer = spark.read.json(f"{path}/customer", schema="c_custkey BIGINT, c_nationkey INT")
    counts = customer.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(counts, F.col("s_nationkey") == F.col("c_nationkey"), "left").select(
        "s_suppkey", "s_name", "s_acctbal", "n_name", "n_regionkey", F.coalesce("customers", F.lit(0)).alias("customers"))
