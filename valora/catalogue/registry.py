"""Registration of queries and the mapping of driver tables onto the operators' roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from valora.operators.order import Bits
from valora.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round float outputs: summation order differs between engines."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Raw part types standing for positions; STANDARD and PROMO stay unmapped.
POSITION_OF_TYPE = {
    "ECONOMY": "Defender", "SMALL": "Midfielder", "MEDIUM": "Attacker", "LARGE": "Forward",
    "STANDARD": "Goalkeeper", "PROMO": "",
}

# A total order on lineitem rows. The lines of one part need no price: no two of them share the other columns.
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
LINE_ORDER = [Bits("l_orderkey", 40), Bits("l_linenumber", 4), Bits("l_suppkey", 30), "l_extendedprice"]
ROW_ORDER = [Bits("o1", 40), Bits("o2", 4), Bits("o3", 30)]


def performances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as player-season-club rows: part = player, ship year = season,
    supplier = club, region of the supplier = league."""
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    raw_position = F.create_map(*[F.lit(x) for kv in POSITION_OF_TYPE.items() for x in kv])[F.col("p_type")]
    # Stored: Spark takes the size of a join to be the product of its sides, and would shuffle all lines to meet the few suppliers.
    league = materialize(supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                         .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("league_id")), "leagues")
    people = part.select(
        F.col("p_partkey").alias("l_partkey"), *[F.coalesce(c, F.lit("")).alias(n) for n, c in (
            ("firstname", F.col("p_name")), ("lastname", F.col("p_brand")), ("position", raw_position))],
        F.date_add(F.lit("1972-01-01").cast("date"), F.col("p_size") * 211).alias("dob"))
    whole = lambda c: F.rint(F.col(c) * 100).cast("int")
    quantity, line = F.col("quantity"), F.col("l_linenumber")
    # The columns of the table meet the people, not the many that are made of them; by part last, which rows are then grouped by.
    rows = table(spark, sf_dir, "lineitem").select(
        *LINE_COLUMNS, "l_partkey", F.year("l_shipdate").alias("season"), F.col("l_quantity").cast("int").alias("quantity"),
        "l_tax", "l_discount", "l_returnflag", "l_linestatus")
    return rows.join(league, "l_suppkey", "left").join(people, "l_partkey").select(
        F.col("l_partkey").alias("api_player_id"), F.col("l_suppkey").alias("team_id"),
        F.col("l_partkey").alias("tm_player_id"), F.lit("").alias("nationality"), "season",
        F.col("l_extendedprice").alias("market_value_in_eur"),
        line.alias("appearances"), quantity.alias("minutes"), line.alias("goals"), whole("l_tax").alias("assists"),
        F.when(F.col("l_returnflag") == "A", 1).alias("yellow_cards"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("red_cards"),
        quantity.alias("shots_total"), line.alias("shots_on"), quantity.alias("passes_total"),
        line.alias("passes_key"), whole("l_discount").alias("tackles"), whole("l_tax").alias("interceptions"),
        line.alias("blocks"), quantity.alias("duels_total"), line.alias("duels_won"),
        whole("l_tax").alias("dribbles_attempts"), F.least(whole("l_tax"), line).alias("dribbles_success"),
        whole("l_discount").alias("fouls_drawn"), whole("l_tax").alias("fouls_committed"),
        F.when(F.col("l_linestatus") == "O", 1).alias("penalty_goals"),
        F.col("l_discount").alias("passes_accuracy"),
        F.when(F.col("l_returnflag") != "N", F.col("l_discount") * 10).alias("rating"),
        *[F.col(c).alias(f"o{i + 1}") for i, c in enumerate(LINE_COLUMNS[:3])],
        *[c for c in people.columns if c != "l_partkey"], "league_id")


# The same mapping in SQL, for the oracles.
PERFORMANCES_SQL = """
perf AS (
  SELECT l_partkey AS id, CAST(year(l_shipdate) AS INTEGER) AS season, l_suppkey AS team,
         n_regionkey AS league, p_type, p_name, p_brand,
         CAST(DATE '1972-01-01' + CAST(p_size * 211 AS INTEGER) AS DATE) AS dob,
         CASE p_type WHEN 'ECONOMY' THEN 'DEF' WHEN 'SMALL' THEN 'MID' WHEN 'MEDIUM' THEN 'FWD'
                     WHEN 'LARGE' THEN 'FWD' END AS pos,
         l_extendedprice AS value, l_linenumber AS line, CAST(l_quantity AS INTEGER) AS qty,
         CAST(round(l_tax * 100) AS INTEGER) AS tax, CAST(round(l_discount * 100) AS INTEGER) AS disc,
         l_discount AS accuracy, CASE WHEN l_returnflag <> 'N' THEN l_discount * 10 END AS rating,
         CASE WHEN l_returnflag = 'A' THEN 1 END AS yellow,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS red,
         CASE WHEN l_linestatus = 'O' THEN 1 END AS pen,
         least(CAST(round(l_tax * 100) AS INTEGER), l_linenumber) AS drib_ok,
         row_number() OVER (PARTITION BY l_partkey, year(l_shipdate)
                            ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS ord
  FROM lineitem JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
),
rolled AS (
  SELECT id, season, min(p_name) AS firstname, min(p_brand) AS lastname, min(dob) AS dob, min(pos) AS pos,
         arg_min(value, ord) AS value, CAST(sum(line) AS BIGINT) AS line, CAST(sum(qty) AS BIGINT) AS qty,
         CAST(sum(tax) AS BIGINT) AS tax, CAST(sum(disc) AS BIGINT) AS disc,
         CAST(sum(yellow) AS BIGINT) AS yellow, CAST(sum(red) AS BIGINT) AS red,
         CAST(sum(pen) AS BIGINT) AS pen, CAST(sum(drib_ok) AS BIGINT) AS drib_ok,
         CASE WHEN sum(qty) > 0 THEN coalesce(sum(accuracy * qty), 0) / sum(qty) END AS accuracy,
         CASE WHEN sum(qty) > 0 THEN sum(rating * qty) / sum(qty) END AS rating,
         arg_min(team, -qty * 1000000.0 + ord) AS team, arg_min(league, -qty * 1000000.0 + ord) AS league
  FROM perf GROUP BY id, season
)
"""
