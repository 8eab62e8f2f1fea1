"""Roll-up, feature and window operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora import config
from valora.catalogue.registry import LINE_ORDER, PERFORMANCES_SQL, ROW_ORDER, performances, query, rounded, table
from valora.functions.dates import age_at_season_end
from valora.functions.numeric import lookup, one_hot, one_hot_label, per90, ratio
from valora.functions.text import full_name, normalize_name
from valora.operators import ranks, relational, rollup
from valora.operators.order import row_order
from valora.plans import features as stages
from valora.plans.dataset import build_joined_dataset
from valora.session import materialize
from valora.sources.tables import MarketTables


def _rolled(spark, sf):
    return stages.aggregate_multi_club(performances(spark, sf), ROW_ORDER)


@query("multi_club_rollup", f"""
WITH {PERFORMANCES_SQL}
SELECT id AS api_player_id, season, firstname, lastname, dob, value AS market_value_in_eur,
       line AS goals, qty AS minutes, yellow AS yellow_cards, red AS red_cards, pen AS penalty_goals,
       tax AS assists, round(accuracy, 12) AS passes_accuracy, round(rating, 12) AS rating
FROM rolled""")
def multi_club_rollup(spark, sf):
    return rounded(_rolled(spark, sf), 12, "passes_accuracy", "rating").select(
        "api_player_id", "season", "firstname", "lastname", "dob", "market_value_in_eur", "goals", "minutes",
        "yellow_cards", "red_cards", "penalty_goals", "assists", "passes_accuracy", "rating")


@query("primary_club", """
SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, l_suppkey AS primary_supplier
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey, year(l_shipdate)
  ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) = 1""")
def primary_club(spark, sf):
    line = table(spark, sf, "lineitem").withColumns({"season": F.year("l_shipdate"), "l_quantity": F.col("l_quantity").cast("int")})
    best = rollup.primary_member(line, ["l_suppkey"], "l_quantity", LINE_ORDER[:3])
    return line.groupBy("l_partkey", "season").agg(*best).withColumnRenamed("l_suppkey", "primary_supplier")


@query("team_quality", f"""
WITH {PERFORMANCES_SQL}, team_avg AS (SELECT team, season, avg(value) AS v FROM perf GROUP BY team, season)
SELECT id AS api_player_id, season, r.team AS team_id, round(ln(1 + v), 9) AS log_team_avg_value
FROM rolled r JOIN team_avg USING (team, season)""")
def team_quality(spark, sf):
    rows = performances(spark, sf)
    clubs = rows.groupBy("api_player_id", "season").agg(*rollup.primary_member(rows, ["team_id"], "minutes", ROW_ORDER))
    quality = rollup.group_mean(rows, ["team_id", "season"], "market_value_in_eur", "v")
    return clubs.join(quality, ["team_id", "season"]).select(
        "api_player_id", "season", "team_id", F.round(F.log1p("v"), 9).alias("log_team_avg_value"))


@query("per90_rates", f"""
WITH {PERFORMANCES_SQL}
SELECT id AS api_player_id, season, round(line / (nullif(qty, 0) / 90.0), 9) AS goals_p90,
       round(greatest(line - coalesce(pen, 0), 0) / (nullif(qty, 0) / 90.0), 9) AS np_goals_p90,
       round(line / CAST(nullif(qty, 0) AS DOUBLE), 9) AS duels_won_pct,
       round(drib_ok / CAST(nullif(tax, 0) AS DOUBLE), 9) AS dribble_success_pct
FROM rolled""")
def per90_rates(spark, sf):
    df = _rolled(spark, sf).withColumn("np_goals", stages.non_penalty_goals())
    return df.select(
        "api_player_id", "season", F.round(per90(F.col("goals"), F.col("minutes")), 9).alias("goals_p90"),
        F.round(per90(F.col("np_goals"), F.col("minutes")), 9).alias("np_goals_p90"),
        F.round(ratio(F.col("duels_won"), F.col("duels_total")), 9).alias("duels_won_pct"),
        F.round(ratio(F.col("dribbles_success"), F.col("dribbles_attempts")), 9).alias("dribble_success_pct"))


_PCT_SQL = """
q AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, sum(l_quantity) AS qty,
             CASE WHEN sum(l_tax) > 0.1 THEN sum(l_linenumber) / sum(l_quantity) END AS rate
      FROM lineitem GROUP BY ALL)
SELECT l_partkey, season, qty, round(rate, 9) AS rate,
  round((rank() OVER (PARTITION BY season ORDER BY qty)
    + (count(*) OVER (PARTITION BY season, qty) - 1) / 2.0) / count(*) OVER (PARTITION BY season), 9) AS qty_pct,
  CASE WHEN rate IS NOT NULL THEN round((rank() OVER (PARTITION BY season ORDER BY rate NULLS LAST)
    + (count(*) OVER (PARTITION BY season, rate) - 1) / 2.0) / count(rate) OVER (PARTITION BY season), 9) END AS rate_pct
FROM q"""


@query("pct_rank_avg", "WITH " + _PCT_SQL)
def pct_rank_avg(spark, sf):
    line = table(spark, sf, "lineitem")
    q = line.groupBy("l_partkey", F.year("l_shipdate").alias("season")).agg(
        F.sum("l_quantity").alias("qty"),
        F.when(F.sum("l_tax") > 0.1, F.sum("l_linenumber") / F.sum("l_quantity")).alias("rate"))
    ranked = ranks.pct_rank(materialize(q, "rates"), ["season"], ["qty", "rate"])
    return rounded(ranked, 9, "rate", "qty_pct", "rate_pct")


@query("season_delta", """
WITH q AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, CAST(sum(l_linenumber) AS BIGINT) AS goals,
                  sum(l_quantity) AS minutes FROM lineitem GROUP BY ALL)
SELECT a.l_partkey, a.season, a.goals, a.minutes, a.goals - b.goals AS delta_goals,
       a.minutes - b.minutes AS delta_minutes
FROM q a LEFT JOIN q b ON a.l_partkey = b.l_partkey AND a.season = b.season + 1""")
def season_delta(spark, sf):
    q = table(spark, sf, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("season")).agg(
        F.sum("l_linenumber").alias("goals"), F.sum("l_quantity").alias("minutes"))
    return relational.period_delta(q, ["l_partkey"], "season", ["goals", "minutes"])


@query("position_filter", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'DEF' WHEN 'SMALL' THEN 'MID' ELSE 'FWD' END AS position_group
FROM part WHERE lower(p_type) <> 'promo' AND p_type IN ('ECONOMY', 'SMALL', 'MEDIUM', 'LARGE')""")
def position_filter(spark, sf):
    groups = {"economy": "DEF", "small": "MID", "medium": "FWD", "large": "FWD"}
    kept = relational.keep_other_than(table(spark, sf, "part"), "p_type", "Promo")
    return kept.select("p_partkey", lookup(F.lower("p_type"), groups).alias("position_group")) \
        .filter("position_group IS NOT NULL")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{p}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"prio_{p[0]}\"" for p in _PRIORITIES)
    + " FROM orders")
def one_hot_priority(spark, sf):
    columns = one_hot(F.col("o_orderpriority"), _PRIORITIES, "")
    return table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(f"prio_{name[0]}") for name, c in columns.items()])


@query("one_hot_inverse", "SELECT o_orderkey, o_orderpriority[1:1] AS priority FROM orders")
def one_hot_inverse(spark, sf):
    dummies = one_hot_priority(spark, sf)
    names = relational.columns_with(dummies, prefix="prio_")
    return dummies.select("o_orderkey", one_hot_label(names, "prio_").alias("priority"))


@query("age_round", """
SELECT o_orderkey, round_even(date_diff('day', CAST(o_orderdate AS DATE),
         make_date(CAST(year(o_orderdate) + 1 + o_custkey % 7 AS INTEGER), 6, 30)) / 365.25::DOUBLE, 1) AS age
FROM orders""")
def age_round(spark, sf):
    season = F.year("o_orderdate") + F.col("o_custkey") % 7
    return table(spark, sf, "orders").select(
        "o_orderkey", age_at_season_end(F.col("o_orderdate").cast("date"), season).alias("age"))


_P90 = {
    "goals": "line", "np_goals": "greatest(line - coalesce(pen, 0), 0)", "assists": "tax", "shots_total": "qty",
    "shots_on": "line", "passes_total": "qty", "passes_key": "line", "tackles": "disc", "interceptions": "tax",
    "dribbles_attempts": "tax", "dribbles_success": "drib_ok", "fouls_drawn": "disc", "fouls_committed": "tax",
}


def _pct_sql(column: str, group: str) -> str:
    return (f"round((rank() OVER (PARTITION BY {group} ORDER BY {column}) + "
            f"(count(*) OVER (PARTITION BY {group}, {column}) - 1) / 2.0) / count(*) OVER (PARTITION BY {group}), 9)")


_STAGE5_SQL = f"""
WITH {PERFORMANCES_SQL},
aged AS (
  SELECT *, round_even(date_diff('day', dob, make_date(season + 1, 6, 30)) / 365.25::DOUBLE, 1) AS age
  FROM rolled WHERE pos IS NOT NULL
),
team_avg AS (SELECT team, season, avg(value) AS v FROM perf GROUP BY team, season),
base AS (
  SELECT a.*, CASE WHEN pos = 'FWD' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS fwd,
         line / (qty / 90.0::DOUBLE) AS g90, tax / (qty / 90.0::DOUBLE) AS a90,
         (line + tax) / (qty / 90.0::DOUBLE) AS gi90, ln(1 + v) AS log_team
  FROM aged a JOIN team_avg USING (team, season)
)
SELECT b.id AS api_player_id, b.season, b.id AS tm_player_id, b.value AS market_value_in_eur, b.age, b.qty AS minutes,
  b.line AS appearances,
  {", ".join(f"round(({e}) / (b.qty / 90.0::DOUBLE), 9) AS {c}_p90".replace("line", "b.line").replace("tax", "b.tax")
             .replace("(qty)", "(b.qty)").replace("disc", "b.disc").replace("drib_ok", "b.drib_ok").replace("pen", "b.pen")
             for c, e in _P90.items())},
  round(b.accuracy, 12) AS passes_accuracy, round(b.line / b.qty::DOUBLE, 9) AS duels_won_pct,
  round(b.line / b.qty::DOUBLE, 9) AS shot_accuracy,
  round(b.drib_ok / CAST(nullif(b.tax, 0) AS DOUBLE), 9) AS dribble_success_pct, round(b.rating, 12) AS rating,
  CASE WHEN b.pos = 'DEF' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "pos_DEF", b.fwd AS "pos_FWD",
  CASE WHEN b.pos = 'MID' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "pos_MID",
  round(ln(1 + b.value), 9) AS log_market_value, round(b.age * b.age, 9) AS age_sq,
  {_pct_sql("b.g90", "b.fwd")} AS goals_p90_pct, {_pct_sql("b.a90", "b.fwd")} AS assists_p90_pct,
  {_pct_sql("b.qty", "b.fwd")} AS minutes_pct,
  b.line - p.line AS delta_goals, b.tax - p.tax AS delta_assists, b.qty - p.qty AS delta_minutes,
  round(b.gi90, 9) AS goal_involvement_p90,
  round((b.disc + b.tax + b.line) / (b.qty / 90.0::DOUBLE), 9) AS defensive_actions_p90,
  round(b.qty / b.line::DOUBLE, 9) AS minutes_per_app, round(b.log_team, 9) AS log_team_avg_value,
  b.league AS league_id,
  {", ".join(f"CASE WHEN b.league = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS league_{i}" for i in range(5))},
  round(b.age - CASE b.pos WHEN 'DEF' THEN 28 WHEN 'MID' THEN 27 ELSE 25 END, 9) AS age_vs_pos_peak,
  round(greatest(30 - b.age, 0), 9) AS years_to_30,
  CASE WHEN b.age < 23 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_young,
  round(b.age * b.gi90, 9) AS age_x_goal_inv, round(b.age * b.qty, 9) AS age_x_minutes
FROM base b LEFT JOIN rolled p ON p.id = b.id AND p.season = b.season - 1"""


@query("stage_features", _STAGE5_SQL)
def stage_features(spark, sf):
    df = stages.build_stage5(performances(spark, sf), ROW_ORDER, league_ids=range(5))
    floats = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"
              and f.name not in ("market_value_in_eur", "age") and not f.name.startswith(("pos_", "league_"))]
    fine = ["passes_accuracy", "rating"]  # exact binary fractions tie at fewer digits
    return rounded(rounded(df, 9, *[c for c in floats if c not in fine]), 12, *fine)


@query("rate_leaders", """
WITH q AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, CAST(sum(l_linenumber) AS BIGINT) AS goals,
                  sum(l_quantity) AS minutes FROM lineitem GROUP BY ALL),
r AS (SELECT *, (rank() OVER (PARTITION BY season ORDER BY goals / (nullif(minutes, 0) / 90))
   + (count(*) OVER (PARTITION BY season, goals / (nullif(minutes, 0) / 90)) - 1) / 2.0)
   / count(*) OVER (PARTITION BY season) AS pct FROM q)
SELECT l_partkey, season, goals, minutes, round(goals / (nullif(minutes, 0) / 90), 9) AS goals_p90, round(pct, 9) AS goals_p90_pct
FROM r ORDER BY pct DESC, season, l_partkey LIMIT 25""")
def rate_leaders(spark, sf):
    """Scan, roll-up, rate, percentile rank and top-k in one query."""
    line = table(spark, sf, "lineitem")
    rolled = rollup.rollup(
        line.withColumn("season", F.year("l_shipdate")), ["l_partkey", "season"], [],
        ["l_linenumber", "l_quantity"], [], ["l_orderkey"]).select(
        "l_partkey", "season", F.col("l_linenumber").alias("goals"), F.col("l_quantity").alias("minutes"))
    # Stored once: the ranks read the rates twice, the raw rows only once.
    rates = materialize(rolled.withColumn("goals_p90", per90(F.col("goals"), F.col("minutes"))), "rates")
    top = relational.top_k(ranks.pct_rank(rates, ["season"], ["goals_p90"]), 25, "goals_p90_pct",
                           ["season", "l_partkey"])
    return rounded(top, 9, "goals_p90_pct").withColumn("goals_p90", F.round("goals_p90", 9))


_DATED_SQL = """
dated AS (SELECT l_partkey AS id, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS v FROM lineitem)"""


def _valuations(spark, sf):
    """Every line is a dated value of its part."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("player_id"), F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_extendedprice").alias("market_value_in_eur"))


@query("value_history", f"""
WITH {PERFORMANCES_SQL}, {_DATED_SQL},
snaps AS (
  SELECT r.id, r.season, k.shift, d.v FROM rolled r CROSS JOIN (VALUES (0), (-1)) k(shift)
  JOIN dated d ON d.id = r.id AND d.d <= make_date(r.season + k.shift, 7, 1)
  QUALIFY row_number() OVER (PARTITION BY r.id, r.season, k.shift ORDER BY d.d DESC, d.v) = 1)
SELECT r.id AS api_player_id, r.season, round(ln(1 + a.v), 9) AS log_tm_prev_value,
       round(ln(1 + a.v) - ln(1 + b.v), 9) AS tm_value_trend
FROM rolled r LEFT JOIN snaps a ON a.id = r.id AND a.season = r.season AND a.shift = 0
LEFT JOIN snaps b ON b.id = r.id AND b.season = r.season AND b.shift = -1 WHERE r.pos IS NOT NULL""")
def value_history(spark, sf):
    df = stages.build_stage3(performances(spark, sf), _valuations(spark, sf), ROW_ORDER, with_delta=False)
    return rounded(df.select("api_player_id", "season", "log_tm_prev_value", "tm_value_trend"), 9,
                   "log_tm_prev_value", "tm_value_trend")


@query("joined_dataset", f"""
WITH {_DATED_SQL},
ids AS (SELECT p_name, p_size, max(p_partkey) AS tm FROM part GROUP BY ALL),
links AS (SELECT p_partkey AS id, tm FROM part JOIN ids USING (p_name, p_size) WHERE p_type <> 'STANDARD'),
seasons AS (SELECT DISTINCT tm, CAST(year(l_shipdate) AS INTEGER) AS season FROM lineitem JOIN links ON id = l_partkey),
snapped AS (
  SELECT s.tm, s.season, d.v FROM seasons s JOIN dated d ON d.id = s.tm
  QUALIFY row_number() OVER (PARTITION BY s.tm, s.season
    ORDER BY abs(date_diff('day', d.d, make_date(s.season + 1, 7, 1))), d.d, d.v) = 1)
SELECT l_partkey AS api_player_id, season, tm AS tm_player_id, v AS market_value_in_eur, count(*) AS rows_joined,
       CAST(sum(l_linenumber) AS BIGINT) AS goals
FROM lineitem JOIN links ON id = l_partkey JOIN snapped USING (tm) WHERE season = year(l_shipdate) GROUP BY ALL""")
def joined_dataset(spark, sf):
    """Flat rows, market players and dated values through crosswalk and nearest value."""
    rows = performances(spark, sf).drop("tm_player_id", "market_value_in_eur")
    rows = rows.withColumns({
        "full_name_norm": normalize_name(full_name(F.col("firstname"), F.col("lastname"))),
        "last_name_norm": normalize_name(F.col("lastname")), "rec_ord": row_order(rows, ROW_ORDER)})
    players = table(spark, sf, "part").select(
        F.col("p_partkey").alias("player_id"), full_name(F.col("p_name"), F.col("p_brand")).alias("name"),
        F.col("p_brand").alias("last_name"),
        F.date_add(F.lit("1972-01-01").cast("date"), F.col("p_size") * 211).alias("date_of_birth"))
    joined = build_joined_dataset(rows, MarketTables(players, _valuations(spark, sf), None, None))
    return joined.groupBy("api_player_id", "season", "tm_player_id", "market_value_in_eur").agg(
        F.count("*").alias("rows_joined"), F.sum("goals").alias("goals"))


@query("feature_counts", "SELECT * FROM (VALUES ('stage1', 10), ('stage2', 24), ('stage3', 31), ('stage4', 41), "
       "('stage5', 46)) t(stage, features), (SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey, year(l_shipdate) "
       "FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type NOT IN ('STANDARD', 'PROMO')))")
def feature_counts(spark, sf):
    """Rows and number of features of each stage."""
    rows = performances(spark, sf)
    rolled = stages.stored_rollup(rows, ROW_ORDER)
    counts = None
    for name, build in stages.STAGES.items():
        built = build(rows, order_cols=ROW_ORDER, rolled=rolled)
        features = len([c for c in built.columns if c not in config.ID_COLUMNS])
        one = built.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), F.lit(features).alias("features"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts
