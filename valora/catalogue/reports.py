"""Metrics, rankings and benchmarks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.catalogue.registry import LINE_COLUMNS, LINE_ORDER, query, rounded, table
from valora.operators import relational
from valora.plans import metrics, report


def _predicted(spark, sf):
    """Log order price and the customer mean as its prediction."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                               F.log1p("o_totalprice").alias("y_true"))
    means = orders.groupBy("o_custkey").agg(F.avg("y_true").alias("y_pred"))
    return orders.join(means, "o_custkey")


_METRICS_SQL = """
p AS (SELECT o_orderpriority, ln(1 + o_totalprice) AS y, avg(ln(1 + o_totalprice)) OVER (PARTITION BY o_custkey) AS q
      FROM orders),
r AS (SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY y)
        + (count(*) OVER (PARTITION BY o_orderpriority, y) - 1) / 2.0 AS ry,
      rank() OVER (PARTITION BY o_orderpriority ORDER BY round(q, 9))
        + (count(*) OVER (PARTITION BY o_orderpriority, round(q, 9)) - 1) / 2.0 AS rq FROM p),
m AS (SELECT o_orderpriority, count(*) AS n, sqrt(avg((y - q) ** 2)) AS rmse_log, avg(abs(y - q)) AS mae_log,
      1 - sum((y - q) ** 2) / (var_pop(y) * count(*)) AS r2_log, corr(ry, rq) AS spearman_log,
      sqrt(avg((exp(y) - exp(q)) ** 2)) AS rmse_eur, avg(abs(exp(y) - exp(q))) AS mae_eur
      FROM r GROUP BY o_orderpriority)"""


@query("regression_metrics", f"""
WITH {_METRICS_SQL}
SELECT o_orderpriority, n AS n_samples, round(rmse_log, 8) AS rmse_log, round(mae_log, 8) AS mae_log,
       round(r2_log, 8) AS r2_log, round(spearman_log, 8) AS spearman_log, round(rmse_eur, 3) AS rmse_eur,
       round(mae_eur, 3) AS mae_eur FROM m""")
def regression_metrics(spark, sf):
    # Means of the same customer may differ in the last bit between tasks; ranks need equal values.
    predicted = _predicted(spark, sf).withColumn("y_pred", F.round("y_pred", 9))
    out = metrics.regression_metrics(predicted, ["o_orderpriority"])
    return rounded(rounded(out, 8, "rmse_log", "mae_log", "r2_log", "spearman_log"), 3, "rmse_eur", "mae_eur")


@query("results_table", f"""
WITH {_METRICS_SQL}
SELECT 's' AS stage, o_orderpriority AS position, 'mean' AS model, n, round_even(r2_log, 3) AS r2,
       round_even(rmse_log, 3) AS rmse_log, round_even(mae_log, 3) AS mae_log,
       round_even(spearman_log, 3) AS spearman, round_even(mae_eur / 1e6, 1) AS mae_eur_m FROM m""")
def results_table(spark, sf):
    predicted = _predicted(spark, sf).select(
        F.lit("mean").alias("model"), F.lit("s").alias("stage"), F.col("o_orderpriority").alias("position"),
        "y_true", F.round("y_pred", 9).alias("y_pred"))
    return metrics.results_table(metrics.regression_metrics(predicted, metrics.RESULT_KEYS))


@query("result_pivot", """
SELECT o_orderstatus, """ + ", ".join(
    f"coalesce(max(n) FILTER (p = '{i}'), 0)::BIGINT AS \"{i}\"" for i in (1, 2, 3, 6)) + """
FROM (SELECT o_orderstatus, o_orderpriority[1:1] AS p, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderstatus""")
def result_pivot(spark, sf):
    counts = table(spark, sf, "orders").groupBy(
        "o_orderstatus", F.left("o_orderpriority", F.lit(1)).alias("p")).agg(F.count("*").alias("n"))
    return metrics.result_pivot(counts, "o_orderstatus", "p", "n", ["1", "2", "3", "6"])


_TRANSFERS_SQL = """
t AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE 0 END AS fee,
      CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 1.25 ELSE 0 END AS market,
      CASE WHEN year(o_orderdate) % 100 < 100 THEN 2000 + year(o_orderdate) % 100 END AS season_year FROM orders),
pred AS (SELECT o_custkey, avg(o_totalprice) AS predicted FROM orders WHERE year(o_orderdate) < 1998 GROUP BY ALL),
paid AS (SELECT * FROM t WHERE fee > 0),
b AS (SELECT CAST(o_orderkey AS VARCHAR) AS player_name, fee / 1e6 AS fee_m, market / 1e6 AS market_m, predicted / 1e6 AS model_m
      FROM paid JOIN pred USING (o_custkey)
      WHERE season_year = (SELECT max(season_year) FROM paid WHERE o_custkey IN (SELECT o_custkey FROM pred)))"""


def _benchmark(spark, sf, ordered=True):
    orders = table(spark, sf, "orders")
    short = lambda y: F.right(y.cast("string"), F.lit(2))
    year, price = F.year("o_orderdate"), F.col("o_totalprice")
    transfers = orders.select(
        F.col("o_custkey").alias("player_id"), F.col("o_orderkey").cast("string").alias("player_name"),
        F.col("o_orderdate").cast("date").alias("transfer_date"),
        F.concat(short(year), F.lit("/"), short(year + 1)).alias("transfer_season"),
        F.col("o_orderstatus").alias("from_club_name"), F.col("o_orderpriority").alias("to_club_name"),
        F.when(F.col("o_orderstatus") == "P", "?").otherwise(price.cast("string")).alias("transfer_fee"),
        F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise((price * 1.25).cast("string"))
        .alias("market_value_in_eur"))
    predictions = orders.filter(year < 1998).groupBy(F.col("o_custkey").alias("tm_player_id")).agg(
        F.avg("o_totalprice").alias("predicted_eur"))
    return report.transfer_benchmark(transfers, predictions, ordered=ordered)


@query("fee_benchmark", f"""
WITH {_TRANSFERS_SQL}
SELECT player_name, round(fee_m, 12) AS actual_fee_M, round(market_m, 12) AS tm_value_M, round(model_m, 12) AS model_value_M,
       round(abs(model_m - fee_m), 12) AS error_model_M, round(abs(market_m - fee_m), 12) AS error_tm_M FROM b""")
def fee_benchmark(spark, sf):
    out = rounded(_benchmark(spark, sf), 12, "actual_fee_M", "tm_value_M", "model_value_M", "error_model_M", "error_tm_M")
    return out.drop("from_club_name", "to_club_name")


@query("benchmark_winner", f"""
WITH {_TRANSFERS_SQL}
SELECT count(*) AS matched, round(avg(abs(model_m - fee_m)), 8) AS mae_model, round(avg(abs(market_m - fee_m)), 8) AS mae_tm,
       CASE WHEN avg(abs(model_m - fee_m)) < avg(abs(market_m - fee_m)) THEN 'MODEL' ELSE 'Transfermarkt' END AS winner FROM b""")
def benchmark_winner(spark, sf):
    return rounded(report.benchmark_winner(_benchmark(spark, sf, ordered=False)), 8, "mae_model", "mae_tm")


_SCORED_SQL = """
s AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS season, avg(l_extendedprice) * 300 AS predicted,
             max(l_extendedprice) * 200 AS actual FROM lineitem GROUP BY ALL),
named AS (SELECT s.*, p_name || ' ' || p_brand AS name FROM s JOIN part ON p_partkey = l_partkey)"""


def _scored(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("season", F.year("l_shipdate"))
    values = line.groupBy(F.col("l_partkey").alias("api_player_id"), "season").agg(
        (F.avg("l_extendedprice") * 300).alias("predicted_eur"),
        (F.max("l_extendedprice") * 200).alias("market_value_in_eur"))
    rows = line.select(F.col("l_partkey").alias("p_partkey"), "season", *LINE_COLUMNS).join(
        table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("firstname"), F.col("p_brand").alias("lastname")),
        "p_partkey").withColumnRenamed("p_partkey", "api_player_id")
    return report.with_names(values, rows, LINE_ORDER)


@query("undervalued", f"""
WITH {_SCORED_SQL},
g AS (SELECT *, round_even(actual / 1e6, 1) AS market_m, round_even(predicted / 1e6, 1) AS model_m FROM named)
SELECT l_partkey AS api_player_id, season, name, market_m, model_m, round_even(model_m - market_m, 1) AS gap_m
FROM g WHERE round_even(model_m - market_m, 1) > 0""")
def undervalued(spark, sf):
    return report.undervalued(_scored(spark, sf), ["api_player_id", "season"]).select(
        "api_player_id", "season", "name", "market_m", "model_m", "gap_m")


@query("lookup_verdict", f"""
WITH {_SCORED_SQL},
v AS (SELECT *, (predicted - actual) / actual AS ratio FROM named WHERE regexp_matches(lower(name), 'red .*brand#1$'))
SELECT l_partkey AS api_player_id, season, name,
  CAST(season AS VARCHAR) || '/' || lpad(CAST((season + 1) % 100 AS VARCHAR), 2, '0') AS season_label, round(ratio, 9) AS ratio,
  CASE WHEN ratio > 0.2 THEN 'UNDERVALUED' WHEN ratio < -0.2 THEN 'OVERVALUED' ELSE 'FAIR VALUE' END AS verdict_code,
  CASE WHEN ratio > 0.2 THEN 'UNDERVALUED  (model sees +' || CAST(round_even(ratio * 100, 0) AS BIGINT) || '% upside)'
       WHEN ratio < -0.2 THEN 'OVERVALUED   (model sees ' || CAST(round_even(ratio * 100, 0) AS BIGINT) || '% downside)'
       ELSE 'FAIR VALUE   (within ' || CASE WHEN ratio < 0 THEN '-' ELSE '+' END
            || CAST(abs(round_even(ratio * 100, 0)) AS BIGINT) || '% of TM)' END AS verdict
FROM v""")
def lookup_verdict(spark, sf):
    found = report.lookup(_scored(spark, sf), "Red .*brand#1$")
    return rounded(found, 9, "ratio").select("api_player_id", "season", "name", "season_label", "ratio",
                                             "verdict_code", "verdict")


@query("temporal_split", """
SELECT CASE WHEN year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) THEN 'test' ELSE 'train' END AS side,
       count(*) AS n, CAST(max(year(o_orderdate)) AS INTEGER) AS last_season FROM orders GROUP BY 1""")
def temporal_split(spark, sf):
    seasons = table(spark, sf, "orders").select(F.year("o_orderdate").alias("season"))
    train, test = relational.latest_split(seasons)
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("side").agg(F.count("*").alias("n"), F.max("season").alias("last_season"))
