"""Models on the driver tables. Linear fits with one feature have a closed form in SQL; tree
ensembles run on all rows and are checked by quality floors in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.catalogue.registry import ROW_ORDER, performances, query, rounded, table
from valora.operators.relational import latest_split
from valora.plans import explain, features, gram, models
from valora.plans.boosting import SecondOrderBoosting
from valora.session import materialize

#: Forests and second-order boosting have their full size, 200 trees of depth 8 and 300 rounds. First-order boosting, whose rounds follow one another as several small jobs each, has a tenth of its rounds.
ROUNDS = {"GBT": {"maxIter": 30}}


def _stage5(spark, sf):
    return features.build_stage5(performances(spark, sf), ROW_ORDER, league_ids=range(5))


def _stage1(spark, sf):
    return features.build_stage1(performances(spark, sf), ROW_ORDER)


def _line(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
                                               F.col("l_extendedprice").alias("y"), "l_quantity")
    return models.assemble(line.withColumn("x", F.nullif("l_quantity", F.lit(1.0))), ["x"])


_LINE_SQL = """
l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS y, coalesce(nullif(l_quantity, 1), 0) AS x FROM lineitem)"""


@query("linear_fit", f"""
WITH {_LINE_SQL}, c AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM l)
SELECT l_orderkey, l_linenumber, l_suppkey, round(a * x + b, 4) AS prediction FROM l, c""")
def linear_fit(spark, sf):
    data = _line(spark, sf)
    fitted = models.estimator("LinearRegression", data, "y").fit(data)
    return rounded(fitted.transform(data), 4, "prediction").select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


@query("ridge_fit", f"""
WITH {_LINE_SQL}, c AS (SELECT covar_pop(y, x) / var_pop(x) * count(*) / (count(*) + 10.0::DOUBLE) AS a, avg(x) AS mx, avg(y) AS my FROM l)
SELECT l_orderkey, l_linenumber, l_suppkey, round(my + a * (x - mx), 4) AS prediction FROM l, c""")
def ridge_fit(spark, sf):
    data = _line(spark, sf)
    fitted = models.estimator("Ridge", data, "y").fit(data)
    return rounded(fitted.transform(data), 4, "prediction").select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


# Normal equations for three features, by Cramer's rule: variances grow by penalty / n, which is the ridge of standardised features.
_X, _PAIRS = (1, 2, 3), [(i, j) for i in (1, 2, 3) for j in (1, 2, 3) if i <= j]


def _det(rows) -> str:
    a, b, c = rows
    return " + ".join(f"{a[i]} * ({b[(i + 1) % 3]} * {c[(i + 2) % 3]} - {b[(i + 2) % 3]} * {c[(i + 1) % 3]})" for i in range(3))


def _cell(i: int, j: int, column: int | None = None) -> str:
    if j == column:
        return f"c{i}y"
    return f"(c{min(i, j)}{max(i, j)}{' * (1 + penalty / n)' if i == j else ''})"


_MATRIX = {column: _det([[_cell(i, j, column) for j in _X] for i in _X]) for column in (None, *_X)}
_GRAM_SQL = f"""
r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag AS flag, CAST(l_orderkey % 5 AS INTEGER) AS fold, l_extendedprice AS y,
             l_quantity AS x1, coalesce(nullif(l_discount, 0.05), 0) AS x2, l_tax AS x3 FROM lineitem),
s AS (SELECT flag, fold, count(*) AS n, sum(y) AS sy, {", ".join(f"sum(x{i}) AS s{i}, sum(x{i} * y) AS s{i}y" for i in _X)},
             {", ".join(f"sum(x{i} * x{j}) AS s{i}{j}" for i, j in _PAIRS)}
      FROM (SELECT * FROM r UNION ALL SELECT * REPLACE ('all' AS flag) FROM r) GROUP BY ALL),
o AS (SELECT s.flag, k.fold AS held_out, sum(n) AS n, sum(sy) AS sy, {", ".join(f"sum(s{i}) AS s{i}, sum(s{i}y) AS s{i}y" for i in _X)},
             {", ".join(f"sum(s{i}{j}) AS s{i}{j}" for i, j in _PAIRS)}
      FROM s JOIN (SELECT DISTINCT fold FROM s UNION ALL SELECT NULL) k ON k.fold IS DISTINCT FROM s.fold GROUP BY ALL),
c AS (SELECT *, {", ".join(f"s{i}y / n - s{i} / n * sy / n AS c{i}y" for i in _X)}, {", ".join(f"s{i}{j} / n - s{i} / n * s{j} / n AS c{i}{j}" for i, j in _PAIRS)}
      FROM o, (VALUES ('LinearRegression', 0.0::DOUBLE), ('Ridge', 10.0::DOUBLE)) p(model, penalty)),
w AS (SELECT *, {", ".join(f"({_MATRIX[i]}) / ({_MATRIX[None]}) AS w{i}" for i in _X)} FROM c),
g AS (SELECT flag, model, held_out, CAST(n AS BIGINT) AS n, sy / n - {" - ".join(f"w{i} * s{i} / n" for i in _X)} AS intercept, w1, w2, w3 FROM w)"""


def _gram_rows(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") % 5).cast("int").alias("fold"),
        F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x1"), F.nullif("l_discount", F.lit(0.05)).alias("x2"), F.col("l_tax").alias("x3"))


@query("gram_models", f"""
WITH {_GRAM_SQL} SELECT flag, model, held_out, n, round(intercept, 4) AS intercept, round(w1, 4) AS w1, round(w2, 4) AS w2, round(w3, 4) AS w3 FROM g""")
def gram_models(spark, sf):
    """Linear and ridge models of three groups and their total, each for all rows and for five folds held out: one scan."""
    sums = gram.gram_sums(_gram_rows(spark, sf), ["x1", "x2", "x3"], "y", ["flag"], "fold", total="all")
    fitted = gram.fit(sums, ["flag"])
    weights = {f"w{i + 1}": F.get("weights", F.lit(i)) for i in range(3)}
    return rounded(fitted.withColumns(weights).drop("weights"), 4, "intercept", *weights)


@query("gram_predictions", f"""
WITH {_GRAM_SQL} SELECT l_orderkey, l_linenumber, l_suppkey, model, round(intercept + w1 * x1 + w2 * x2 + w3 * x3, 2) AS y_pred
FROM r JOIN g ON g.flag = r.flag AND held_out = fold""")
def gram_predictions(spark, sf):
    """Every line predicted by the two models of its group that did not see its fold."""
    found = gram.out_of_fold(_gram_rows(spark, sf), ["x1", "x2", "x3"], "y", ["flag"], "fold")
    return rounded(found, 2, "y_pred").select("l_orderkey", "l_linenumber", "l_suppkey", "model", "y_pred")


@query("oof_predictions", """
WITH f AS (SELECT CAST(o_orderkey % 5 AS INTEGER) AS fold, o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x FROM orders),
s AS (SELECT k.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM f JOIN (SELECT DISTINCT fold FROM f) k ON f.fold <> k.fold
      GROUP BY k.fold)
SELECT fold, count(*) AS n, round(avg(a * x + b), 2) AS mean_prediction FROM f JOIN s USING (fold) GROUP BY fold""")
def oof_predictions(spark, sf):
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 5).cast("int").alias("fold"), F.col("o_totalprice").alias("y"), "o_custkey")
    data = models.assemble(orders, ["o_custkey"])
    scored = models.oof_predictions(data, lambda part: models.estimator("LinearRegression", part, "y").fit(part), fold="fold")
    return scored.groupBy("fold").agg(F.count("*").alias("n"), F.round(F.avg("y_pred"), 2).alias("mean_prediction"))


@query("fold_assignment")
def fold_assignment(spark, sf):
    fold = models.fold_of(["o_orderkey"], 5)
    return table(spark, sf, "orders").groupBy(fold.alias("fold")).agg(F.count("*").alias("n"))


@query("global_models")
def global_models(spark, sf):
    return models.train_global(_stage1(spark, sf), "stage1", tuned=False, overrides=ROUNDS)


@query("forest_fit")
def forest_fit(spark, sf):
    return models.train_global(_stage5(spark, sf), "stage5", tuned=False, models=["RandomForest"])


@query("gbt_fit")
def gbt_fit(spark, sf):
    return models.train_global(_stage1(spark, sf), "stage1", tuned=False, models=["GBT"], overrides=ROUNDS)


@query("position_models")
def position_models(spark, sf):
    return models.train_position_aware(_stage1(spark, sf), "stage1", tuned=False, overrides=ROUNDS)


@query("tuned_fit")
def tuned_fit(spark, sf):
    return models.train_global(_stage1(spark, sf), "stage1", tuned=True, models=["RandomForest"],
                               overrides={"RandomForest": {"numTrees": 3}}, draws=2)


@query("stacked_fit")
def stacked_fit(spark, sf):
    return models.train_stacked(_stage1(spark, sf), "stage1", tuned=False, overrides={
        "RandomForest": {"numTrees": 5, "maxDepth": 5}, "GBT": {"maxIter": 3}}, positions=False)


@query("scored_values")
def scored_values(spark, sf):
    """Forest on the earlier seasons, euros predicted for the latest."""
    data = materialize(_stage5(spark, sf), "stage5")
    columns = models.feature_columns(data)
    train, test = latest_split(data)
    model = models.fit_forest(train, columns)
    return models.score(model, test, columns).select("api_player_id", "season", "market_value_in_eur", "predicted_eur")


@query("shap_importance")
def shap_importance(spark, sf):
    return explain.shap_importance(_stage1(spark, sf), "global", 15)


_LATEST_SQL = """
WITH s AS (SELECT DISTINCT l_partkey AS api_player_id, CAST(year(l_shipdate) AS INTEGER) AS season FROM lineitem
           JOIN part ON p_partkey = l_partkey WHERE p_type NOT IN ('STANDARD', 'PROMO'))
SELECT api_player_id, season, true AS adds_up FROM s WHERE season = (SELECT max(season) FROM s)"""


@query("shap_additivity", _LATEST_SQL)
def shap_additivity(spark, sf):
    """Per row of the latest season: whether base value and attributions sum to the forest's prediction."""
    data = materialize(_stage1(spark, sf), "stage1")
    columns = models.feature_columns(data)
    train, test = latest_split(data)
    model = models.fit_forest(train, columns)
    keys = ["api_player_id", "season"]
    parts = explain.row_attributions(model, test, keys, columns)
    total = F.col("base_value") + F.aggregate("attributions", F.lit(0.0), lambda a, b: a + b)
    scored = models.score(model, test, columns).select(*keys, "predicted_log")
    return parts.select(*keys, total.alias("total")).join(scored, keys).select(*keys, (F.abs(F.col("total") - F.col("predicted_log")) < 1e-6).alias("adds_up"))


_SPLITS_SQL = """
r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS y, l_quantity AS x FROM lineitem),
v AS (SELECT x, count(*) AS n, sum({y}) AS s FROM {rows} GROUP BY x),
c AS (SELECT x, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(n) OVER () AS all_n, sum(s) OVER () AS all_s FROM v WINDOW w AS (ORDER BY x)),
best AS (SELECT x AS cut, s / n AS low, (all_s - s) / (all_n - n) AS high FROM c WHERE n < all_n
         ORDER BY s * s / n + (all_s - s) * (all_s - s) / (all_n - n) DESC LIMIT 1)"""


def _stump_rows(spark, sf):
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x"))
    return models.assemble(line, ["x"])


@query("forest_stump", f"""
WITH {_SPLITS_SQL.format(y='y', rows='r')}
SELECT l_orderkey, l_linenumber, l_suppkey, round(CASE WHEN x <= cut THEN low ELSE high END, 4) AS prediction FROM r, best""")
def forest_stump(spark, sf):
    """The exact form of the forest: one tree, one split, all rows, so the split of least squared error."""
    data = _stump_rows(spark, sf)
    forest = models.estimator("RandomForest", data, "y", {"RandomForest": {
        "numTrees": 1, "maxDepth": 1, "minInstancesPerNode": 1, "maxBins": 64}}).setBootstrap(False)
    return rounded(forest.fit(data).transform(data), 4, "prediction").select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


@query("boosting_stump", f"""
WITH {_SPLITS_SQL.format(y='y', rows='r')}
SELECT l_orderkey, l_linenumber, l_suppkey, round(CASE WHEN x <= cut THEN low ELSE high END, 4) AS prediction FROM r, best""")
def boosting_stump(spark, sf):
    """The exact form of boosting: its first round is the split of least squared error."""
    data = _stump_rows(spark, sf)
    boosting = models.estimator("GBT", data, "y", {"GBT": {
        "maxIter": 1, "maxDepth": 1, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "maxBins": 64}})
    return rounded(boosting.fit(data).transform(data), 4, "prediction").select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


_BOOST_ROUNDS, _BOOST_DEPTH, _BOOST_RATE = 2, 2, 0.3


def _boosting_sql() -> str:
    """Level by level: sums per value, running sums, the best split of each node, rows to the next level."""
    steps = ["r0_0 AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS y, l_quantity AS x1, l_discount AS x2, l_tax AS x3, 0 AS node, "
             "avg(l_extendedprice) OVER () AS m FROM lineitem)"]
    for turn in range(_BOOST_ROUNDS):
        for level in range(_BOOST_DEPTH):
            at, last = f"{turn}_{level}", level == _BOOST_DEPTH - 1
            after = f"{turn + 1}_0" if last else f"{turn}_{level + 1}"
            values = " UNION ALL ".join(f"SELECT node, {f} AS f, x{f} AS x, m - y AS g FROM r{at}" for f in (1, 2, 3))
            steps += [
                f"v{at} AS (SELECT node, f, x, sum(g) AS g, count(*) AS h FROM ({values}) GROUP BY ALL)",
                f"c{at} AS (SELECT node, f, x, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(g) OVER p AS ag, sum(h) OVER p AS ah FROM v{at} "
                "WINDOW w AS (PARTITION BY node, f ORDER BY x), p AS (PARTITION BY node, f))",
                f"s{at} AS (SELECT * FROM c{at} WHERE lh >= 1 AND ah - lh >= 1 QUALIFY row_number() OVER (PARTITION BY node "
                "ORDER BY lg * lg / (lh + 1) + (ag - lg) * (ag - lg) / (ah - lh + 1) DESC, f, x) = 1)"]
            low = "CASE f WHEN 1 THEN x1 WHEN 2 THEN x2 ELSE x3 END <= x"
            node = "0" if last else f"2 * node + CASE WHEN {low} THEN 0 ELSE 1 END"
            gain = f"m - {_BOOST_RATE}::DOUBLE * CASE WHEN {low} THEN lg / (lh + 1) ELSE (ag - lg) / (ah - lh + 1) END" if last else "m"
            steps.append(f"r{after} AS (SELECT l_orderkey, l_linenumber, l_suppkey, y, x1, x2, x3, {node} AS node, {gain} AS m FROM r{at} JOIN s{at} USING (node))")
    return f"WITH {', '.join(steps)} SELECT l_orderkey, l_linenumber, l_suppkey, round(m, 2) AS prediction FROM r{_BOOST_ROUNDS}_0"


@query("boosting_second_order", _boosting_sql())
def boosting_second_order(spark, sf):
    """The exact form: two rounds of depth 2 on all rows and columns; every value of the features is a cut."""
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_extendedprice").alias("y"), "l_quantity", "l_discount", "l_tax")
    data = models.assemble(line, ["l_quantity", "l_discount", "l_tax"])
    boosting = SecondOrderBoosting("y", ["l_orderkey", "l_linenumber"], rounds=_BOOST_ROUNDS, depth=_BOOST_DEPTH, rate=_BOOST_RATE, rows=1.0, columns=1.0)
    return rounded(boosting.fit(data).transform(data), 2, "prediction").select("l_orderkey", "l_linenumber", "l_suppkey", "prediction")


@query("boosted_models")
def boosted_models(spark, sf):
    """Second-order boosting on the richest stage."""
    return models.train_global(_stage5(spark, sf), "stage5", tuned=False, models=["Boosting"])
