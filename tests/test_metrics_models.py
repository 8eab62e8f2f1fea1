import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from builders import joined, league
from valora.plans import explain, features, metrics, models

LIGHT = {"RandomForest": {"numTrees": 8, "maxDepth": 4}, "GBT": {"maxIter": 8}}


def measure(spark, truth, predicted):
    df = spark.createDataFrame(list(zip(map(float, truth), map(float, predicted))), "y_true DOUBLE, y_pred DOUBLE")
    return metrics.regression_metrics(df, []).first()


def test_perfect_prediction(spark):
    m = measure(spark, range(1, 6), range(1, 6))
    assert (m.rmse_log, m.mae_log, m.rmse_eur, m.mae_eur, m.r2_log) == (0, 0, 0, 0, 1)
    assert m.spearman_log == pytest.approx(1) and m.n_samples == 5


@pytest.mark.parametrize("truth, predicted, field, value", [
    ([0, 4], [0, 0], "rmse_log", math.sqrt(8)), ([1, 2, 3], [0, 0, 0], "mae_log", 2.0),
    ([math.log1p(1e6), math.log1p(5e6)], [math.log1p(1e6), math.log1p(5e6)], "rmse_eur", 0.0),
    ([math.log1p(1e6)], [0], "mae_eur", 1e6), ([1, 2, 3, 4, 5], [1.5, 2.5, 3.5, 4.5, 5.5], "spearman_log", 1.0),
    ([1, 2, 3, 4, 5], [-1, -2, -3, -4, -5], "spearman_log", -1.0), ([1, 2, 3], [2, 2, 2], "r2_log", 0.0),
    ([2, 2], [2, 2], "r2_log", 1.0), ([2, 2], [1, 3], "r2_log", 0.0),
])
def test_single_metrics(spark, truth, predicted, field, value):
    assert measure(spark, truth, predicted)[field] == pytest.approx(value, abs=1e-9)


def test_all_fields_and_undefined_values(spark):
    m = measure(spark, [1], [2])
    assert set(metrics.METRICS) <= set(m.asDict()) and m.r2_log is None and m.spearman_log is None


def test_results_table_and_pivot(spark):
    df = spark.createDataFrame([("RandomForest", "stage1", "global", 10, .12345, .2, .7785, .9, 1e6, 3_450_000.0),
                                ("GBT", "stage2", "global", 10, .1, .2, .5, .9, 1e6, 2e6)],
                               "model STRING, stage STRING, position STRING, n_samples BIGINT, rmse_log DOUBLE, mae_log DOUBLE, "
                               "r2_log DOUBLE, spearman_log DOUBLE, rmse_eur DOUBLE, mae_eur DOUBLE")
    table = metrics.results_table(df)
    row = table.filter("stage = 'stage1' AND position = 'global'").first()
    assert (row.n, row.rmse_log, row.mae_eur_m) == (10, 0.123, 3.4)
    pivot = {r.stage: (r.RandomForest, r.GBT) for r in metrics.result_pivot(table, "stage", "model", "r2", ["RandomForest", "GBT"]).collect()}
    assert pivot["stage2"] == (0.0, 0.5) and pivot["stage1"][1] == 0.0


@pytest.fixture(scope="module")
def table1(spark):
    return features.build_stage1(league(spark), ["ord"]).cache()


def test_ridge_equals_closed_form(spark):
    r = np.random.default_rng(1)
    x = np.c_[r.normal(3, 2, 80), r.exponential(100, 80), np.ones(80)]
    y = 2 * x[:, 0] + 0.01 * x[:, 1] + r.normal(size=80)
    df = spark.createDataFrame([(*map(float, row), float(v)) for row, v in zip(x, y)], "a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    data = models.assemble(df, ["a", "b", "c"])
    for alpha, standardize in ((10.0, True), (1.0, False)):
        got = np.array([p.prediction for p in models.ridge(data, alpha, "y", standardize=standardize).fit(data)
                        .transform(data).select("prediction").collect()])
        deviation = x.std(axis=0) if standardize else np.ones(3)
        z = (x - x.mean(axis=0)) / np.where(deviation > 0, deviation, 1)
        weights = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        assert np.allclose(got, y.mean() + z @ weights)


def test_missing_features_count_as_zero(spark):
    df = spark.createDataFrame([(None, 2)], "a DOUBLE, b INT")
    assert list(models.assemble(df, ["a", "b"]).first().features) == [0.0, 2.0]


def test_out_of_fold_covers_every_row_once(table1):
    data = models._stored_vectors(table1, "oof")
    oof = models.oof_predictions(data, lambda p: models.estimator("LinearRegression", p).fit(p))
    keys = [tuple(r) for r in oof.select(*models.KEY).collect()]
    assert len(keys) == len(set(keys)) == 450
    assert {r[0] for r in data.select("__fold").distinct().collect()} == set(range(5))


def test_search_draws_are_distinct_and_reproducible():
    draws = models.draw_params("RandomForest")
    assert draws == models.draw_params("RandomForest") and len({str(d) for d in draws}) == 10
    assert models.draw_params("GBT", 1000) and len(models.draw_params("GBT", 1000)) == 72


def test_global_models_learn(table1):
    rows = {r.model: r for r in models.train_global(table1, "stage1", tuned=False, overrides=LIGHT).collect()}
    assert set(rows) == set(models.BASE_MODELS)
    assert all(r.n_samples == 150 and r.position == "global" for r in rows.values())
    assert min(r.r2_log for r in rows.values()) > 0.3 and rows["Ridge"].spearman_log > 0.6


def test_second_order_boosting_learns(table1):
    row = models.train_global(table1, "stage1", tuned=False, models=["Boosting"], overrides={"Boosting": {"rounds": 12, "depth": 3, "rate": 0.3}}).first()
    assert row.model == "Boosting" and row.r2_log > 0.3


def test_tuned_model(table1):
    (row,) = models.train_global(table1, "stage1", models=["RandomForest"], overrides={"RandomForest": {"numTrees": 3}}, draws=2).collect()
    assert row.r2_log > 0.3


def test_single_season_uses_out_of_fold(table1):
    (row,) = models.train_global(table1.filter("season = 2022"), "stage1", models=["Ridge"]).collect()
    assert row.n_samples == 150


def test_position_models_report_small_groups(table1):
    few = table1.filter("pos_MID = 0 OR api_player_id < 20")
    rows = models.train_position_aware(few, "stage1", tuned=False, models=["Ridge"]).collect()
    assert {r.position: r.r2_log is None for r in rows} == {"DEF": False, "FWD": False, "MID": True}
    assert next(r.n_samples for r in rows if r.position == "MID") < 30


def test_stacked(table1):
    (row,) = models.train_stacked(table1, "stage1", tuned=False, overrides=LIGHT, positions=False).collect()
    assert row.model == models.STACKED and row.r2_log > 0.4
    with pytest.raises(ValueError):
        models.train_stacked(table1.filter("season = 2022"), "stage1")


def tree_value(tree, row, subset, node=0):
    """Expected prediction when only the features of ``subset`` are known."""
    n = tree.loc[node]
    if n.leftChild < 0:
        return n.prediction
    sides = [int(n.leftChild), int(n.rightChild)]
    if n.feature in subset:
        return tree_value(tree, row, subset, sides[0] if row[int(n.feature)] <= n.threshold else sides[1])
    return sum(tree.loc[s].cover / n.cover * tree_value(tree, row, subset, s) for s in sides)


def test_attributions_equal_brute_force_shapley(spark):
    from itertools import combinations
    from math import factorial
    r = np.random.default_rng(2)
    x = r.normal(size=(120, 4))
    y = x[:, 0] * 2 + x[:, 1] * x[:, 2] + (x[:, 0] > 0.5)
    df = spark.createDataFrame([(*map(float, row), float(v)) for row, v in zip(x, y)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, log_market_value DOUBLE")
    names = ["a", "b", "c", "d"]
    model = models.fit_forest(df, names, {"RandomForest": {"numTrees": 3, "maxDepth": 5}})
    tables = explain.forest_nodes(model, df)
    got = explain.shap_values([explain.compile_tree(t, 4) for t in tables], x[:6])
    for row, values in zip(x[:6], got):
        for i in range(4):
            others = [j for j in range(4) if j != i]
            exact = sum(
                factorial(k) * factorial(3 - k) / factorial(4)
                * np.mean([tree_value(t, row, {*s, i}) - tree_value(t, row, set(s)) for t in tables])
                for k in range(4) for s in combinations(others, k))
            assert values[i] == pytest.approx(exact, abs=1e-9)


def test_attributions_add_up_and_aggregate(table1):
    names = models.feature_columns(table1)
    model = models.fit_forest(table1, names, {"RandomForest": {"numTrees": 6, "maxDepth": 6}})
    keyed = explain.row_attributions(model, table1, ["api_player_id", "season"], names)
    scored = models.score(model, table1, names).select("api_player_id", "season", "predicted_log")
    rows = keyed.join(scored, ["api_player_id", "season"]).collect()
    assert len(rows) == 450
    for r in rows:
        assert r.base_value + sum(r.attributions) == pytest.approx(r.predicted_log)
    mean = np.abs(np.array([r.attributions for r in rows])).mean(axis=0)
    for r in explain.mean_abs_shap(model, table1.repartition(5), names).collect():
        assert r.mean_abs == pytest.approx(mean[names.index(r.feature)])


def test_shap_importance_guards_and_order(spark, table1):
    top = explain.shap_importance(table1, "FWD", 4, LIGHT).collect()
    assert len(top) == 4 and [t.mean_abs for t in top] == sorted((t.mean_abs for t in top), reverse=True)
    assert "goals" in {t.feature for t in top}
    with pytest.raises(ValueError):
        explain.shap_importance(features.build_stage1(joined(spark, {}, dict(season=2023)), ["ord"]))
    with pytest.raises(ValueError):
        explain.shap_importance(table1, "GK")


def test_many_rows_are_attributed_by_patterns_of_conditions(monkeypatch):
    """One tree of ten path features, so that a pattern takes two octets: as row by row, with work that depends on patterns, not on rows."""
    r = np.random.default_rng(5)
    depth, leaves = 10, 3
    tree = {"feature": np.array([r.permutation(12)[:depth] for _ in range(leaves)]), "low": r.normal(-1, 1, (leaves, depth)), "high": r.normal(1, 1, (leaves, depth)),
            "share": r.uniform(0.1, 0.9, (leaves, depth)), "value": r.normal(size=leaves)}
    x, direct, worked = r.normal(size=(5000, 12)), explain._attributions, []
    by_row = np.vstack([explain.shap_values([tree], x[at:at + 100]) for at in range(0, len(x), 100)])
    monkeypatch.setattr(explain, "_attributions", lambda t, met: worked.append(len(met)) or direct(t, met))
    assert explain.shap_values([tree], x, cells=2000) == pytest.approx(by_row, abs=1e-12)
    assert sum(worked) == 1 << depth
