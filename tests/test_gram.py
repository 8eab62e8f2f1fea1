"""Models from sums of products: against plain least squares per group and fold, and against the fitted estimators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from builders import league
from valora.plans import features, gram, models

FEATURES = ["a", "b", "fixed", "sum"]


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(4)
    made = []
    for i in range(600):
        a, b = float(r.normal(50, 3)), float(r.exponential(1000))
        made.append((i, ["u", "v", None][i % 3], i % 4, a, None if i % 17 == 0 else b, 2.0, a + (b if i % 17 else 0.0), None if i % 41 == 0 else 3 * a - b / 100 + float(r.normal())))
    made += [(1000, "lone", 0, 1.0, 2.0, 2.0, 3.0, 7.0), (1001, "empty", 1, 1.0, 2.0, 2.0, 3.0, None)]
    return spark.createDataFrame(made, "id int, g string, fold int, a double, b double, fixed double, sum double, y double").repartition(7)


def plain(rows, penalty, at):
    """Prediction at ``at`` by centred, standardised least squares."""
    x, y = np.array([[r[f] or 0.0 for f in FEATURES] for r in rows]), np.array([r.y for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    w = np.linalg.pinv(z.T @ z + penalty * np.eye(len(FEATURES)), rcond=1e-10) @ z.T @ (y - y.mean())
    return y.mean() + (np.array([at[f] or 0.0 for f in FEATURES]) - mean) / scale @ w


def test_out_of_fold_equals_plain_fits(rows):
    found = gram.out_of_fold(rows, FEATURES, "y", ["g"], "fold").collect()
    known = [r for r in rows.collect() if r.y is not None]
    checked = 0
    for r in found:
        others = [x for x in known if x.g == r.g and x.fold != r.fold]
        if others:
            assert r.y_pred == pytest.approx(plain(others, gram.PENALTIES[r.model], r), rel=1e-6, abs=1e-6)
            checked += 1
    assert checked == 2 * 600 and {r.id for r in found} == {r.id for r in rows.collect()} - {1000, 1001}  # no other fold, no model


def test_groups_total_and_folds(rows, monkeypatch):
    monkeypatch.setattr(gram, "MOST_CELLS", 30)  # every batch hands its matrices over
    sums = gram.gram_sums(rows, FEATURES, "y", ["g"], "fold", total="all")
    fitted = gram.fit(sums, ["g"], {"weak": 1.0})
    n = {(r.g, r.held_out): r.n for r in fitted.collect()}
    known = [r for r in rows.collect() if r.y is not None]
    assert n[("all", None)] == len(known) and n[(None, 2)] == sum(r.g is None and r.fold != 2 for r in known) and n[("lone", None)] == 1
    (one,) = gram.fit(gram.gram_sums(rows, FEATURES, "y"), penalties={"weak": 1.0}).collect()
    (total,) = fitted.filter("g = 'all' AND held_out IS NULL").collect()
    assert np.allclose([one.intercept, *one.weights], [total.intercept, *total.weights]) and total.weights[2] == 0.0
    lone = fitted.filter("g = 'lone'").first()
    assert lone.intercept == 7.0 and lone.weights == [0.0] * 4


def test_all_rows_models_and_arrays(rows):
    solved = gram.fit(gram.gram_sums(rows, gram.as_array(FEATURES), "y"), penalties={"Ridge": 10.0})
    named = {r.id: r.y_pred for r in gram.predict(rows, solved, FEATURES).collect()}
    assert named == {r.id: r.y_pred for r in gram.predict(rows, solved, gram.as_array(FEATURES)).collect()} and len(named) == 602
    with pytest.raises(ValueError):
        gram.gram_sums(rows, FEATURES, "y", ["g", "fold"], total="all")


def test_no_rows(rows):
    none = rows.filter("id < 0")
    assert gram.fit(gram.gram_sums(none, FEATURES, "y", ["g"], "fold"), ["g"]).count() == 0
    assert gram.out_of_fold(none, FEATURES, "y", ["g"], "fold").count() == 0


def test_rows_are_scanned_once(rows):
    """The aggregate combines cells before they are shuffled; what is shuffled are cells, not rows."""
    x = rows.select("g", F.col("fold").alias("__fold"), gram.as_array(FEATURES).alias("x"), "y").filter("y IS NOT NULL")
    cells = x.mapInArrow(gram.products(["g", "__fold"]), "g string, __fold int, i int, j int, s double")
    assert cells.count() <= 7 * 5 * 4 * 21


def test_global_and_position_models_equal_the_estimators(spark):
    table = features.build_stage1(league(spark), ["ord"]).cache()
    linear = ["LinearRegression", "Ridge"]
    same = {m: {"standardization": True} if m == "LinearRegression" else {"alpha": 10.0} for m in linear}  # settings of their own: fitted
    for train in (models.train_global, models.train_position_aware):
        a = {(r.model, r.position): r.asDict() for r in train(table, "stage1", tuned=False, models=linear).collect()}
        b = {(r.model, r.position): r.asDict() for r in train(table, "stage1", tuned=False, models=linear, overrides=same).collect()}
        assert a.keys() == b.keys()
        for key, row in a.items():
            for name, value in row.items():
                assert value == (pytest.approx(b[key][name], rel=1e-4, abs=1e-4) if isinstance(value, float) else b[key][name])
