"""Forests over binned rows: against Spark ML where nothing is drawn, one task against many, draws, cuts and odd input."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from builders import league
from valora.plans import explain, features, forest, models
from valora.plans.forest import RandomForest


def frame(spark, n=600, seed=4):
    r = np.random.default_rng(seed)
    x = np.c_[r.integers(0, 20, n), r.integers(0, 3, n), r.integers(0, 30, n)].astype(float)
    y = x[:, 0] + 5 * (x[:, 1] > 1) + r.normal(size=n)
    df = spark.createDataFrame([(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id INT, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    return models.assemble(df, ["a", "b", "c"])


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize("depth, least", [(1, 1), (4, 3), (6, 40)])
@pytest.mark.parametrize("alone", [1 << 20, 0])
def test_without_draws_a_tree_is_that_of_spark(spark, monkeypatch, depth, least, alone):
    monkeypatch.setattr(forest, "ALONE", alone)
    df = frame(spark).repartition(3)
    known = RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=depth, minInstancesPerNode=least, featureSubsetStrategy="all", bootstrap=False)
    own = RandomForest("y", numTrees=1, maxDepth=depth, minInstancesPerNode=least, bootstrap=False)
    assert predictions(own.fit(df), df) == pytest.approx(predictions(known.fit(df), df))


def test_levels_give_the_trees_of_one_task(spark, monkeypatch):
    df = frame(spark).repartition(3).cache()
    own = RandomForest("y", numTrees=7, maxDepth=4)
    monkeypatch.setattr(forest, "ALONE", 1 << 20)
    one = own.fit(df)
    monkeypatch.setattr(forest, "ALONE", 0)
    monkeypatch.setattr(forest, "SUMS", 20 * 3 * 2 * 32 * 8)  # several jobs a level
    many = own.fit(df)
    assert (one.feature == many.feature).all() and (one.cut == many.cut).all() and one.value == pytest.approx(many.value) and (one.cover == many.cover).all()
    assert len({tuple(c) for c in one.cover}) == 7


def test_draws_are_poisson_and_differ_by_tree():
    hashes = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63 - 1, 200_000)
    drawn = np.stack([forest.weights(hashes, t) for t in range(6)]).astype(float)
    assert drawn.mean(1) == pytest.approx(np.ones(6), abs=0.02) and drawn.var(1) == pytest.approx(np.ones(6), abs=0.03)
    assert abs(np.corrcoef(drawn) - np.eye(6)).max() < 0.02


def test_cuts_are_of_all_rows(spark):
    """Few values are all told apart, however rare; many are cut into equal shares."""
    few = forest.cuts(*forest.summary(np.r_[np.zeros(100_000), 1.0, 2.0], np.ones(100_002)))
    assert few.tolist() == [0.5, 1.5]
    values = np.random.default_rng(2).lognormal(0, 2, 100_000)
    df = models.assemble(spark.createDataFrame([(float(v),) for v in values], "v DOUBLE").repartition(5), ["v"])
    (found,) = forest.feature_cuts(df, models.vector_to_array("features"), 1)
    assert len(found) == 31 and np.diff(np.r_[0, np.searchsorted(np.sort(values), found), 100_000]) == pytest.approx(100_000 / 32, rel=0.1)


def test_odd_input(spark):
    df = frame(spark, 40)
    for rows in (df.filter("false"), df.withColumn("y", F.when(F.col("id") > 3, F.col("y")))):
        with pytest.raises(ValueError):
            RandomForest("y", numTrees=2, maxDepth=2).fit(rows)
    constant = df.withColumn("y", F.lit(4.0))
    model = RandomForest("y", numTrees=3, maxDepth=3).fit(constant)
    assert predictions(model, constant) == pytest.approx([4.0] * 40) and [len(t) for t in model.nodes()] == [1, 1, 1]
    assert predictions(RandomForest("y", numTrees=30, maxDepth=3, minInstancesPerNode=1).fit(df.limit(1)), df.limit(1)) == pytest.approx([df.first().y])


def test_a_forest_is_one_job_of_trees_and_keeps_its_size(spark, monkeypatch):
    """Before, every level of all trees was a job of Spark ML, which shuffled the sums of all partitions."""
    table = features.build_stage1(league(spark, 60), ["ord"])
    monkeypatch.setattr(models, "estimator", lambda *_, **__: pytest.fail("fitted by Spark ML"))
    model = models.fit_forest(table, models.feature_columns(table))
    assert model.feature.shape == (200, 255) and len(explain.forest_nodes(model, table)) == 200


def test_attributions_by_parts_equal_those_by_row(monkeypatch):
    """A tree of depth 8 with features that return on a path: what is looked up depends on parts, not on leaves."""
    import pandas as pd
    r = np.random.default_rng(6)
    inner = 255
    cover = np.zeros(511)
    cover[inner:] = r.integers(3, 50, 256)
    for i in reversed(range(inner)):
        cover[i] = cover[2 * i + 1] + cover[2 * i + 2]
    ids = np.arange(511)
    full = pd.DataFrame({"prediction": r.normal(size=511), "cover": cover, "leftChild": np.where(ids < inner, 2 * ids + 1, -1), "rightChild": np.where(ids < inner, 2 * ids + 2, -1),
                         "feature": np.where(ids < inner, r.integers(0, 10, 511), -1), "threshold": r.normal(size=511)})
    short = full.loc[[0, 1, 2, 5, 6]].copy()
    short.loc[[1, 5, 6], ["leftChild", "rightChild"]] = -1
    trees, x = [explain.compile_tree(t, 10) for t in (full, short)], r.normal(size=(3000, 10))
    assert len(trees[0]["parts"]) == 64 and max(len(splits) for splits, _ in trees[0]["parts"]) == 9 and len(trees[1]["parts"]) == 1
    by_parts = explain.shap_values(trees, x)
    monkeypatch.setattr(explain, "PART_ROWS", 1 << 40)
    assert by_parts == pytest.approx(explain.shap_values(trees, x), abs=1e-12)


def test_batches_are_explained_together(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(explain, "GATHERED_ROWS", 25)
    batches = [pd.DataFrame({"a": range(i, i + 10)}) for i in range(0, 70, 10)]
    found = list(explain._gathered(iter(batches)))
    assert [len(b) for b in found] == [30, 30, 10] and pd.concat(found).a.tolist() == list(range(70))
