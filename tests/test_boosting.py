"""Second-order boosting against a plain version, and its behaviour on odd input."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from builders import league
from valora.plans import boosting, features, models
from valora.plans.boosting import SecondOrderBoosting


def plain(x, y, rounds, depth, rate, penalty=1.0, least=1.0):
    """Exact greedy trees, one node after the other; predictions of the training rows."""
    def tree(rows, g, left):
        value = -g[rows].sum() / (len(rows) + penalty)
        best = (boosting.LEAST_GAIN, None)
        for f in range(x.shape[1]) if left else ():
            for cut in np.unique(x[rows, f]):
                low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(low), len(high)) < least:
                    continue
                gain = sum(g[part].sum() ** 2 / (len(part) + penalty) for part in (low, high)) - g[rows].sum() ** 2 / (len(rows) + penalty)
                if gain > best[0] + 1e-9:
                    best = (gain, (low, high))
        if best[1] is None:
            return [(rows, value)]
        return tree(best[1][0], g, left - 1) + tree(best[1][1], g, left - 1)

    margin = np.full(len(y), y.mean())
    for _ in range(rounds):
        grown = tree(np.arange(len(y)), margin - y, depth)
        for rows, value in grown:
            margin[rows] += rate * value
    return margin


def frame(spark, x, y):
    rows = [(i, *map(float, a), None if b is None else float(b)) for i, (a, b) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(len(x[0]))]
    df = spark.createDataFrame(rows, f"id INT, {', '.join(f'{n} DOUBLE' for n in names)}, y DOUBLE")
    return models.assemble(df, names)


def predictions(model, df):
    return np.array([r.prediction for r in model.transform(df).orderBy("id").collect()])


@pytest.fixture(scope="module")
def sample():
    r = np.random.default_rng(5)
    x = np.c_[r.integers(0, 40, 400), r.integers(-5, 5, 400), r.normal(size=400).round(1)]
    return x, x[:, 0] * 2 + np.where(x[:, 1] > 0, 15, 0) + r.normal(size=400)


@pytest.mark.parametrize("depth, least", [(1, 1.0), (3, 1.0), (4, 20.0)])
def test_equals_plain_trees(spark, sample, depth, least):
    x, y = sample
    df = frame(spark, x, y)
    model = SecondOrderBoosting("y", ["id"], rounds=3, depth=depth, rate=0.5, rows=1.0, columns=1.0, least=least).fit(df)
    assert predictions(model, df) == pytest.approx(plain(x, y, 3, depth, 0.5, least=least))


def test_stored_predictions_change_nothing(spark, sample, monkeypatch):
    x, y = sample
    df = frame(spark, x, y).repartition(3)
    options = dict(rounds=5, depth=2, rate=0.3)
    once = predictions(SecondOrderBoosting("y", ["id"], **options).fit(df), df)
    monkeypatch.setattr(boosting, "ROUNDS_STORED", 2)
    assert predictions(SecondOrderBoosting("y", ["id"], **options).fit(df), df) == pytest.approx(once)


def test_draws_follow_the_share_and_the_round():
    hashes = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63 - 1, 100_000)
    first, second = boosting.drawn(hashes, 0, 0.8), boosting.drawn(hashes, 1, 0.8)
    assert first.mean() == pytest.approx(0.8, abs=0.01) and (first & second).mean() == pytest.approx(0.64, abs=0.01)
    assert boosting.drawn(hashes, 3, 1.0).all()


def test_few_rows_constants_nulls_and_nothing(spark):
    one = frame(spark, [(1, 2)], [7.0])
    assert predictions(SecondOrderBoosting("y", ["id"], rounds=2, depth=2).fit(one), one) == pytest.approx([7.0])
    constant = frame(spark, [(3, 3)] * 9, [1.0, 2.0, 3.0] * 3)
    assert predictions(SecondOrderBoosting("y", ["id"], rounds=2, depth=3, rows=1.0).fit(constant), constant) == pytest.approx([2.0] * 9)
    unlabelled = frame(spark, [(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)], [0.0, 0.0, 8.0, 8.0, None])
    model = SecondOrderBoosting("y", ["id"], rounds=1, depth=1, rate=1.0, rows=1.0, columns=1.0).fit(unlabelled)
    low, high = 4 - 4 * 2 / 3, 4 + 4 * 2 / 3
    assert predictions(model, unlabelled) == pytest.approx([low, low, high, high, high])
    nothing = unlabelled.filter(F.col("y").isNull())
    assert [r.prediction for r in SecondOrderBoosting("y", ["id"]).fit(nothing).transform(unlabelled).collect()] == [None] * 5


def test_many_values_are_cut_at_quantiles(spark):
    x = np.random.default_rng(1).lognormal(0, 3, 3000)
    df = frame(spark, x[:, None], np.log(x))
    model = SecondOrderBoosting("y", ["id"], rounds=30, depth=4, rate=0.3).fit(df)
    found = predictions(model, df)
    assert 1 - ((found - np.log(x)) ** 2).mean() / np.log(x).var() > 0.98


def test_tables_are_removed(spark, sample, tmp_path_factory):
    import os
    from valora.session import checkpoint_root
    x, y = sample
    SecondOrderBoosting("y", ["id"], rounds=1, depth=1).fit(frame(spark, x, y))
    assert not [n for n in os.listdir(checkpoint_root(spark)) if n.startswith("boosting-")]


def test_small_tables_give_the_trees_of_large_ones(spark, sample, monkeypatch):
    x, y = sample
    df = frame(spark, x, y).repartition(3)
    fitted = SecondOrderBoosting("y", ["id"], rounds=7, depth=3, rate=0.3)
    by_level = predictions(fitted.fit(df), df)
    monkeypatch.setattr(boosting, "FEW_LEVELS", 0)
    assert predictions(fitted.fit(df), df) == pytest.approx(by_level)


def test_the_query_has_all_its_rounds(spark, monkeypatch):
    from valora import config
    from valora.catalogue import learning
    fitted = []
    monkeypatch.setattr(learning, "_stage5", lambda spark, sf: features.build_stage5(league(spark, 60), ["ord"]))
    fit = SecondOrderBoosting.fit
    monkeypatch.setattr(SecondOrderBoosting, "fit", lambda self, df: fitted.append(fit(self, df)) or fitted[-1])
    assert learning.boosted_models(spark, "").first().model == "Boosting"
    assert [len(m.trees) for m in fitted] == [config.SECOND_ORDER_PARAMS["rounds"]] == [300]


def test_a_level_reads_blocks_of_rows_and_walks_few_trees(spark, sample, monkeypatch):
    """What a level costs grows neither with Spark's rows nor with the rounds, and only one table of blocks is left."""
    x, y = sample
    df = frame(spark, x, y)
    edges = boosting.quantile_edges(df, vector_to_array("features"), 3)
    blocks = boosting.bin_rows(df.coalesce(1), vector_to_array("features"), "y", ["id"], edges, 1.5).collect()
    assert len(blocks) == 1 and len(blocks[0].bins) == 3 * len(y) and np.frombuffer(blocks[0].y).tolist() == pytest.approx(y.tolist())
    walked, dropped, sums, drop = [], [], boosting._level_sums, boosting.drop_stored
    monkeypatch.setattr(boosting, "_level_sums", lambda rows, width, trees, *rest: walked.append(len(trees)) or sums(rows, width, trees, *rest))
    monkeypatch.setattr(boosting, "drop_stored", lambda stored: dropped.append(drop(stored)))
    model = SecondOrderBoosting("y", ["id"], rounds=12, depth=1, rate=0.5, rows=1.0, columns=1.0).fit(df)
    assert max(walked) < 6 and len(dropped) == 2
    assert predictions(model, df) == pytest.approx(plain(x, y, 12, 1, 0.5))
