import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from valora.operators import asof, ranks, relational, stats


def dated(seed, keys=6, n=200):
    r = random.Random(seed)
    days = [dt.date(2015, 1, 1) + dt.timedelta(days=r.randrange(3000)) for _ in range(n)]
    days += [dt.date(y, 7, 1) for y in range(2016, 2020)] + [dt.date(2018, 6, 30), dt.date(2018, 7, 2)]
    return [(0 if r.random() < 0.4 else r.randrange(keys), d, r.choice([None, *range(1, 50)])) for d in days]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("direction, tolerance", [("nearest", None), ("nearest", 60), ("backward", None), ("forward", None)])
def test_nearest(spark, seed, direction, tolerance):
    rows = dated(seed)
    probes = [(k, s) for k in range(8) for s in range(2013, 2026, 2)]
    got = asof.asof_nearest(
        spark.createDataFrame(rows, "k INT, d DATE, v INT"), spark.createDataFrame(probes, "k INT, s INT"),
        key="k", date="d", value="v", season="s", ties=["v"], direction=direction, tolerance_days=tolerance)
    expected = set()
    for k, s in probes:
        target = dt.date(s + 1, 7, 1)
        known = [(abs((d - target).days), d, v) for i, d, v in rows if i == k and v is not None
                 and (direction == "nearest" or (d <= target if direction == "backward" else d >= target))]
        if known and (tolerance is None or min(known)[0] <= tolerance):
            _, d, v = min(known)
            expected.add((k, s, v, d))
    assert {tuple(r) for r in got.select("k", "s", "v", "d").collect()} == expected


def test_backward_offsets(spark):
    rows = dated(7)
    probes = [(k, s) for k in range(7) for s in range(2014, 2025)]
    got = asof.asof_backward(
        spark.createDataFrame(rows, "k INT, d DATE, v INT"), spark.createDataFrame(probes, "k INT, s INT"),
        key="k", date="d", value="v", season="s", outputs={"now": 0, "before": -1}, ties=["v"])

    def last(k, year):
        known = [(d, -v) for i, d, v in rows if i == k and v is not None and d <= dt.date(year, 7, 1)]
        return -max(known)[1] if known else None

    assert {tuple(r) for r in got.collect()} == {(k, s, last(k, s), last(k, s - 1)) for k, s in probes}


def numbers(seed):
    r = random.Random(seed)
    values = [None, 0.0, -0.0, 1.0, -1.0, 1e-9, 1e9, -3.5] + [round(r.gauss(0, 10), 2) for _ in range(200)] + [2.0] * 150
    return [(r.choice(["a", "b", None]), v, r.choice([None, *range(20)])) for v in values]


def test_pct_rank_equals_average_ties(spark):
    rows = numbers(1)
    got = ranks.pct_rank(spark.createDataFrame(rows, "g STRING, x DOUBLE, y INT"), ["g"], {"x": "px", "y": "py"}).toPandas()
    frame = pd.DataFrame(rows, columns=["g", "x", "y"])
    frame["px"] = frame.groupby("g")["x"].rank(pct=True)
    frame["py"] = frame.groupby("g")["y"].rank(pct=True)
    key = lambda f: sorted((str(r.g), str(None if pd.isna(r.x) else r.x + 0.0), str(None if pd.isna(r.y) else int(r.y)),
                            -1 if pd.isna(r.px) else round(r.px, 12), -1 if pd.isna(r.py) else round(r.py, 12))
                           for r in f.itertuples())
    assert key(got) == key(frame)


def test_bucket_is_monotone(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.normal(0, 1, 500), r.lognormal(5, 4, 500), -r.lognormal(-5, 4, 500), [0.0, 5e-324, 1.7e308]])
    df = spark.createDataFrame([(float(v),) for v in np.sort(x)], "x DOUBLE").select("x", ranks.magnitude_bucket(F.col("x")).alias("b"))
    buckets = [b for _, b in sorted(tuple(r) for r in df.collect())]
    assert buckets == sorted(buckets) and len(set(buckets)) > 1000


def test_quantile_and_group_stats(spark):
    frame = pd.DataFrame(numbers(2), columns=["g", "x", "y"]).dropna(subset=["g", "x"])
    df = spark.createDataFrame(list(frame[["g", "x"]].itertuples(index=False, name=None)), "g STRING, x DOUBLE")
    for q in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = dict(tuple(r) for r in ranks.exact_quantile(df, ["g"], "x", q, "q").collect())
        for g, v in frame.groupby("g")["x"].quantile(q).items():
            assert got[g] == pytest.approx(v)
    row = {r.g: r for r in stats.group_stats(df, ["g"], "x").collect()}
    assert row["a"].median == pytest.approx(frame[frame.g == "a"].x.median())
    assert stats.group_stats(df, [], "x").first().median == pytest.approx(frame.x.median())


def test_spearman(spark):
    frame = pd.DataFrame(numbers(3), columns=["g", "x", "y"]).dropna()
    df = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), "g STRING, x DOUBLE, y DOUBLE")
    got = dict(tuple(r) for r in ranks.spearman(df, ["g"], "x", "y").collect())
    for g, part in frame.groupby("g"):
        assert got[g] == pytest.approx(part.x.rank().corr(part.y.rank()))
    constant = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x DOUBLE, y DOUBLE")
    assert ranks.spearman(constant, [], "x", "y").first()[0] is None


def test_delta_skips_gap_seasons(spark):
    df = spark.createDataFrame([(1, 2020, 5), (1, 2021, 8), (1, 2023, 9), (2, 2021, None), (2, 2022, 1)], "id INT, season INT, g INT")
    got = {(r.id, r.season): r.delta_g for r in relational.period_delta(df, ["id"], "season", ["g"]).collect()}
    assert got == {(1, 2020): None, (1, 2021): 3, (1, 2023): None, (2, 2021): None, (2, 2022): None}


def test_null_rules_of_filters_and_joins(spark):
    df = spark.createDataFrame([(1, "Goalkeeper"), (2, None), (3, ""), (None, "Defender")], "id INT, p STRING")
    assert sorted(str(r.id) for r in relational.keep_other_than(df, "p", "goalkeeper").collect()) == ["2", "3", "None"]
    side = spark.createDataFrame([(1, "x"), (None, "y")], "id INT, tag STRING")
    assert {(r.id, r.tag) for r in relational.attach(df, side, ["id"]).collect()} == {(1, "x"), (2, None), (3, None), (None, None)}
    either = spark.createDataFrame([(1, 2), (2, 1), (1, 1), (3, None)], "a INT, b INT")
    ids = spark.createDataFrame([(1,), (1,)], "id INT")
    assert relational.or_semi_filter(either, ["a", "b"], ids).count() == 3


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "x DOUBLE")
    got = {r.bin: r.n for r in stats.histogram(df, "x", 5).collect()}
    assert got == dict(zip(range(1, 6), np.histogram(range(11), 5)[0]))
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x DOUBLE")
    assert [(r.bin, r.n) for r in stats.histogram(constant, "x", 5).collect()] == [(1, 2)]


def test_corr_matrix_pairwise_nulls(spark):
    frame = pd.DataFrame({"a": [1, 2, 3, 4, None], "b": [2, 1, None, 5, 6], "c": [1, 1, 2, 2, 3]}, dtype="float64")
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)], "a DOUBLE, b DOUBLE, c DOUBLE")
    expected = frame.corr()
    for r in stats.corr_matrix(df, ["a", "b", "c"]).collect():
        assert r["corr"] == pytest.approx(expected.loc[r.x, r.y])


def test_ranks_of_infinity_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    rows = spark.createDataFrame([(x,) for x in (0.5, nan, 1.0, inf, 2.0, -inf, None, 1e308, -1e308)], "x double")
    got = {str(r.x): r.x_pct for r in ranks.pct_rank(rows, [], ["x"]).collect()}
    order = ["-inf", "-1e+308", "0.5", "1.0", "2.0", "1e+308", "inf", "nan"]
    assert got == {**{k: (i + 1) / 8 for i, k in enumerate(order)}, "None": None}


@pytest.mark.parametrize("expression", ["1.7e9 + id", "1e9 + id / 1000", "pow(10, id / 5000 - 10)", "cast(id as double)"])
def test_no_bucket_holds_many_values(spark, expression):
    values = spark.range(100_000).selectExpr(f"{expression} AS x")
    low, high = values.agg(F.min("x"), F.max("x")).first()
    largest = values.groupBy(ranks.linear_bucket(F.col("x"), F.lit(low), F.lit(high)), ranks.magnitude_bucket(F.col("x"))).count().agg(F.max("count")).first()[0]
    assert largest <= 1000


def narrow_groups(spark):
    """Half of the values far from zero in a millionth of the whole range, one outlier beyond them; a wide group; a group of few values."""
    ids = spark.range(40_000)
    return ids.selectExpr("CASE WHEN id % 2 = 0 THEN 'narrow' WHEN id % 400 = 1 THEN NULL ELSE 'wide' END AS g",
                          "CASE WHEN id = 0 THEN 9e8 WHEN id % 2 = 0 THEN 5e8 + pmod(id * 7919, 40000) / 40 ELSE pmod(id * 104729, 40000) * 25e3 END AS x") \
        .unionByName(spark.createDataFrame([("few", 1.0), ("few", 1.0), ("few", 5.00000001e8)], "g STRING, x DOUBLE"))


def test_no_bucket_holds_many_values_of_a_narrow_group(spark):
    counts = ranks.value_counts(narrow_groups(spark), ["g"], "x")
    buckets = ranks.bucketed_counts(counts, ["g"], "__x").groupBy("g", "__b").count()
    assert buckets.agg(F.max("count")).first()[0] <= 0.01 * counts.count()
    one = ranks.value_counts(narrow_groups(spark).filter("g = 'narrow'"), [], "x")
    assert ranks.bucketed_counts(one, [], "__x").groupBy("__b").count().agg(F.max("count")).first()[0] <= 0.01 * one.count()


def test_buckets_follow_the_order_of_values(spark):
    odd = spark.createDataFrame([("narrow", float(x)) for x in ("-inf", "inf", "nan", "-1", "5e-324")], "g STRING, x DOUBLE")
    counts = ranks.value_counts(narrow_groups(spark).unionByName(odd), ["g"], "x")
    for _, part in ranks.bucketed_counts(counts, ["g"], "__x").orderBy("g", "__x").toPandas().groupby("g", dropna=False):
        buckets = [tuple(b) for b in part["__b"]]
        assert buckets == sorted(buckets)


def test_ranks_and_quantiles_of_narrow_groups(spark):
    df = narrow_groups(spark)
    frame = df.toPandas()
    got = ranks.pct_rank(df, ["g"], ["x"]).toPandas()
    expected = frame.assign(x_pct=frame.groupby("g")["x"].rank(pct=True))
    order = ["g", "x"]
    pd.testing.assert_frame_equal(got.sort_values(order, ignore_index=True), expected.sort_values(order, ignore_index=True), check_dtype=False)
    medians = {r.g: r.q for r in ranks.exact_quantile(df.filter("g IS NOT NULL"), ["g"], "x", 0.3, "q").collect()}
    assert medians == pytest.approx(frame.groupby("g")["x"].quantile(0.3).to_dict())


def test_more_groups_than_have_edges(spark):
    df = spark.range(9000).selectExpr("id % 3000 AS g", "CAST(id AS DOUBLE) AS x")
    counts = ranks.value_counts(df, ["g"], "x")
    assert ranks.group_edges(counts, ["g"], "__x").count() == 0
    assert ranks.pct_rank(df, ["g"], ["x"]).filter("round(x_pct * 3) != floor(x / 3000) + 1").count() == 0


def test_no_rows_no_ranks(spark):
    empty = spark.createDataFrame([], "g STRING, x DOUBLE")
    assert ranks.pct_rank(empty, ["g"], ["x"]).count() == 0 and ranks.exact_quantile(empty, ["g"], "x").count() == 0
    nothing = spark.createDataFrame([("a", float("nan")), ("a", None)], "g STRING, x DOUBLE")
    assert sorted(str(r.x_pct) for r in ranks.pct_rank(nothing, ["g"], ["x"]).collect()) == ["1.0", "None"]
