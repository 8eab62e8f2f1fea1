"""Ranks of several columns in one pass, and left joins that deal null keys out."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from valora.operators import ranks, relational


def test_one_pass_equals_one_join_per_column(spark):
    r = random.Random(8)
    rows = [(i, i % 7, r.choice(["a", "b", None]), r.choice([None, 0.0, -0.0, 1.5, r.gauss(0, 1)]), r.choice([None, 1, 2, 3]), None) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, s int, g string, x double, y int, z double").repartition(6)
    names = {"x": "px", "y": "py", "z": "pz"}
    got = {r.k: r for r in ranks.pct_rank(df, ["g"], names, keys=["k", "s"]).collect()}
    want = {r.k: r for r in ranks.pct_rank(df, ["g"], names).collect()}
    assert got == want and len(got) == 500
    frame = pd.DataFrame(rows, columns=["k", "s", "g", "x", "y", "z"])
    for source, target in (("x", "px"), ("y", "py")):
        expected = frame.groupby("g")[source].rank(pct=True)
        found = pd.Series([got[k][target] for k in frame["k"]], dtype="float64")
        assert np.allclose(found[frame["g"].notna()], expected[frame["g"].notna()], equal_nan=True)
        assert found[frame["g"].isna()].isna().all()


def test_without_groups_or_rows(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 1.0), (4, None)], "k int, x double")
    assert [(r.k, r.x_pct) for r in ranks.pct_rank(df, [], ["x"], keys=["k"]).orderBy("k").collect()] == [(1, 1.0), (2, 0.5), (3, 0.5), (4, None)]
    assert ranks.pct_rank(df.limit(0), [], ["x"], keys=["k"]).collect() == []


def test_wide_rows_are_shuffled_once(spark):
    """However many columns are ranked, one join takes the ranks back."""
    df = spark.range(100).select("id", *[(F.col("id") * i % 13).cast("double").alias(f"c{i}") for i in range(6)], F.lit("wide").alias("text"))
    joins = [ranks.pct_rank(df, [], columns, keys=["id"])._jdf.queryExecution().optimizedPlan().toString().count("Join ") for columns in (["c1"], ["c1", "c2", "c3", "c4"])]
    assert joins[0] == joins[1]


def test_spread_left_join(spark):
    df = spark.createDataFrame([(i, None if i % 2 else i % 4, i % 3 or None) for i in range(60)], "row int, a int, b int")
    right = spark.createDataFrame([(0, 1, "x"), (2, 2, "y"), (None, 1, "never")], "a int, b int, v string")
    got = relational.spread_left_join(df, right, ["a", "b"], ["row"])
    assert got.columns == ["row", "a", "b", "v"]
    assert sorted(got.collect(), key=lambda r: r.row) == sorted(df.join(right, ["a", "b"], "left").select("row", "a", "b", "v").collect(), key=lambda r: r.row)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = relational.spread_left_join(df, right.hint("merge"), ["a", "b"], ["row"]) \
            .select(F.spark_partition_id().alias("task"), F.col("a").isNull().alias("unknown")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r.unknown for r in sizes) > 4
