"""How plans grow: what meets in a shuffle, how often, and in which form."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from valora.catalogue import registry
from valora.operators import ranks, relational
from valora.plans.dataset import build_crosswalk


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    line = spark.range(400).select(
        (F.col("id") * 10).alias("l_orderkey"), (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 7).alias("l_suppkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") % 9 + 1).cast("double").alias("l_quantity"), F.col("id").cast("double").alias("l_extendedprice"), (F.col("id") % 3 / 100).alias("l_discount"),
        (F.col("id") % 5 / 100).alias("l_tax"), F.element_at(F.array(*map(F.lit, "ANR")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.date_add(F.lit(dt.date(1995, 1, 1)), (F.col("id") * 4).cast("int")).alias("l_shipdate"))
    part = spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("name "), "id").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
                                  F.lit("SMALL").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"))
    supplier = spark.createDataFrame([(i, i % 3) for i in range(6)] + [(None, 1)], "s_suppkey BIGINT, s_nationkey INT")
    nation = spark.createDataFrame([(i, i + 10) for i in range(3)], "n_nationkey INT, n_regionkey INT")
    for name, df in {"lineitem": line, "part": part, "supplier": supplier, "nation": nation}.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lines_are_not_shuffled_to_meet_few_suppliers(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4KB")
    try:
        found = registry.performances(spark, tables)
        plan = plan_of(found)
        rows = found.select("team_id", "league_id").distinct().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_suppkey" not in plan
    # Supplier 6 is not known.
    assert sorted(rows) == [(i, None if i == 6 else i % 3 + 10) for i in range(7)]


def test_values_are_placed_once_for_all_quantiles(spark, monkeypatch):
    placed = []
    monkeypatch.setattr(ranks, "value_positions", lambda *a, real=ranks.value_positions, **k: placed.append(a) or real(*a, **k))
    rows = spark.range(1001).select((F.col("id") % 2).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id").cast("double")).alias("x"))
    found = ranks.quantiles_of_counts(ranks.value_counts(rows, ["g"], "x"), ["g"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()
    expected = {(g, p): float(np.quantile([i for i in range(1001) if i % 7 and i % 2 == g], p)) for g in (0, 1) for p in (0.0, 0.1, 0.5, 0.99, 1.0)}
    assert {(r.g, r.p): r.quantile for r in found} == pytest.approx(expected) and len(placed) == 1


def test_repeated_people_are_combined_before_the_sort(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"), F.when(F.col("id") < 20, F.lit(None)).otherwise(F.translate((F.col("id") % 20 + 10).cast("string"), "0123456789", "abcdefghij")).alias("name"),
                                    F.lit(dt.date(2000, 1, 1)).alias("d"), (1000 - F.col("id")).alias("o"))
    found = relational.first_kind_per_key(rows, ["k"], ["o"], ["name", "d"])
    assert sorted(found.collect()) == sorted(relational.first_per_key(rows, ["k"], ["o"], ["name", "d"]).collect())
    people = build_crosswalk(rows.select(F.col("k").alias("api_player_id"), F.col("name").alias("full_name_norm"), F.col("name").alias("last_name_norm"), F.col("d").alias("dob"),
                                         F.col("o").alias("rec_ord")),
                             spark.createDataFrame([(1, "cb", "cb", dt.date(2000, 1, 1))], "player_id BIGINT, name STRING, last_name STRING, date_of_birth DATE"))
    assert {r.api_player_id: r.tm_player_id for r in people.collect()}[1] == 1
    keys = [line for line in plan_of(found).splitlines() if "HashAggregate(keys=[k" in line]
    assert any("name" in line.split("functions")[0] for line in keys)
