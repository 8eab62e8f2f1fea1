"""Orders packed into one number: equal to sorting by the columns, in hash aggregates, and never silently wrong."""

import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from builders import joined
from valora.operators import asof, relational, resolve
from valora.operators.order import Bits, row_order, with_ordered_bits, with_row_orders
from valora.plans.features import aggregate_multi_club


def test_bits_of_doubles(spark):
    r = random.Random(1)
    made = [struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(5000)]
    made += [2.0**k for k in range(-1074, 1024, 3)] + [math.nextafter(2.0**k, 0) for k in range(-1073, 1024, 3)]
    values = [x for x in [0.0, 5e-324, 1.7976931348623157e308, float("inf"), 0.1, *made, *(-x for x in made)] if x == x]
    rows = with_ordered_bits(spark.createDataFrame([(x,) for x in values], "x double"), {"bits": F.col("x")}).collect()
    assert all(abs(row.bits) == struct.unpack("q", struct.pack("d", abs(row.x)))[0] and (row.bits < 0) == (row.x < 0) for row in rows)
    nan = with_ordered_bits(spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double"), {"bits": F.col("x")}).collect()
    assert nan[0].bits > nan[1].bits


@pytest.mark.parametrize("columns", [["a"], ["b"], ["t", "a"], ["a", "b"], ["b", "a"], ["d", "b"], ["f", "t", "d", "a"], ["w", "d"], ["a", "w"], [Bits("s", 12), "b", "f"],
                                     ["d", Bits("s", 12), "w"], ["ts", "a", "t"]])
def test_order_of_rows(spark, columns):
    r = random.Random(7)
    some = lambda f: None if r.random() < 0.1 else f()
    rows = [(some(lambda: r.randint(-2**31, 2**31 - 1)), some(lambda: r.choice([-1.5, 0.0, 2.0**60, r.gauss(0, 1e9)])), some(lambda: r.randint(-128, 127)),
             some(lambda: dt.date(1900, 1, 1) + dt.timedelta(r.randint(0, 90000))), some(lambda: r.random() < 0.5), some(lambda: r.choice([-2**63, 2**63 - 1, r.getrandbits(62)])),
             some(lambda: r.randint(0, 4095)), some(lambda: dt.datetime(1969, 1, 1) + dt.timedelta(seconds=r.randint(0, 10**9)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "a int, b double, t tinyint, d date, f boolean, w long, s int, ts timestamp")
    names = [c.column if isinstance(c, Bits) else c for c in columns]
    df, order = with_row_orders(df, {"order": columns}), F.col("order")
    assert df.columns[-1] == "order" and df.select(order).schema[0].dataType.simpleString() in ("bigint", "decimal(38,0)")
    assert df.orderBy(order).select(*names).collect() == df.orderBy(*names).select(*names).collect()
    by_struct = df.groupBy("t").agg(F.min(F.struct(*names)).alias("least")).select("t", "least.*").collect()
    packed = df.groupBy("t").agg(*[F.min_by(n, order).alias(f"x_{n}") for n in names]).collect()
    assert sorted(map(tuple, by_struct), key=repr) == sorted(map(tuple, packed), key=repr)


def test_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, "x", 2, 3)], "a long, s string, b long, c long")
    for columns in (["s"], ["a", "b"], ["a", "b", "c"]):
        assert df.select(row_order(df, columns)).schema[0].dataType.typeName() == "struct"
    for bad in (-1, 16):
        with pytest.raises(Exception, match="has no 4 bits"):
            df.withColumn("k", F.lit(bad)).select(row_order(df.withColumn("k", F.lit(bad)), [Bits("k", 4)])).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_combined_without_a_sort(spark):
    orders = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2.0, 5)], "k long, d date, v double, o long")
    probes = spark.createDataFrame([(1, 2020)], "k long, season int")
    names = {"key": "k", "date": "d", "value": "v", "season": "season", "ties": ["v"]}
    for frame in (relational.first_per_key(orders, ["k"], ["d", "v"]), resolve.exact_match(orders, orders.withColumnRenamed("o", "id"), ["k"], "id", ["id"]),
                  asof.asof_nearest(orders, probes, **names), asof.asof_backward(orders, probes, outputs={"now": 0}, **names)):
        assert "SortAggregate" not in plan(frame) and "HashAggregate" in plan(frame)


def test_texts_are_combined_by_value_before_they_are_sorted(spark):
    """The only sort-based aggregate of a roll-up stands above the exchange that follows the hash aggregate of the texts."""
    lines = plan(aggregate_multi_club(joined(spark, {}), ["ord"])).splitlines()
    sorted_at = max(i for i, line in enumerate(lines) if "SortAggregate" in line)
    below = lines[sorted_at + 1:]
    assert any("Exchange" in line for line in below) and any("HashAggregate" in line for line in below)


def test_texts_of_many_kinds(spark):
    r = random.Random(3)
    people = [dict(api_player_id=i % 3, firstname=r.choice([None, "", "A", "B"]), lastname=r.choice([None, "C"]), position=r.choice([None, "Defender", "x"]), tm_player_id=r.choice([None, 4, 5]))
              for i in range(60)]
    df = joined(spark, *people)
    rows = sorted(df.collect(), key=lambda x: x.ord)
    for got in aggregate_multi_club(df.repartition(5), ["ord"]).collect():
        own = [x for x in rows if x.api_player_id == got.api_player_id]
        for c in ("firstname", "lastname", "position", "tm_player_id"):
            assert got[c] == next((x[c] for x in own if x[c] is not None), None)
