"""Descriptive statistics, sorts and set operations on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.catalogue.registry import query, rounded, table
from valora.operators import ranks, relational, stats
from valora.session import scratch_dir
from valora.sources import tables


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return stats.value_counts(table(spark, sf, "events"), "event_type")


@query("group_stats", """
SELECT c_mktsegment, round(median(o_totalprice), 4) AS median, round(avg(o_totalprice), 4) AS mean,
       max(o_totalprice) AS max
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment""")
def group_stats(spark, sf):
    priced = table(spark, sf, "orders").select("o_custkey", "o_totalprice").join(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), F.col("c_custkey") == F.col("o_custkey"))
    return rounded(stats.group_stats(priced, ["c_mktsegment"], "o_totalprice"), 4, "median", "mean")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("corr_matrix", "WITH l AS (SELECT * REPLACE (nullif(l_tax, 0) AS l_tax) FROM lineitem) "
       + " UNION ALL ".join(
           f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 9) AS corr FROM l" for a in _CORR for b in _CORR))
def corr_matrix(spark, sf):
    line = table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return rounded(stats.corr_matrix(line, _CORR), 9, "corr")


@query("histogram", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(40, floor((o_totalprice - lo) / ((hi - lo) / 40)) + 1) AS INTEGER) AS bin, count(*) AS n,
       round(min(lo + (hi - lo) / 40 * (least(40, floor((o_totalprice - lo) / ((hi - lo) / 40)) + 1) - 1)), 6) AS bin_start
FROM orders, b GROUP BY 1""")
def histogram(spark, sf):
    return rounded(stats.histogram(table(spark, sf, "orders"), "o_totalprice", 40), 6, "bin_start")


@query("histogram_by_group", """
WITH b AS (SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY ALL)
SELECT o_orderstatus, CAST(least(30, floor((o_totalprice - lo) / ((hi - lo) / 30)) + 1) AS INTEGER) AS bin, count(*) AS n
FROM orders JOIN b USING (o_orderstatus) GROUP BY ALL""")
def histogram_by_group(spark, sf):
    return stats.histogram(table(spark, sf, "orders"), "o_totalprice", 30, ["o_orderstatus"]).drop("bin_start")


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(spark, sf):
    return relational.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, "o_totalprice",
                            ["o_orderkey"])


@query("sort_report", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ALL""")
def sort_report(spark, sf):
    report = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return report.orderBy("o_orderpriority", F.desc_nulls_last("total"), "o_orderstatus")


@query("union_results", """
SELECT 'status' AS label, o_orderstatus AS value, count(*) AS n, NULL::DOUBLE AS total FROM orders GROUP BY ALL
UNION ALL SELECT 'priority', o_orderpriority, count(*), round(sum(o_totalprice), 2) FROM orders GROUP BY ALL""")
def union_results(spark, sf):
    orders = table(spark, sf, "orders")
    by_status = orders.groupBy(F.col("o_orderstatus").alias("value")).agg(F.count("*").alias("n"))
    by_priority = orders.groupBy(F.col("o_orderpriority").alias("value")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return by_status.withColumn("label", F.lit("status")).unionByName(
        by_priority.withColumn("label", F.lit("priority")), allowMissingColumns=True)


@query("distinct_suite", """
SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS seasons, count(DISTINCT o_orderstatus) AS statuses,
       array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities, CAST(max(year(o_orderdate)) AS INTEGER) AS newest
FROM orders GROUP BY o_custkey""")
def distinct_suite(spark, sf):
    """Distinct counts, the sorted distinct labels (a fixed small set) and the newest season."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.countDistinct(F.year("o_orderdate")).alias("seasons"), F.countDistinct("o_orderstatus").alias("statuses"),
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), ",").alias("priorities"),
        F.max(F.year("o_orderdate")).alias("newest"))


_SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey"]


@query("distinct_sketches", f"""
WITH l AS (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS season FROM lineitem)
{" UNION ALL ".join(f"SELECT {span} AS span, '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS within FROM l GROUP BY 1" for c in _SKETCHED for span in ("season // 3", "-1"))}""")
def distinct_sketches(spark, sf):
    """Sketches stored per season, merged for spans of three seasons and for all; whether they are within 2 % of the exact counts."""
    line = table(spark, sf, "lineitem").select(*_SKETCHED, F.year("l_shipdate").alias("season"))
    path = scratch_dir(spark, "sketches")
    tables.write_table(stats.distinct_sketches(line, ["season"], _SKETCHED, 16), path)
    # Every season counts for its span and for the total.
    spans = F.explode(F.array(F.floor(F.col("season") / 3).cast("int"), F.lit(-1)))
    estimated = stats.merged_distinct(tables.read_table(spark, path).withColumn("span", spans), ["span"], _SKETCHED)
    melted = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_count").alias("estimate")) for c in _SKETCHED]))
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("value")) for c in _SKETCHED]))
    exact = line.select("season", values).distinct().select("column_name", "value", spans.alias("span")).distinct() \
        .groupBy("span", "column_name").agg(F.count("*").alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= 0.02 * F.col("exact")
    return exact.join(estimated.select("span", melted), ["span", "column_name"]).select("span", "column_name", "exact", near.alias("within"))


@query("distinct_pairs", """
SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders
ORDER BY season DESC, o_custkey LIMIT 50""")
def distinct_pairs(spark, sf):
    """Head of the distinct customer seasons, newest first."""
    return table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("season")).distinct() \
        .orderBy(F.desc("season"), "o_custkey").limit(50)


@query("spearman_rank", """
WITH r AS (
  SELECT o_orderpriority,
    rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice)
      + (count(*) OVER (PARTITION BY o_orderpriority, o_totalprice) - 1) / 2.0 AS a,
    rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate)
      + (count(*) OVER (PARTITION BY o_orderpriority, o_orderdate) - 1) / 2.0 AS b
  FROM orders)
SELECT o_orderpriority, round(corr(a, b), 9) AS spearman FROM r GROUP BY o_orderpriority""")
def spearman_rank(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderpriority", "o_totalprice", F.unix_date(F.col("o_orderdate").cast("date")).alias("day"))
    return rounded(ranks.spearman(orders, ["o_orderpriority"], "o_totalprice", "day"), 9, "spearman")


# A group far from zero, a millionth as wide as the range of all groups, beside one over the whole range.
_SPREAD = "CASE l_returnflag WHEN 'R' THEN 5e8 + l_extendedprice / 100 WHEN 'N' THEN l_extendedprice * 1e4 ELSE l_extendedprice END"


@query("narrow_group_ranks", f"""
WITH l AS (SELECT l_returnflag, {_SPREAD} AS x FROM lineitem),
r AS (SELECT l_returnflag, x, rank() OVER (PARTITION BY l_returnflag ORDER BY x) + (count(*) OVER (PARTITION BY l_returnflag, x) - 1) / 2.0 AS rank,
             count(*) OVER (PARTITION BY l_returnflag) AS total FROM l)
SELECT l_returnflag, x, round(min(rank / total), 9) AS x_pct, count(*) AS n FROM r GROUP BY l_returnflag, x""")
def narrow_group_ranks(spark, sf):
    """Rank and number of rows of every distinct value, in groups of very different ranges."""
    line = table(spark, sf, "lineitem").select("l_returnflag", F.expr(_SPREAD).alias("x"))
    ranked = ranks.pct_rank(line, ["l_returnflag"], ["x"])
    return rounded(ranked.groupBy("l_returnflag", "x", "x_pct").agg(F.count("*").alias("n")), 9, "x_pct")


@query("narrow_group_quantiles", f"""
WITH l AS (SELECT l_returnflag, {_SPREAD} AS x FROM lineitem)
{" UNION ALL ".join(f"SELECT l_returnflag, {p}::DOUBLE AS p, round(quantile_cont(x, {p}), 4) AS quantile FROM l GROUP BY 1" for p in (0.1, 0.5, 0.99))}""")
def narrow_group_quantiles(spark, sf):
    """Exact quantiles of the same groups, all from one table of counts."""
    line = table(spark, sf, "lineitem").select("l_returnflag", F.expr(_SPREAD).alias("x"))
    counts = ranks.value_counts(line, ["l_returnflag"], "x")
    return rounded(ranks.quantiles_of_counts(counts, ["l_returnflag"], [0.1, 0.5, 0.99]), 4, "quantile")


@query("global_stats", """
SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median, max(o_totalprice) AS max FROM orders""")
def global_stats(spark, sf):
    return rounded(stats.group_stats(table(spark, sf, "orders"), [], "o_totalprice"), 4, "mean", "median") \
        .select("mean", "median", "max")
