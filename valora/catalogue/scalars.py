"""Scalar expressions, projections and filters on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.catalogue.registry import query, table
from valora.functions import dates, labels, numeric, text
from valora.operators import relational

_NORMALIZED = """trim(regexp_replace(regexp_replace(lower(strip_accents(
  replace(replace(replace({c}, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae'))), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g'))"""


@query("normalize_text", f"SELECT doc_id, {_NORMALIZED.format(c='text')} AS normalized FROM documents")
def normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("normalized"))


@query("season_label", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '/' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') AS label
FROM orders""")
def season_label(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.season_label(F.year("o_orderdate")).alias("label"))


@query("season_parse", """
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE
  ' ' || right(CAST(year(o_orderdate) AS VARCHAR), 2) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) END AS label
  FROM orders),
n AS (SELECT o_orderkey, try_cast(trim(split_part(label, '/', 1)) AS INTEGER) AS n FROM l)
SELECT o_orderkey, CASE WHEN n < 100 THEN n + 2000 ELSE n END AS season,
       CASE WHEN n < 100 AND n >= 50 THEN n + 1900 WHEN n < 100 THEN n + 2000 ELSE n END AS pivoted FROM n""")
def season_parse(spark, sf):
    year = F.year("o_orderdate")
    short = lambda y: F.right(y.cast("string"), F.lit(2))
    label = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")) \
        .otherwise(F.concat(F.lit(" "), short(year), F.lit("/"), short(year + 1)))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.season_start_year(label).alias("season"),
        dates.season_start_year(label, pivot=50).alias("pivoted"))


@query("projection_suite", """
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS priority,
       o_orderstatus || ' ' || coalesce(nullif(o_orderpriority, '5-LOW'), '') AS label, lower(o_orderpriority) AS lowered,
       CASE WHEN o_orderpriority LIKE '1-%' THEN substr(o_orderpriority, 3) ELSE o_orderpriority END AS stripped,
       round_even(o_totalprice / 1e6, 1) AS price_m, abs(o_totalprice - 250000) AS distance,
       CASE WHEN o_totalprice - 250000 < 0 THEN 0 ELSE o_totalprice - 250000 END AS above,
       o_custkey + nullif(o_custkey, 5) AS doubled, coalesce(nullif(o_custkey, 5), -1) AS filled,
       '€' || printf('%.1f', round_even(o_totalprice / 1e6, 1)) || 'M' AS money
FROM orders""")
def projection_suite(spark, sf):
    orders = table(spark, sf, "orders").withColumnsRenamed({"o_totalprice": "price", "o_orderpriority": "raw_priority"})
    priority = F.nullif("raw_priority", F.lit("5-LOW"))
    key = F.nullif("o_custkey", F.lit(5).cast("long"))
    gap = F.col("price") - 250000
    wide = orders.withColumns({
        "priority": F.coalesce(priority, F.lit("")), "label": text.full_name(F.col("o_orderstatus"), priority),
        "lowered": F.lower("raw_priority"), "stripped": text.strip_prefix(F.col("raw_priority"), "1-"),
        "price_m": numeric.to_millions(F.col("price"), 1), "distance": F.abs(gap),
        "above": numeric.clip_lower(gap, 0.0), "doubled": F.col("o_custkey") + key,
        "filled": F.coalesce(key, F.lit(-1)), "money": labels.money_text(F.col("price")),
    }).drop("price", "raw_priority")
    keep = relational.columns_with(wide, exclude=relational.columns_with(wide, prefix="o_"))
    return wide.select("o_orderkey", *keep)


@query("filter_suite", """
WITH o AS (SELECT o_orderkey, nullif(o_custkey, 11) AS custkey, o_totalprice, o_orderstatus, year(o_orderdate) AS y FROM orders),
kept AS (SELECT * FROM o WHERE custkey IS NOT NULL AND o_totalprice > 100000 AND y < 2001 AND o_orderstatus IN ('F', 'P')
         AND NOT (o_orderstatus = 'P' AND o_totalprice > 450000))
SELECT o_orderkey, custkey, CASE WHEN o_totalprice < 200000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_small FROM kept
QUALIFY count(*) OVER (PARTITION BY custkey) >= 3""")
def filter_suite(spark, sf):
    """Null drops, comparisons, an expression filter and a minimum group size."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(11).cast("long")).alias("custkey"), "o_totalprice", "o_orderstatus",
        "o_orderdate")
    kept = orders.transform(relational.known, "custkey").filter(
        (F.col("o_totalprice") > 100000) & (F.year("o_orderdate") < 2001) & F.col("o_orderstatus").isin("F", "P")
    ).filter("NOT (o_orderstatus = 'P' AND o_totalprice > 450000)")
    return relational.large_groups(kept, ["custkey"], 3).select(
        "o_orderkey", "custkey", numeric.indicator(F.col("o_totalprice") < 200000).alias("is_small"))


@query("pattern_lookup", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), '^(red|blue) .*(ring|rod)')""")
def pattern_lookup(spark, sf):
    return table(spark, sf, "part").filter(text.matches(F.col("p_name"), "^(Red|Blue) .*(ring|rod)")) \
        .select("p_partkey", "p_name")


@query("parse_suite", """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed,
  CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice END AS fee,
  strftime(o_orderdate, '%Y-%m-%d') AS day_text, round(ln(1 + o_totalprice), 9) AS log_price,
  round(exp(ln(1 + o_totalprice)) - 1, 2) AS back
FROM orders""")
def parse_suite(spark, sf):
    broken = F.col("o_orderstatus") == "P"
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf, "orders").withColumns({
        "day_text": day, "fee_text": F.when(broken, "free transfer").otherwise(F.col("o_totalprice").cast("string"))})
    return orders.select(
        "o_orderkey", dates.parse_date(F.when(broken, F.concat(F.lit("x"), F.col("day_text"))).otherwise(F.col("day_text")))
        .alias("parsed"),
        numeric.parse_number(F.col("fee_text"), 0.0).alias("fee"), "day_text",
        F.round(F.log1p("o_totalprice"), 9).alias("log_price"),
        F.round(F.expm1(F.log1p("o_totalprice")), 2).alias("back"))


@query("json_props", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total,
       count(json_extract_string(props, '$.k')) AS known FROM events GROUP BY event_type""")
def json_props(spark, sf):
    events = table(spark, sf, "events").select("event_type", F.from_json("props", "k INT").alias("p"))
    return events.groupBy("event_type").agg(F.sum("p.k").alias("total"), F.count("p.k").alias("known"))
