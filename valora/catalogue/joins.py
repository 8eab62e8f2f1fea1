"""Join, selection and resolution operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.catalogue.registry import LINE_ORDER, query, rounded, table
from valora.functions.dates import day_distance, season_day
from valora.functions.text import full_name, normalize_name
from valora.operators import asof, relational, resolve
from valora.sources.tables import filter_market

_CUSTOMER_YEARS = """
probes AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders),
dated AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice, o_orderkey FROM orders)"""


def _customer_years(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderkey")
    return orders, orders.select("o_custkey", F.year("o_orderdate").alias("season")).distinct()


@query("asof_nearest", f"""
WITH {_CUSTOMER_YEARS},
near AS (
  SELECT p.o_custkey, p.season, d.o_totalprice, d.d AS o_orderdate,
         abs(date_diff('day', d.d, make_date(p.season + 1, 7, 1))) AS days_off, d.o_orderkey
  FROM probes p JOIN dated d USING (o_custkey)
  QUALIFY row_number() OVER (PARTITION BY p.o_custkey, p.season
                             ORDER BY days_off, d.d, d.o_totalprice, d.o_orderkey) = 1)
SELECT o_custkey, season, o_totalprice, o_orderdate, CAST(days_off AS INTEGER) AS days_off FROM near""")
def asof_nearest(spark, sf):
    orders, years = _customer_years(spark, sf)
    found = asof.asof_nearest(orders, years, key="o_custkey", date="o_orderdate", value="o_totalprice",
                              season="season", ties=["o_totalprice"])
    return found.withColumn("days_off", day_distance(F.col("o_orderdate"), season_day(F.col("season"))))


@query("asof_backward", f"""
WITH {_CUSTOMER_YEARS},
snaps AS (
  SELECT p.o_custkey, p.season, k.shift, d.o_totalprice AS v
  FROM probes p CROSS JOIN (VALUES (0), (-1)) k(shift)
  JOIN dated d ON d.o_custkey = p.o_custkey AND d.d <= make_date(p.season + k.shift, 7, 1)
  QUALIFY row_number() OVER (PARTITION BY p.o_custkey, p.season, k.shift
                             ORDER BY d.d DESC, d.o_totalprice, d.o_orderkey) = 1)
SELECT p.o_custkey, p.season, a.v AS value_now, b.v AS value_before, round(ln(1 + a.v), 9) AS log_prev_value,
       round(ln(1 + a.v) - ln(1 + b.v), 9) AS value_trend
FROM probes p LEFT JOIN snaps a ON a.o_custkey = p.o_custkey AND a.season = p.season AND a.shift = 0
LEFT JOIN snaps b ON b.o_custkey = p.o_custkey AND b.season = p.season AND b.shift = -1""")
def asof_backward(spark, sf):
    orders, years = _customer_years(spark, sf)
    snaps = asof.asof_backward(orders, years, key="o_custkey", date="o_orderdate", value="o_totalprice",
                               season="season", outputs={"value_now": 0, "value_before": -1},
                               ties=["o_totalprice"])
    trend = F.log1p("value_now") - F.log1p("value_before")
    return snaps.withColumns({"log_prev_value": F.round(F.log1p("value_now"), 9), "value_trend": F.round(trend, 9)})


@query("semi_filter", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def semi_filter(spark, sf):
    filled = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return relational.semi_filter(table(spark, sf, "customer"), filled, {"c_custkey": "o_custkey"}) \
        .select("c_custkey", "c_name")


@query("or_semi_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2'))
   OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 1000)""")
def or_semi_filter(spark, sf):
    parts = table(spark, sf, "part").filter(F.col("p_brand").isin("Brand#1", "Brand#2")).select("p_partkey")
    poor = table(spark, sf, "supplier").filter("s_acctbal < 1000").select("s_suppkey")
    return relational.or_semi_filter(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
        ["l_partkey", "l_suppkey"], {"l_partkey": parts, "l_suppkey": poor})


@query("dedupe_first", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def dedupe_first(spark, sf):
    return relational.first_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                    ["o_orderkey", "o_totalprice", "o_orderstatus"])


@query("exact_match", """
WITH r AS (SELECT p_name, p_brand, max(p_partkey) AS last_id, min(p_partkey) AS first_id FROM part GROUP BY ALL)
SELECT p.p_partkey, r.last_id, r.first_id FROM part p LEFT JOIN r
  ON r.p_name = nullif(p.p_name, 'red ring') AND r.p_brand = p.p_brand""")
def exact_match(spark, sf):
    part = table(spark, sf, "part")
    left = part.select("p_partkey", F.nullif("p_name", F.lit("red ring")).alias("p_name"), "p_brand")
    right = part.select(F.col("p_partkey").alias("right_id"), "p_name", "p_brand")
    last = resolve.exact_match(left, right, ["p_name", "p_brand"], "right_id", ["right_id"], "last", "last_id")
    both = resolve.exact_match(last, right, ["p_name", "p_brand"], "right_id", ["right_id"], "first", "first_id")
    return both.select("p_partkey", "last_id", "first_id")


def _two_catalogues(spark, sf):
    """The same parts as two sources spell them: by type, one keeps the name, abbreviates the
    first word, misspells it, or names something else. Brand and size must agree."""
    part = table(spark, sf, "part")
    block = F.concat_ws("/", "p_brand", "p_size")
    word = F.split("p_name", " ")
    spelled = F.when(F.col("p_type").isin("ECONOMY", "PROMO"), F.col("p_name")) \
        .when(F.col("p_type") == "SMALL", F.concat(F.substring("p_name", 1, 1), F.lit(". "), word[1])) \
        .when(F.col("p_type") == "STANDARD", F.reverse("p_name")) \
        .otherwise(F.concat(F.regexp_replace(word[1], "(.)$", "$1s"), F.lit(" "), F.translate(word[0], "ae", "áé")))
    left = part.select("p_partkey", normalize_name(spelled).alias("full"),
                       normalize_name(F.element_at(F.split(spelled, " "), -1)).alias("last"), block.alias("block"))
    right = part.select(F.col("p_partkey").alias("right_id"), normalize_name(F.col("p_name")).alias("full"),
                        normalize_name(word[1]).alias("last"), block.alias("block"))
    return left, right


_EXACT_SQL = """
src AS (
  SELECT p_partkey, p_brand || '/' || p_size AS block, p_name AS name, split_part(p_name, ' ', 2) AS noun,
    CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN p_name
         WHEN p_type = 'SMALL' THEN p_name[1:1] || ' ' || split_part(p_name, ' ', 2)
         WHEN p_type = 'STANDARD' THEN reverse(p_name)
         ELSE split_part(p_name, ' ', 2) || 's ' || split_part(p_name, ' ', 1) END AS spelled
  FROM part),
l AS (SELECT p_partkey, block, spelled, split_part(spelled, ' ', -1) AS last FROM src),
f AS (SELECT name, block, max(p_partkey) AS id FROM src GROUP BY ALL),
s AS (SELECT noun, block, min(p_partkey) AS id FROM src GROUP BY ALL)"""


def _token_set_score(a: str, b: str) -> str:
    """SQL for the token-set score of two names: rows of the longest common subsequence, one letter after another."""
    tokens = lambda x: f"list_sort(list_distinct(string_split({x}, ' ')))"
    row = ("list_reduce([list_transform(range(0, length(ra) + 1), lambda j: 0)] || list_transform(string_split(rb, ''), lambda c: [ascii(c)]), "
           "lambda row, c: list_transform(range(1, length(ra) + 2), lambda j: list_max(list_transform(range(1, j + 1), "
           "lambda i: greatest(row[i], CASE WHEN i > 1 AND ascii(ra[i - 1]) = c[1] THEN row[i - 1] + 1 ELSE 0 END)))))")
    part = lambda d, t: f"100.0::DOUBLE - 100.0::DOUBLE * ({d}) / ({t})"
    return f"""(SELECT CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE WHEN p > 0 AND (ra = '' OR rb = '') THEN 100.0::DOUBLE
  ELSE greatest({part("length(ra) + length(rb) - 2 * l", "2 * (p + g) + length(ra) + length(rb)")},
                CASE WHEN p > 0 THEN greatest({part("g + length(ra)", "2 * p + g + length(ra)")}, {part("g + length(rb)", "2 * p + g + length(rb)")}) ELSE 0 END) END
FROM (SELECT *, CASE WHEN p > 0 THEN 1 ELSE 0 END AS g, coalesce({row}[length(ra) + 1], 0) AS l
      FROM (SELECT length(array_to_string(list_intersect({tokens(a)}, {tokens(b)}), ' ')) AS p,
                   array_to_string(list_filter({tokens(a)}, lambda x: NOT list_contains({tokens(b)}, x)), ' ') AS ra,
                   array_to_string(list_filter({tokens(b)}, lambda x: NOT list_contains({tokens(a)}, x)), ' ') AS rb)))"""


def _cascade_sql(names: str) -> str:
    """All four tiers over tables l (id, block, spelled, last) and src (id, block, name, noun)."""
    return f"""
{names},
f AS (SELECT name, block, max(id) AS id FROM src GROUP BY ALL), s AS (SELECT noun, block, min(id) AS id FROM src GROUP BY ALL),
tiers AS (SELECT l.id AS left_id, l.block, l.spelled, f.id AS full_id, s.id AS last_id FROM l LEFT JOIN f ON f.name = l.spelled AND f.block = l.block
          LEFT JOIN s ON s.noun = l.last AND s.block = l.block),
open_ AS (SELECT DISTINCT block, spelled FROM tiers WHERE full_id IS NULL AND last_id IS NULL),
names_ AS (SELECT block, name, max(id) AS id, min(id) AS ord FROM src GROUP BY ALL),
pairs AS (SELECT o.block, o.spelled, n.id, n.ord, {_token_set_score("o.spelled", "n.name")} AS score FROM open_ o JOIN names_ n ON n.block = o.block),
near AS (SELECT block, spelled, id FROM pairs WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY block, spelled ORDER BY score DESC, ord) = 1),
matched AS (SELECT left_id, coalesce(full_id, last_id, near.id) AS matched_id,
                   CASE WHEN full_id IS NOT NULL THEN 'exact_full' WHEN last_id IS NOT NULL THEN 'exact_last'
                        WHEN near.id IS NOT NULL THEN 'fuzzy' ELSE 'unmatched' END AS match_method
            FROM tiers LEFT JOIN near ON near.block = tiers.block AND near.spelled = tiers.spelled)"""


_CATALOGUES_SQL = _cascade_sql("""
parts AS (SELECT p_partkey, p_brand || '/' || p_size AS block, p_name, p_type, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2 FROM part),
src AS (SELECT p_partkey AS id, block, p_name AS name, w2 AS noun FROM parts),
l AS (SELECT id, block, spelled, split_part(spelled, ' ', -1) AS last FROM (
  SELECT p_partkey AS id, block, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN p_name WHEN p_type = 'SMALL' THEN p_name[1:1] || ' ' || w2
         WHEN p_type = 'STANDARD' THEN reverse(p_name) ELSE w2 || 's ' || w1 END AS spelled FROM parts))""")


def _matched(spark, sf):
    left, right = _two_catalogues(spark, sf)
    return resolve.resolve(left, right, left_id="p_partkey", right_id="right_id", full="full", last="last",
                           block="block", order_cols=["right_id"])


@query("resolve_cascade", f"WITH {_CATALOGUES_SQL} SELECT left_id AS p_partkey, matched_id, match_method FROM matched")
def resolve_cascade(spark, sf):
    return _matched(spark, sf)


_VOWELS = "aeiou"
_CROWDED_SQL = _cascade_sql("""
parts AS (SELECT p_partkey, 'b' || p_size % 20 AS block, p_type, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
                 translate(split_part(p_brand, '#', 2), '0123456789', 'zukavireto') AS code FROM part),
src AS (SELECT p_partkey AS id, block, w1 || ' ' || w2 || ' ' || code AS name, code || 'x' AS noun FROM parts),
l AS (SELECT p_partkey AS id, block, CASE p_type WHEN 'ECONOMY' THEN code || ' ' || w2 || ' ' || w1 || 'e' WHEN 'SMALL' THEN w1[2:] || ' ' || w2 || ' ' || code
        WHEN 'MEDIUM' THEN translate(w1, 'aeiou', 'eioua') || ' ' || translate(w2, 'aeiou', 'eioua') || ' ' || code
        WHEN 'LARGE' THEN w1 || w2 || ' ' || code || 'y' WHEN 'STANDARD' THEN reverse(w2) || ' ' || code ELSE w1 || ' ' || w2 || ' ' || code END AS spelled, 'none' AS last FROM parts)""")


@query("resolve_crowded", f"WITH {_CROWDED_SQL} SELECT left_id AS p_partkey, matched_id, match_method FROM matched")
def resolve_crowded(spark, sf):
    """The cascade in few blocks of many names each, differently misspelled by type."""
    part, word = table(spark, sf, "part"), F.split("p_name", " ")
    block = F.concat(F.lit("b"), F.col("p_size") % 20)
    first, second, code = word[0], word[1], F.translate(F.split("p_brand", "#")[1], "0123456789", "zukavireto")
    shifted = lambda w: F.translate(w, _VOWELS, _VOWELS[1:] + _VOWELS[0])
    kind = F.col("p_type")
    spelled = F.when(kind == "ECONOMY", F.concat_ws(" ", code, second, F.concat(first, F.lit("e")))) \
        .when(kind == "SMALL", F.concat_ws(" ", F.substr(first, F.lit(2)), second, code)) \
        .when(kind == "MEDIUM", F.concat_ws(" ", shifted(first), shifted(second), code)) \
        .when(kind == "LARGE", F.concat(first, second, F.lit(" "), code, F.lit("y"))) \
        .when(kind == "STANDARD", F.concat_ws(" ", F.reverse(second), code)).otherwise(F.concat_ws(" ", first, second, code))
    left = part.select("p_partkey", spelled.alias("full"), F.lit("none").alias("last"), block.alias("block"))
    right = part.select(F.col("p_partkey").alias("right_id"), F.concat_ws(" ", first, second, code).alias("full"), F.concat(code, F.lit("x")).alias("last"), block.alias("block"))
    return resolve.resolve(left, right, left_id="p_partkey", right_id="right_id", full="full", last="last", block="block", order_cols=["right_id"])


def _exact_only(spark, sf):
    left, right = _two_catalogues(spark, sf)
    tiers = resolve.exact_tiers(left, right, left_id="p_partkey", right_id="right_id", full="full", last="last",
                                block="block", order_cols=["right_id"])
    return tiers.select("p_partkey", F.coalesce("__full_id", "__last_id").alias("matched_id"),
                        resolve.method_of(("__full_id", "exact_full"), ("__last_id", "exact_last"))
                        .alias("match_method"))


@query("resolve_exact_tiers", f"""
WITH {_EXACT_SQL}
SELECT l.p_partkey, coalesce(f.id, s.id) AS matched_id,
       CASE WHEN f.id IS NOT NULL THEN 'exact_full' ELSE 'exact_last' END AS match_method
FROM l LEFT JOIN f ON f.name = l.spelled AND f.block = l.block
LEFT JOIN s ON s.noun = l.last AND s.block = l.block
WHERE f.id IS NOT NULL OR s.id IS NOT NULL""")
def resolve_exact_tiers(spark, sf):
    return _exact_only(spark, sf).filter("matched_id IS NOT NULL")


@query("match_rate", f"""
WITH {_CATALOGUES_SQL}
SELECT count(*) AS total, count(matched_id) AS matched, round(100.0 * count(matched_id) / count(*), 9)::DOUBLE AS match_pct,
       count(*) FILTER (match_method = 'exact_full') AS exact_full, count(*) FILTER (match_method = 'exact_last') AS exact_last,
       count(*) FILTER (match_method = 'fuzzy') AS fuzzy, count(*) FILTER (match_method = 'unmatched') AS unmatched FROM matched""")
def match_rate(spark, sf):
    """Coverage of the whole cascade."""
    return rounded(resolve.match_rate(_matched(spark, sf)), 9, "match_pct")


@query("load_bundle", """
WITH clubs AS (SELECT s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey IN (1, 3)),
vals AS (SELECT l_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
         JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey IN (1, 3))
SELECT 'clubs' AS part_of_bundle, count(*) AS n FROM clubs
UNION ALL SELECT 'valuations', count(*) FROM vals
UNION ALL SELECT 'players', count(*) FROM part WHERE p_partkey IN (SELECT l_partkey FROM vals)
UNION ALL SELECT 'transfers', count(*) FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM clubs)
     OR l_orderkey % (SELECT count(*) FROM supplier) IN (SELECT s_suppkey FROM clubs)""")
def load_bundle(spark, sf):
    """The four market tables restricted to two regions: suppliers are clubs, lines are valuations and
    transfers, parts are players."""
    region = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("club_id"), F.col("n_regionkey").cast("string").alias("domestic_competition_id"))
    line = table(spark, sf, "lineitem")
    clubs_total = table(spark, sf, "supplier").agg(F.count("*")).scalar()
    valuations = line.join(region, F.col("l_suppkey") == F.col("club_id")).select(
        F.col("l_partkey").alias("player_id"),
        F.col("domestic_competition_id").alias("player_club_domestic_competition_id"))
    transfers = line.select(F.col("l_suppkey").alias("from_club_id"),
                            (F.col("l_orderkey") % clubs_total).alias("to_club_id"))
    players = table(spark, sf, "part").select(F.col("p_partkey").alias("player_id"))
    bundle = filter_market(players, valuations, region, transfers, ["1", "3"])
    parts = [getattr(bundle, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("part_of_bundle"), "n")
             for name in ("clubs", "valuations", "players", "transfers")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("join_suite", """
WITH first_line AS (
  SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_extendedprice) = 1)
SELECT o_orderkey, c_name, n_name, l_partkey AS first_partkey, l_extendedprice AS first_price
FROM orders LEFT JOIN customer ON c_custkey = nullif(o_custkey, 7) JOIN nation ON n_nationkey = coalesce(c_nationkey, 0)
LEFT JOIN first_line ON l_orderkey = o_orderkey""")
def join_suite(spark, sf):
    """Attach the customer (left, null keys unmatched), its nation (inner) and the first line."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(7).cast("long")).alias("c_custkey"))
    with_customer = relational.attach(orders, table(spark, sf, "customer"), ["c_custkey"], ["c_name", "c_nationkey"])
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    inner = with_customer.join(nation, F.coalesce("c_nationkey", F.lit(0)) == F.col("n_nationkey"))
    first = relational.first_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], LINE_ORDER[1:],
                                     ["l_partkey", "l_extendedprice"])
    first = first.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("first_partkey"),
                         F.col("l_extendedprice").alias("first_price"))
    return relational.attach(inner.select("o_orderkey", "c_name", "n_name"), first, ["o_orderkey"])


@query("name_lookup_join", """
SELECT p_partkey, p_name || ' ' || coalesce(nullif(p_brand, 'Brand#3'), '') AS name FROM part""")
def name_lookup_join(spark, sf):
    """Names attached by key without multiplying rows."""
    part = table(spark, sf, "part")
    names = relational.first_per_key(part.select(
        "p_partkey", "p_name", F.nullif("p_brand", F.lit("Brand#3")).alias("brand"), "p_size"),
        ["p_partkey"], ["p_size"], ["p_name", "brand"])
    return relational.attach(part.select("p_partkey"), names, ["p_partkey"]).select(
        "p_partkey", full_name(F.col("p_name"), F.col("brand")).alias("name"))
