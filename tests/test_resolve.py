import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from valora.functions.similarity import token_set_score
from valora.functions.text import full_name, normalize_name
from valora.operators import resolve
from valora.plans.dataset import build_crosswalk

PEOPLE = "api_player_id BIGINT, season INT, first STRING, last STRING, dob DATE, rec_ord INT"
MARKET = "player_id BIGINT, name STRING, last_name STRING, date_of_birth DATE"
D = dt.date(1990, 5, 15)


def crosswalk(spark, people, market, **options):
    rows = spark.createDataFrame(
        [(i, s, f, l, d, n) for n, (i, s, f, l, d) in enumerate(people)], PEOPLE).select(
        "api_player_id", "season", "dob", "rec_ord",
        normalize_name(full_name(F.col("first"), F.col("last"))).alias("full_name_norm"),
        normalize_name(F.col("last")).alias("last_name_norm"))
    out = build_crosswalk(rows, spark.createDataFrame(market, MARKET), **options)
    assert out.columns == ["api_player_id", "tm_player_id", "match_method"]
    return {r.api_player_id: (r.tm_player_id, r.match_method) for r in out.collect()}


@pytest.mark.parametrize("left, right, expected", [
    ((1, "John", "Doe", D), (101, "John Doe", "Doe", D), (101, "exact_full")),
    ((2, "J.", "Smith", D), (202, "John Smith", "Smith", D), (202, "exact_last")),
    ((3, "Mats", "Hummels", D), (303, "Mats Hümmels", "Hümmels", D), (303, "exact_full")),
    ((4, "Thomas", "Müller", D), (404, "Thomas Müller", "Müller", dt.date(1970, 1, 1)), (None, "unmatched")),
    ((5, "Ghost", "Player", dt.date(2000, 1, 1)), (505, "Other Guy", "Guy", dt.date(1985, 6, 6)), (None, "unmatched")),
    ((6, "Jon", "Smyth", D), (606, "John Smith", "Smith", D), (606, "fuzzy")),
    ((7, "Abcd", "Efgh", D), (707, "Abxy Efzw", "Efzw", D), (None, "unmatched")),
    ((8, "Lone", "Wolf", None), (808, "Lone Wolf", "Wolf", None), (None, "unmatched")),
    ((9, "Vinicius Jose", "Junior", D), (909, "Vinicius Junior", "Vinicius", D), (909, "fuzzy")),
])
def test_cascade(spark, left, right, expected):
    i, first, last, dob = left
    assert crosswalk(spark, [(i, 2022, first, last, dob)], [right]) == {i: expected}


def test_one_row_per_player_over_seasons(spark):
    got = crosswalk(spark, [(6, 2022, "Ali", "Baba", D), (6, 2023, "Ali", "Baba", D)], [(606, "Ali Baba", "Baba", D)])
    assert got == {6: (606, "exact_full")}


def test_empty_market(spark):
    assert crosswalk(spark, [(7, 2022, "Test", "Player", D)], []) == {7: (None, "unmatched")}


def test_duplicates_last_wins_for_full_first_wins_for_last_name(spark):
    market = [(1, "John Doe", "Doe", D), (2, "John Doe", "Doe", D), (3, "Jack Doe", "Doe", D)]
    got = crosswalk(spark, [(1, 2022, "John", "Doe", D), (2, 2022, "X.", "Doe", D)], market)
    assert got == {1: (2, "exact_full"), 2: (1, "exact_last")}


def test_similarity_tie_takes_first_candidate_and_last_id_of_its_name(spark):
    market = [(10, "abcdefgx", "m", D), (11, "abcdefgy", "n", D), (12, "abcdefgx", "o", D)]
    got = crosswalk(spark, [(1, 2022, "", "abcdefgz", D)], market)
    assert got == {1: (12, "fuzzy")}


def test_threshold_is_inclusive(spark):
    # 10 characters in total, two of them differ: exactly 80.
    market = [(1, "abcde", "x", D)]
    assert token_set_score("abcdf", "abcde") == 80.0
    assert crosswalk(spark, [(1, 2022, "", "abcdf", D)], market) == {1: (1, "fuzzy")}
    assert crosswalk(spark, [(1, 2022, "", "abcdf", D)], market, threshold=80.5) == {1: (None, "unmatched")}


@pytest.mark.parametrize("ranked", [0, 5, 10_000])
def test_large_blocks_find_the_same_best_names(spark, monkeypatch, ranked):
    """One block holds most names; keys in any order must agree with brute force."""
    monkeypatch.setattr(resolve, "RANKED_GRAMS", ranked)
    r = random.Random(11)
    syllables = ["an", "to", "ri", "mel", "sa", "kov", "ber", "lin", "de", "ma", "sch", "o", "ez", "vic"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 3)))
    names = sorted({" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(120)})
    right = [(i, n, "hot" if i % 4 else f"b{i % 3}", i) for i, n in enumerate(names)]

    def misspell(n):
        p = r.randrange(len(n))
        return " ".join((n[:p] + r.choice("aeiou ") + n[p + 1:]).split())

    left = [(misspell(n), b) for _, n, b, _ in right for _ in range(2)]
    rdf = spark.createDataFrame(right, "id BIGINT, rname STRING, block STRING, ord INT")
    ldf = spark.createDataFrame(left, "lname STRING, block STRING")
    got = {(x.block, x.lname): (x.id, round(x.score, 9)) for x in resolve.best_similar(ldf, rdf, 80.0).collect()}
    expected = {}
    for name, block in left:
        best = max(((token_set_score(name, n), -i) for i, n, b, _ in right if b == block), default=(0, 0))
        if best[0] >= 80:
            expected[(block, name)] = (-best[1], round(best[0], 9))
    assert got == expected and len(expected) > 50


def test_match_rate(spark):
    df = spark.createDataFrame([(1, "exact_full"), (2, "fuzzy"), (None, "unmatched")], "matched_id INT, match_method STRING")
    row = resolve.match_rate(df).first()
    assert (row.total, row.matched, row.exact_full, row.exact_last, row.fuzzy, row.unmatched) == (3, 2, 1, 0, 1, 1)
    assert row.match_pct == pytest.approx(200 / 3)
    assert resolve.match_rate(df.limit(0)).first().match_pct == 0.0


def test_one_large_block_of_random_names_equals_brute_force(spark):
    """Pairs of every kind (edits, moved, dropped and added words) in one oversized block."""
    from test_text import random_pair
    r = random.Random(23)
    pairs = [random_pair(r) for _ in range(350)]
    lefts = sorted({" ".join(a.split()) for a, _ in pairs})
    rights = sorted({" ".join(b.split()) for _, b in pairs if b.split()})
    rdf = spark.createDataFrame([(i, n, "one", i) for i, n in enumerate(rights)], "id BIGINT, rname STRING, block STRING, ord INT")
    ldf = spark.createDataFrame([(n, "one") for n in lefts], "lname STRING, block STRING")
    for threshold in (70.0, 80.0, 92.0):
        got = {x.lname: (x.id, round(x.score, 9)) for x in resolve.best_similar(ldf, rdf, threshold).collect()}
        expected = {}
        for name in lefts:
            score, i = max((token_set_score(name, n), -i) for i, n in enumerate(rights))
            if score >= threshold:
                expected[name] = (-i, round(score, 9))
        assert got == expected and len(expected) > 100
        pairs = resolve.candidate_pairs(ldf, rdf.select("block", "rname"), threshold).collect()
        assert len(pairs) == len(set(pairs)) < len(lefts) * len(rights) / 2


def test_no_distinct_over_pairs(spark):
    """Pairs are emitted once by the join itself: no exchange follows it."""
    ldf = spark.createDataFrame([("ab cd", "b")], "lname STRING, block STRING")
    rdf = spark.createDataFrame([("ab ce", "b")], "rname STRING, block STRING")
    plan = resolve.candidate_pairs(ldf, rdf, 80.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Distinct" not in plan


def test_names_without_letters_or_blocks(spark):
    ldf = spark.createDataFrame([("", "b"), (None, "b"), ("ab cd", None), ("ab cd", "b"), ("ab cd", "b")], "lname STRING, block STRING")
    rdf = spark.createDataFrame([(1, "", "b", 1), (2, "ab cd", None, 2), (3, "ab cd", "b", 3), (4, "cd ab", "b", 4)], "id BIGINT, rname STRING, block STRING, ord INT")
    assert [tuple(r) for r in resolve.best_similar(ldf, rdf, 80.0).collect()] == [("b", "ab cd", 3, 100.0)]
    assert resolve.best_similar(ldf.limit(0), rdf, 80.0).count() == 0 and resolve.best_similar(ldf, rdf.limit(0), 80.0).count() == 0


def test_keys_are_joined_without_a_broadcast_and_in_several_tasks(spark):
    """A name is a few bytes and dozens of wide keys, which no estimate of sizes sees (the two sides here are far below every limit)."""
    left = spark.createDataFrame([("b", "blue ring"), ("b", "old plates")], "block string, lname string")
    right = spark.createDataFrame([("b", "blue rings"), ("b", "old plate")], "block string, rname string")
    pairs = resolve.candidate_pairs(left, right, 80.0)
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and plan.count("RepartitionByExpression") + plan.count("REPARTITION_BY_NUM") == 2
    assert {tuple(row) for row in pairs.collect()} == {("b", "blue ring", "blue rings"), ("b", "old plates", "old plate")}


def test_blocks_of_the_same_words_are_tested_pair_by_pair(spark, monkeypatch):
    """Names of one block that share most keys: each pair is tested once, and both ways find the same pairs that reach the threshold."""
    monkeypatch.setattr(resolve, "CELL", 7)
    words = ["brown", "green", "steel", "linen"]
    right = [("b", f"{a} {b} {c}") for a in words for b in words for c in ("zuk", "vira", "reto")] + [("few", "plum stone"), ("none", "brown steel zuk")]
    left = [("b", f"{c} {b} {a}e") for a in words for b in words for c in ("zuk", "vira", "reto")] + [("few", "plum stones"), ("other", "brown steel zuk")]
    ldf, rdf = spark.createDataFrame(left, "block STRING, lname STRING"), spark.createDataFrame(right, "block STRING, rname STRING")
    expected = {(b, x, y) for b, x in left for c, y in right if b == c and token_set_score(x, y) >= 80}
    for small, meeting, by_keys in ((100, 1.0, False), (0, 1.0, False), (0, 0.0, True)):
        monkeypatch.setattr(resolve, "SMALL_BLOCK", small)
        monkeypatch.setattr(resolve, "MEETING", meeting)
        found = resolve.candidate_pairs(ldf, rdf, 80.0)
        pairs = [tuple(r) for r in found.collect()]
        assert len(pairs) == len(set(pairs)) and {p for p in pairs if token_set_score(*p[1:]) >= 80} == expected
        signed = [names.select("block", name, resolve.signature_udf(80.0, {})(name).alias("s")) for names, name in ((ldf, "lname"), (rdf, "rname"))]
        ways = {r.block: r.paired for names in resolve._with_ways(signed, 80.0) for r in names.collect()}
        assert ways == {"b": not by_keys, "few": not by_keys}


def test_keys_of_large_blocks_equal_brute_force(spark, monkeypatch):
    """The way by keys, which small blocks do not take any more."""
    monkeypatch.setattr(resolve, "SMALL_BLOCK", 0)
    monkeypatch.setattr(resolve, "MEETING", 0.0)
    test_large_blocks_find_the_same_best_names(spark, monkeypatch, 5)
    test_one_large_block_of_random_names_equals_brute_force(spark)
