import random

import pytest
from pyspark.sql import functions as F

from valora.functions import dates, labels, numeric, similarity, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c"))).first()[0]


@pytest.mark.parametrize("raw, expected", [
    ("John Doe", "john doe"), ("Héctor", "hector"), ("Müller", "muller"), ("Čech", "cech"), ("Özil", "ozil"),
    ("O'Neil", "oneil"), ("Tchouaméni", "tchouameni"), ("  John   Doe  ", "john doe"), ("Player1 2000", "player"),
    ("", ""), ("Ronaldo", "ronaldo"), ("Sørloth", "sorloth"), ("Łukasz", "lukasz"), ("Groß", "gross"),
    ("Þór Æsir", "thor aesir"), ("Jean-Luc", "jeanluc"), ("a b", "a b"), ("Nguyễn", "nguyen"), ("Жуков", "zhukov"),
])
def test_normalize(spark, raw, expected):
    assert one(spark, raw, text.normalize_name) == expected


def test_normalize_other_scripts_and_null(spark):
    assert one(spark, "Αλέξης", text.normalize_name) == "alexes"
    assert one(spark, None, text.normalize_name) is None


def test_name_parts(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(text.full_name(F.col("x"), F.col("y"))).collect()] == ["a ", " b", "a b"]


def test_matches_is_a_pattern_unless_literal(spark):
    df = spark.createDataFrame([("Mo Salah",), ("a.b",), (None,)], "n string")
    hits = df.select(text.matches(F.col("n"), "sal.h"), text.matches(F.col("n"), ".", literal=True)).collect()
    assert [tuple(h) for h in hits] == [(True, False), (False, True), (False, False)]


def brute_score(a, b):
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for cx in x:
            prev = row[:]
            for j, cy in enumerate(y):
                row[j + 1] = prev[j] + 1 if cx == cy else max(prev[j + 1], row[j])
        return row[-1]

    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = x & y
    if both and (not x - y or not y - x):
        return 100.0
    shared = " ".join(sorted(both))
    p = " ".join(filter(None, [shared, " ".join(sorted(x - y))]))
    q = " ".join(filter(None, [shared, " ".join(sorted(y - x))]))
    ratio = lambda s, t: 200 * lcs(s, t) / (len(s) + len(t))
    return max([ratio(p, q)] + ([ratio(shared, p), ratio(shared, q)] if both else []))


@pytest.mark.parametrize("a, b, score", [
    ("john smith", "smith john", 100), ("john smith", "john", 100), ("", "john", 0), ("", "", 0),
    ("jon smyth", "john smith", 100 * (1 - 3 / 19)), ("abc", "xyz", 0), ("abcd", "abce", 75),
])
def test_token_set_score(a, b, score):
    assert similarity.token_set_score(a, b) == pytest.approx(score)


def random_pair(r):
    alphabet = r.choice(["ab", "abcde", "etaoinshrdlu"])
    word = lambda: "".join(r.choice(alphabet) for _ in range(r.randint(1, 7)))
    a = [word() for _ in range(r.randint(1, 4))]
    b = list(" ".join(a))
    for _ in range(r.randint(0, 4)):
        p = r.randrange(len(b) + 1)
        b[p:p + r.randint(0, 1)] = r.choice([[], [r.choice(alphabet)]])
    words = "".join(b).split()
    r.shuffle(words)
    if r.random() < 0.3:
        words.append(word())
    return " ".join(a), " ".join(words)


@pytest.mark.parametrize("frequent", [{}, "all"])
def test_score_and_signatures_against_brute_force(frequent):
    r = random.Random(5)
    hits = 0
    for _ in range(6000):
        a, b = random_pair(r)
        score = similarity.token_set_score(a, b)
        assert score == pytest.approx(brute_score(a, b))
        ranks = {g: r.random() for g in similarity.bigrams(a) + similarity.bigrams(b) if r.random() < 0.7} if frequent else {}
        for threshold in (70.0, 80.0, 90.0):
            if score >= threshold:
                hits += 1
                (grams_a, own_a, whole_a), (grams_b, own_b, whole_b) = (similarity.signature(x, threshold, ranks) for x in (a, b))
                shared = sorted(set(similarity.bigrams(a)) & set(similarity.bigrams(b)), key=lambda g: (ranks.get(g, 0), g))[:2]
                in_both = [g for g in grams_a if g in grams_b][:2]
                assert in_both == shared and len(shared) == 2 or set(own_a) & set(whole_b) or set(whole_a) & set(own_b), (a, b, score)
    assert hits > 3000


def test_signatures_refuse_low_thresholds():
    with pytest.raises(ValueError):
        similarity.signature("a b", 60, {})
    assert similarity.signature(" ", 80, {}) == ([], [], [])


@pytest.mark.parametrize("label, year, pivoted", [
    ("24/25", 2024, 2024), ("9/10", 2009, 2009), ("99/00", 2099, 1999), ("2024/25", 2024, 2024), (" 24 /25", 2024, 2024),
    ("abc", None, None), ("", None, None), (None, None, None), ("-5/1", 1995, 1995),
])
def test_season_start_year(spark, label, year, pivoted):
    assert one(spark, label, dates.season_start_year) == year
    assert one(spark, label, lambda c: dates.season_start_year(c, pivot=50)) == pivoted


@pytest.mark.parametrize("year, label", [(2024, "2024/25"), (1999, "1999/00"), (2008, "2008/09")])
def test_season_label(spark, year, label):
    assert one(spark, year, dates.season_label, "int") == label


@pytest.mark.parametrize("raw, day", [("2024-02-29", "2024-02-29"), ("1978-06-09 00:00:00", "1978-06-09"),
                                      ("2023-02-30", None), ("soon", None), (None, None)])
def test_parse_date(spark, raw, day):
    got = one(spark, raw, dates.parse_date)
    assert (got and got.isoformat()) == day


@pytest.mark.parametrize("predicted, actual, code, wording", [
    (150.0, 100.0, "UNDERVALUED", "UNDERVALUED  (model sees +50% upside)"),
    (50.0, 100.0, "OVERVALUED", "OVERVALUED   (model sees -50% downside)"),
    (120.0, 100.0, "FAIR VALUE", "FAIR VALUE   (within +20% of TM)"),
    (80.0, 100.0, "FAIR VALUE", "FAIR VALUE   (within -20% of TM)"),
    (112.5, 100.0, "FAIR VALUE", "FAIR VALUE   (within +12% of TM)"),
    (100.0, 100.0, "FAIR VALUE", "FAIR VALUE   (within +0% of TM)"),
    (10.0, 0.0, "unknown", "unknown"),
])
def test_verdict(spark, predicted, actual, code, wording):
    df = spark.createDataFrame([(predicted, actual)], "p double, a double")
    got = df.select(labels.verdict_code(F.col("p"), F.col("a")), labels.verdict_text(F.col("p"), F.col("a"))).first()
    assert tuple(got) == (code, wording)


def test_null_rules_of_numbers(spark):
    df = spark.createDataFrame([(None, 0.0), (-2.0, 4.0), (3.0, None)], "a double, b double")
    got = df.select(numeric.clip_lower(F.col("a")), numeric.ratio(F.col("a"), F.col("b")),
                    numeric.indicator(F.col("a") < 0), numeric.per90(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(None, None, 0.0, None), (0.0, -0.5, 1.0, -45.0), (3.0, None, 0.0, None)]


def test_parse_number_and_money(spark):
    assert one(spark, "NaN", numeric.parse_number) is None
    assert one(spark, "?", lambda c: numeric.parse_number(c, 0)) == 0.0
    assert one(spark, 2_450_000.0, labels.money_text, "double") == "€2.4M"


def test_one_hot_and_back(spark):
    df = spark.createDataFrame([("DEF",), ("MID",), (None,)], "p string")
    dummies = df.select("p", *[c.alias(n) for n, c in numeric.one_hot(F.col("p"), ["DEF", "FWD", "MID"], "pos_").items()])
    back = dummies.select(numeric.one_hot_label(["pos_DEF", "pos_FWD", "pos_MID"], "pos_")).collect()
    assert [r[0] for r in back] == ["DEF", "MID", "DEF"]  # all zeros: the first maximum
