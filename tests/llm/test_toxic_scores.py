"""Viterbi against all readings of the lattice, hashes and scores against plain computations."""

import random

import numpy as np

from valora.llm import toxicity


def all_readings(channel, seen):
    """{reading: least cost} over every path of the lattice."""
    paths = {("", (0, 0)): 0.0}
    before, twice = "", False
    for c in seen:
        arcs = channel.arcs(c, before, twice)
        twice, before = c == before, c
        after = {}
        for (text, (a, b)), cost in paths.items():
            for x, price in arcs:
                if x == "":
                    key, total = (text, (a, b)), cost + price
                else:
                    k = 0 if x == " " else channel.number.get(x, toxicity.N - 1)
                    if k == 0 and b == 0:
                        continue
                    key, total = (text + x, (b, k)), cost + price - channel.model[(a * toxicity.N + b) * toxicity.N + k]
                after[key] = min(total, after.get(key, np.inf))
        paths = after or paths
    return {text: cost - channel.model[(a * toxicity.N + b) * toxicity.N] for (text, (a, b)), cost in paths.items()}


def test_viterbi_takes_the_cheapest_reading():
    r = np.random.default_rng(3)
    channel = toxicity.Channel(np.log(r.dirichlet(np.ones(toxicity.N), toxicity.N**2)).astype(np.float32).reshape(-1))
    some = random.Random(4)
    for _ in range(300):
        seen = "".join(some.choice("abss33@-1.x") for _ in range(some.randint(1, 6)))
        costs = all_readings(channel, seen)
        assert costs[channel.read(seen)] <= min(costs.values()) + 1e-6


def test_pairs_of_letters_are_read_alike():
    r = np.random.default_rng(5)
    channel = toxicity.Channel(np.log(r.dirichlet(np.ones(toxicity.N), toxicity.N**2)).astype(np.float32).reshape(-1))
    some, dropped = random.Random(8), 0
    for _ in range(4000):
        word = "".join(some.choice("aabbcéż") for _ in range(some.randint(1, 9)))
        if not channel.THRICE.search(word):
            assert channel.undoubled(word) == channel.read(word), word
            dropped += channel.undoubled(word) != word
    assert dropped > 300


def test_features_tell_words_and_beginnings_apart():
    words = ["abc", "ab", "abcd", "abcde", "abcdef", "abcdefg", "abcdefgh", "bacdefg", "é" * 7, "😀bcdefgh", "acb", "a" * 300]
    rows = toxicity.features_of(words)
    assert (rows != 0).tolist() == [[len(w) > 2, len(w) > 6, len(w) > 5, len(w) > 4] for w in words]
    stands_for = {}
    for word, row in zip(words, rows.tolist()):
        for feature, stretch in zip(row, [("whole", word), *(("beginning", word[:n]) for n in toxicity.BEGINNINGS)]):
            if feature:
                assert stands_for.setdefault(feature, stretch) == stretch
    assert len(set(stands_for.values())) == len(stands_for)
    assert (toxicity.features_of(words[3:5]) == rows[3:5]).all() and toxicity.features_of([]).shape == (0, 4)


def test_strongest_equals_a_plain_loop():
    r = random.Random(6)
    kept = np.array(sorted(r.sample(range(1, 60), 25)))
    weights = np.array([r.choice([0.0, 0.5, 1.25, 2.0]) for _ in kept])
    of = dict(zip(kept.tolist(), weights.tolist()))
    features = np.array([[r.choice([0, r.randint(1, 60)]) for _ in range(4)] for _ in range(400)])
    texts = np.sort(np.array([r.randrange(30) for _ in range(400)]))
    want = [0.0] * 31
    for t in range(31):
        found = {next((of[f] for f in row if f in of), 0.0) for row in features[texts == t].tolist()}
        want[t] = sum(sorted(found)[-toxicity.STRONGEST:])
    assert np.allclose(toxicity.strongest(features, texts, kept, weights, 31), want)
    assert toxicity.strongest(features, texts, kept[:0], weights[:0], 31).tolist() == [0.0] * 31


def test_long_and_empty_texts(spark):
    long = "gentle words " * 60_000 + "stupid"
    docs = spark.createDataFrame([(i, f"calm text number x{i}") for i in range(200)] + [(200 + i, f"stupid text number y{i}") for i in range(40)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id >= 200 as int) AS toxic")
    model = toxicity.fit(docs, labels)
    rows = spark.createDataFrame([(1, long), (2, "gentle words " * 60_000), (3, None), (4, ""), (5, "- . -"), (5, "- . -")], "doc_id long, text string")
    got = sorted((r.doc_id, r.score >= 0.3) for r in toxicity.score(rows, model).collect())
    assert got == [(1, True), (2, False), (3, False), (4, False), (5, False), (5, False)]
