"""Ranked lexical search, Merkle manifest and sharding against plain versions, with nulls, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from valora.llm import lexical, manifest, sharding

LONG = " ".join(f"w{i * i % 997}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def rows():
    rnd = random.Random(3)
    words = ["Ab", "c-d", "Ünï", "e", "f", "g9", "漢字", "h", "i", "j"]
    made = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 40)))) for i in range(20, 260)]
    copies = [(i, "e f e h, 漢字!") for i in range(300, 420)]
    return [(1, None), (2, ""), (3, " -,\n"), (4, LONG), (5, "e"), (5, "e"), (5, "e f"), (None, "E"), (None, "ünï e"), *made, *copies]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns whose names the operators also use."""
    odd = [(i, t, (None, "", "en", "é", "de")[k % 5 if k > 60 else 2], "s", k % 11 or None, "x", "y", "z", "w") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, id string, tree string, shard string, rank string").repartition(5)


def scored(rows, items, top):
    """{item number: [(doc, score)]} by the definition."""
    texts = [(i, brute.words(t)) for i, t in rows]
    count, total = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    holding = Counter(x for _, w in texts for x in set(w))
    out = []
    for name, text in items:
        found = []
        for doc, w in texts:
            tf, m = Counter(w), 100 - 50 + 50 * len(w) * count // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * holding[x] + 1))) * (10**9 * tf[x] // (1000 * tf[x] + 20 * m))
                        for x in set(brute.words(text)) if x in tf)
            if score:
                found.append((-score, doc is None, doc or 0))
        out += [(name, k + 1, None if missing else doc, -s) for k, (s, missing, doc) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


ITEMS = [(1, "e, f; UNKNOWN"), (2, "漢字 Ünï"), (3, None), (4, ""), (5, "ab c d"), (5, "g9 j"), (6, "e"), (6, "e"), (None, "h i w0x0")]


@pytest.mark.parametrize("top, portion, leaf, cells", [(50, 400_000, 48, 500_000), (7, 60, 3, 10), (1000, 500, 1, 40)])
def test_ranked(spark, docs, rows, monkeypatch, top, portion, leaf, cells):
    for name, value in (("PORTION", portion), ("LEAF", leaf), ("CELLS", cells), ("BLOCK_CHARS", 20 if top == 7 else 10_000)):
        monkeypatch.setattr(lexical, name, value)
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in ITEMS], "item_id long, text string, doc_id string, score string")
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(docs, items, top=top).collect()), key=repr)
    assert got == scored(rows, [*ITEMS[:6], *ITEMS[7:]], top)


def test_ranked_empty(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.ranked(docs.filter("doc_id = -1"), items).count() == 0
    assert lexical.ranked(docs.filter("doc_id = 2"), items).count() == 0
    assert lexical.ranked(docs, items.filter("item_id = -1")).count() == 0
    with pytest.raises(ValueError):
        lexical.ranked(docs, items.withColumnRenamed("item_id", "doc_id"), item_col="doc_id")


def test_impact_is_monotone():
    tf, m = np.arange(1, 200)[:, None], np.arange(50, 400)[None]
    worth = lexical.impact(tf, m)
    assert (np.diff(worth, axis=0) >= 0).all() and (np.diff(worth, axis=1) <= 0).all()


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """(root, [[(before, after) per level]]) of hex leaves."""
    paths, nodes, members = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(nodes) > 1:
        for i in range(len(nodes)):
            for leaf in members[i]:
                paths[leaf].append((nodes[i - 1], "") if i % 2 else ("", nodes[i + 1] if i + 1 < len(nodes) else ""))
        nodes = [digest(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        members = [sum(members[i:i + 2], []) for i in range(0, len(members), 2)]
    return nodes[0], paths


@given(st.integers(1, 300))
@settings(max_examples=60, deadline=None)
def test_open_subtrees(n):
    leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
    subtrees = manifest.OpenSubtrees()
    witnesses = [subtrees.append(leaf) for leaf in leaves]
    assert len({height for height, _, _ in subtrees.open}) == len(subtrees.open) == bin(n).count("1")
    root = subtrees.finish((n - 1).bit_length())
    side = lambda x: x.hex() if x else ""
    assert (root.hex(), [[(side(s["before"]), side(s["after"])) for s in w] for w in witnesses]) == tree([x.hex() for x in leaves])


@pytest.mark.parametrize("levels", [10, 2])
def test_manifest(docs, monkeypatch, levels):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", levels)
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    found = manifest.manifest(docs, fields=fields).withColumn("folded", manifest.folded(F.col("leaf"), "witness")) \
        .withColumn("off", manifest.verified(F.sha2("leaf", 256), "witness", "root")).withColumn("siblings", manifest.siblings("witness")).collect()
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for r in docs.collect():
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, digest(*(cell(r[f]) for f in fields))))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([leaf for *_, leaf in sorted(groups[g])]) for g in names}
    root, outer = tree([trees[g][0] for g in names])
    want = [(doc if named else None, g, leaf, trees[g][0], root, [x for step in path + outer[names.index(g)] for x in step if x])
            for g in names for (named, doc, leaf), path in zip(sorted(groups[g]), trees[g][1])]
    got = [(r.doc_id, r.lang, r.leaf, r.subroot, r.root, list(r.siblings)) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r.folded == r.root and not r.off for r in found)


def test_manifest_of_little(docs):
    assert manifest.manifest(docs.filter("doc_id = -1"), fields=["doc_id"]).collect() == []
    one = manifest.manifest(docs.filter("doc_id = 2"), fields=["doc_id", "text"]).first()
    assert one.leaf == one.subroot == one.root == digest("1:2", "0:") and one.witness == []


def jump(key, shards):
    """One key at a time."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jumps():
    rnd = random.Random(2)
    keys = [0, 1, 2**63, 2**64 - 1, *(rnd.getrandbits(64) for _ in range(20_000))]
    as_long = np.array(keys, np.uint64).view(np.int64)
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jumps(as_long, shards).tolist() == [jump(k, shards) for k in keys]
    before, after = sharding.jumps(as_long, 24), sharding.jumps(as_long, 25)
    assert set(after[before != after].tolist()) == {24} and abs((before != after).mean() - 1 / 25) < 0.005
    assert abs(np.bincount(before) / len(keys) - 1 / 24).max() < 0.006


def test_sharding(docs, rows):
    got = sharding.text_sizes(docs, 24).collect()
    key = lambda i: int(digest("-" if i is None else f"{len(str(i))}:{i}")[:16], 16)
    data = lambda t: (t or "").encode()
    want = [(i, len(data(t)) + 8, zlib.crc32(data(t)), jump(key(i), 24), jump(key(i), 25)) for i, t in rows]
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got), key=repr) == sorted(want, key=repr)
    for shard in range(24):
        inside = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r.shard == shard)
        assert [x[0] for x in inside] == list(range(len(inside))) and [x[1:] for x in inside] == sorted(x[1:] for x in inside)
    assert sharding.text_sizes(docs.filter("doc_id = -1"), 24).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), 0)


def test_keys_of_several_columns(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("", "abc"), ("-", "abc")], "p string, q string")
    assert df.select(sharding.key_hash("p", "q").alias("k")).distinct().count() == 5


def test_written_and_grown_shards(spark, docs, tmp_path):
    plain = docs.select("doc_id", "text")
    sharding.write_shards(plain, str(tmp_path / "shards"), ["doc_id"], 5, files=2)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(back.select("doc_id", "text").collect(), key=repr) == sorted(plain.collect(), key=repr)
    assert back.exceptAll(sharding.assigned(plain, ["doc_id"], 5)).count() == 0
    goes = sharding.moved(plain, ["doc_id"], 5, 7)
    assert 0 < goes.count() < plain.count() / 2 and {r.to_shard for r in goes.select("to_shard").distinct().collect()} <= {5, 6}
