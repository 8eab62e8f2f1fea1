"""The pipeline on small tables with planted cases, and the queries' digests on the smallest given tables."""

import hashlib
import os
import random

import pytest

import brute
import corpus_pipeline
from valora.llm import QUERIES
from valora.llm.registry import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice(("ba", "de", "li", "mo", "nu", "ra", "so", "ti")) for _ in range(rnd.randint(2, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = {i: "\n".join(prose(25) for _ in range(4)) for i in range(200)}
    labels = {i: 0 for i in range(200)}
    for i in range(0, 200, 5):  # toxic
        texts[i] += " stupid moron"
        labels[i] = 1
    passage = prose(60)
    texts[301], texts[302] = prose(30) + "\n" + passage + "\n" + prose(30), prose(30) + "\n" + passage + "\n" + prose(30)  # a repeated line
    near = prose(120).split()
    texts[303], texts[304] = " ".join(near), " ".join([*near[:50], "changed", *near[51:]])  # near copies on one line
    item = prose(20)
    texts[305] = prose(10) + " " + item.upper() + " " + prose(10)  # contaminated
    texts[306], texts[307] = "", None
    texts[308] = prose(40) + " st.u.p.i.d " + prose(3)
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, x) for i, x in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, labels, passage


def test_stages(spark, corpus):
    folder, texts, labels, passage = corpus
    docs, held = table(spark, folder, "documents"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), name)
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        held[name] = {r.doc_id: r for r in docs.collect()}
    clean = {i for i in texts if i < 200 and not labels[i]}
    assert set(held["toxicity"]) == clean | {301, 302, 303, 304, 305, 306, 307}
    lines = held["line_dedup"]
    assert set(lines) == set(held["toxicity"]) and passage in lines[301].text and passage not in lines[302].text
    assert all(lines[i].text == texts[i] for i in clean)
    assert set(held["near_duplicates"]) == set(lines) - {304}
    assert set(held["decontamination"]) == set(lines) - {304, 305}
    for r in held["byte_level_bpe"].values():
        text = held["decontamination"][r.doc_id].text or ""
        assert r.decoded_sha256 == brute.sha(text) and r.n_tokens == len(r.ids)


def test_run_is_the_stages(spark, corpus):
    folder, *_ = corpus
    assert corpus_pipeline.run(spark, folder).count() == len([i for i in corpus[1] if i < 200 and not corpus[2][i]]) + 5


def test_one_row_of_each_group_of_copies(spark, tmp_path):
    """Exact and near copies of several lines; rows without words stay as they are."""
    rnd = random.Random(21)
    prose = lambda: " ".join("".join(rnd.choice(("ba", "de", "li", "mo", "nu", "ra")) for _ in range(3)) for _ in range(25))
    exact, near = [prose() for _ in range(4)], [prose() for _ in range(12)]
    changed = [*near[:5], near[5] + " changed", *near[6:]]
    texts = {1: "\n".join(exact), 2: "\n".join(exact), 3: "\n".join(exact), 4: "\n".join(near), 5: "\n".join(changed), 6: "\n".join(changed), 7: prose(), 8: "", 9: None, 10: " \n "}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.materialize(corpus_pipeline.drop_repeated_lines(spark, docs, str(tmp_path)), "lines")
    assert left.columns == docs.columns
    kept = {r.doc_id for r in left.collect()}
    assert kept & {1, 2, 3} == {1} and kept & {6} == set() and kept >= {4, 7, 8, 9, 10}
    once = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, left, str(tmp_path)).collect()}
    assert once & {1, 2, 3} == {1} and once >= {4} and 6 not in once
    # The line that a near copy does not share is no copy: it stays, and nothing but it.
    assert [r.text for r in left.collect() if r.doc_id == 5] == [near[5] + " changed"]


def test_pipeline_of_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, corpus[0], name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
def test_query_digests(spark):
    rows = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op1_byte_level_bpe"](spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()
    for r in QUERIES["op3_secret_scans"](spark, SF).collect():
        base = brute.base_secrets(rows[r.doc_id])
        assert r.base_sha256 == brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in base)) and r.n_assign == sum(k == "assign" for k, _, _ in base)
    for r in QUERIES["op5_license_scans"](spark, SF).collect():
        found = brute.phrases(rows[r.doc_id], (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")))
        places = [k for _, k in found]
        assert (r.n_base, r.first_word, r.last_word) == (len(found), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted({x for x, _ in found})) and 0 <= r.score <= 1
    scored = QUERIES["op9_toxicity"](spark, SF).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
