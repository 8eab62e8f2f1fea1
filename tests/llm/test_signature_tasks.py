import re

from valora.llm import jaccard


def test_signatures_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    """By the number of signatures, not by Spark's number of partitions; the same components come out."""
    rows = [(i, " ".join(f"w{(i // 2 * 31 + j) % 977}" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    signs = "id long, n bigint, node bigint, band int, own array<bigint>, below array<bigint>"
    signed = docs.mapInArrow(jaccard.signer(3, 90, jaccard.SPARE), signs)
    held = sum(len(r.own) + len(r.below) for r in signed.collect())
    assert jaccard.signature_tasks(signed) == 1
    monkeypatch.setattr(jaccard, "TASK_SIGNATURES", held // 11)
    n = jaccard.signature_tasks(signed)
    assert 11 <= n <= 12
    plan = jaccard.shared_signatures(signed, jaccard.Bands(90, jaccard.SPARE), 58)._jdf.queryExecution().toString()
    assert re.search(rf"hashpartitioning\(signature#\d+L, {n}\), REPARTITION_BY_NUM", plan)
    assert {r.doc_id: r.component for r in jaccard.similarity_components(docs).collect()} == {i: i - i % 2 for i in range(40)}
    monkeypatch.setattr(jaccard, "TASK_SIGNATURES", 1)
    assert jaccard.signature_tasks(signed) == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
