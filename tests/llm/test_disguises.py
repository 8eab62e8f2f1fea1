"""Spaced words with marks at their edges, and words with one letter too many."""

from test_operators import insults  # noqa: F401
from valora.llm import toxicity


def test_marks_and_doubled_letters(spark, insults):  # noqa: F811
    model, docs, _ = insults
    clean = docs.filter("doc_id = 1").first().text
    disguised = ["i d i o t.", '"i d i o t"', "stuupid", "morron"]
    rows = spark.createDataFrame([(i, f"{clean} {w}") for i, w in enumerate(disguised)] + [(9, f"{clean} bella")], "doc_id long, text string")
    assert {r.doc_id: r.score >= 0.3 for r in toxicity.score(rows, model).collect()} == {0: True, 1: True, 2: True, 3: True, 9: False}
