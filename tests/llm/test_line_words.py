"""Words of a line are what white space parts, not pieces between single spaces."""

from valora.llm import linededup


def test_tabs_part_words_and_indents_add_none(spark):
    row, brace = "\t".join(f"cell{i}" for i in range(60)), " " * 10 + "}"
    texts = {1: f"one\n{row}\n{brace}\ntwo", 2: f"three\n{row}\nfour\n{brace}\nfive"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.without_later_copies(docs).collect()}
    assert got == {1: texts[1], 2: f"three\nfour\n{brace}\nfive"}
