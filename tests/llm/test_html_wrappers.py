"""Classes of wrappers around articles, and pages that the element rules would leave empty."""

import pytest

from valora.llm import htmltext


@pytest.mark.parametrize("name", ["overflow-hidden", "has-sidebar", "no-comments", "share-enabled", "has-left-sidebar"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrappers_keep_their_article(name, tag):
    page = f"<body><nav>Menu</nav><div class='{name}'><{tag}><p>Body text</p><div class='comments'><article>Reply</article></div></{tag}></div><div class='sidebar'>Side</div></body>"
    assert [text for text, inside in htmltext.blocks_of(page) if inside] == ["Body text"]


def test_inline_boilerplate_stays_out_of_its_block():
    page = "<body><main><p>One <span class='share'>Share</span> two</p></main></body>"
    assert htmltext.blocks_of(page) == [("One two", True)]


def test_pages_without_other_text_are_in_doubt(spark):
    pages = spark.createDataFrame([(1, "http://h/1", "<body><div class='widget'><p>Only text</p></div><script>no</script></body>")], "page_id long, url string, html string")
    assert [r.text for r in htmltext.main_text(pages).collect()] == ["Only text"]
