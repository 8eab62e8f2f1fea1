"""Class names and ids inside articles, teasers, and broken markup of a megabyte; a plain second reader of well-formed pages."""

import random
import time
from html.parser import HTMLParser

import pytest

from valora.llm import htmltext


def test_names_inside_articles_decide_nothing(spark):
    parts = ["<h1>Title</h1>", "<p>Intro</p>", '<h2 id="discussion">Discussion</h2>', '<section id="discussion"><p>What follows</p></section>', '<section class="related-work">Earlier work</section>',
             '<p class="notice">A note</p>', '<h2 id="hidden-costs">Hidden costs</h2>', '<div class="social-history">History</div>', "<h2 id=share-prices>Share prices</h2>"]
    body = "".join(parts) + '<div class="ad">Buy</div><div id="comments"><p>Reply</p></div>'
    pages = spark.createDataFrame([(1, "http://h/1", f"<body><article>{body}</article></body>")], "page_id long, url string, html string")
    kept = ["Title", "Intro", "Discussion", "What follows", "Earlier work", "A note", "Hidden costs", "History", "Share prices"]
    assert [r.text.split("\n") for r in htmltext.main_text(pages).collect()] == [kept]


def test_doubtful_blocks_of_articles_go_where_they_recur(spark):
    page = "<body><article><p>Own text {k}</p><div class='related-links'>More of the same</div><div class='social-history'>History {k}</div><p>More of the same</p></article></body>"
    rows = [(k, f"http://h/{k}", page.format(k=k)) for k in range(4)]
    rows.append((9, "http://other/9", page.format(k=9)))
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: f"Own text {k}\nHistory {k}\nMore of the same" for k in range(4)}, 9: "Own text 9\nMore of the same\nHistory 9\nMore of the same"}


def test_teasers_do_not_replace_the_text(spark):
    text = "A long text that is the main part of this page"
    page = f'<body><div class="post-body"><p>{text}</p></div><article class="teaser">Read on</article></body>'
    pages = spark.createDataFrame([(1, "http://h/1", page)], "page_id long, url string, html string")
    assert [r.text for r in htmltext.main_text(pages).collect()] == [f"{text}\nRead on"]


@pytest.mark.parametrize("piece", [
    "<a ", "<script>", '<p class="', "<b>", "<li><p>", "<p \">\" ", "<!", "<!--", "</script", "<script></script ", "<div class='", "<a<a", "<p class=class=class=", "</i><b>", "<td><li><p>", "<p '>\"",
    "&amp", "<svg><title>", "<ul><li>", "<dt><option><tbody>", "< ", "<div class=\"advert_"])
@pytest.mark.parametrize("tail", ["", ">", "\">", "</i>"])
def test_a_megabyte_of_broken_markup(piece, tail):
    page = piece * (1_000_000 // len(piece)) + tail
    begin = time.process_time()
    htmltext.main_blocks(page)
    assert time.process_time() - begin < 8


class Plain(HTMLParser):
    """Blocks of well-formed pages: what stands in the article and in no skipped element."""

    def __init__(self):
        super().__init__()
        self.path, self.text, self.blocks = [], "", []

    def flush(self):
        if words := self.text.split():
            self.blocks.append(" ".join(words))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in htmltext.BLOCKS:
            self.flush()
        if tag == "br":
            self.text += " "
        else:
            self.path.append((tag, dict(attrs)))

    def handle_endtag(self, tag):
        if tag in htmltext.BLOCKS:
            self.flush()
        self.path.pop()

    def handle_data(self, data):
        tags = {tag for tag, _ in self.path}
        if "article" in tags and not tags & {"aside", "script", "style", "form"} and not any(a.get("class") == "ad" for _, a in self.path):
            self.text += data


@pytest.mark.parametrize("seed", range(40))
def test_well_formed_pages_against_a_plain_reader(seed):
    rnd = random.Random(seed)

    def words():
        return rnd.choice(["one", "two  three\n", "a &lt; b", "&eacute;t&eacute; &#8212; x", "café &amp; co ", "漢字"])

    def flow(depth):
        out = []
        for _ in range(rnd.randint(1, 4)):
            kind = rnd.randint(0, 8 if depth else 4)
            if kind <= 2:
                out.append(f"<p>{words()} <b title='x > y'>{words()}</b>{words()}</p>")
            elif kind == 3:
                out.append(f"<h2 id=comments>{words()}<br>{words()}</h2>")
            elif kind == 4:
                out.append(f"<script>if (a<b) {{ '</p>' }}</script><!-- {words()} > -->")
            elif kind == 5:
                out.append(f"<ul><li>{flow(depth - 1)}</li><li>{words()}</li></ul>")
            elif kind == 6:
                out.append(f"<aside>{flow(depth - 1)}</aside>")
            elif kind == 7:
                out.append(f'<div class="ad">{flow(depth - 1)}</div>')
            else:
                out.append(f"<section>{words()}{flow(depth - 1)}{words()}</section>")
        return "".join(out)

    page = f"<html><head><title>t</title></head><body><nav><p>{words()}</p></nav><article>{flow(3)}</article><footer>{words()}</footer></body></html>"
    plain = Plain()
    plain.feed(page)
    plain.flush()
    assert [text for text, inside in htmltext.blocks_of(page) if inside] == plain.blocks


def test_blocks_that_are_sure_count_where_a_doubtful_one_recurs(spark):
    """All blocks of a host go through the suffix ranks, not only those in doubt; what is surely the article's stays all the same."""
    doubtful = "<body><article><p>Own text 0</p><div class='related-links'>More of the same</div></article></body>"
    sure = "<body><article><p>Own text {k}</p><p>More of the same</p></article></body>"
    rows = [(0, "http://h/0", doubtful), (9, "http://other/9", doubtful), *((k, f"http://h/{k}", sure.format(k=k)) for k in range(1, 3))]
    got = {r.page_id: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "Own text 0", 9: "Own text 0\nMore of the same", **{k: f"Own text {k}\nMore of the same" for k in range(1, 3)}}
