"""Main text of web pages.

A page is read tag by tag, in time linear in its length whatever its markup, into blocks of text. Blocks in menus, footers, adverts, forms, comments and the like go by
their elements and by names that state such a role outright. A class or id that only resembles one decides nothing inside an article; there it leaves the block in doubt. So are all
blocks of pages without an article, without text by these rules, or with more text outside their articles than inside (teasers). The blocks of all pages of a host, in doubt or not, are
concatenated as streams of block numbers, and a suffix array over the streams (by prefix doubling) finds the runs that recur on distinct pages of the host. Runs that recur are boilerplate and
their blocks in doubt go; unique runs stay, and so does what the elements surely state to be the article, as sentences and whole articles recur too. A page of which nothing would be left is a
copy and stays whole.

Rows: a null or empty page has no text; markup may be broken or unclosed: an unclosed comment hides the rest of its page, and once a quoted attribute is not closed, tags end at the next ``>``.
A null url is a host of its own. Pages that repeat another page's id or html get their own rows. Pages are read whole, however long. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from valora.llm.common import text_slices
from valora.llm.linededup import stretches, suffix_ranks
from valora.session import materialize

#: A run of blocks is boilerplate if it has so many words and stands on so many pages of its host.
MIN_WORDS, MIN_PAGES = 2, 3
#: Elements by their role in a page.
SKIPPED = frozenset("script style noscript template head title nav footer aside form button select textarea input svg canvas iframe object audio video dialog menu".split())
ARTICLES = frozenset(("article", "main"))
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header "
                   "hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose end tag may be missing, with those that end them.
CLOSED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "tbody", "tfoot")),
             "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}
BARRIERS = frozenset(("ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "blockquote", "td", "th", "nav", "aside", "form"))
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|menu\w*|nav|navbar|navigation|sidebar\w*|breadcrumbs?|footer\w*|site-?header|masthead|cookies?|consent|"
    r"gdpr|notice\w*|notification\w*|alert\w*|popup|modal|overlay|newsletter|subscri\w*|signup|login|comments?|commentlist|disqus\w*|replies|respond|discussion|share|sharing|"
    r"social\w*|related|recommend\w*|widget\w*|pagination|pager|toolbar|skip-?link|hidden)(?:$|[\s_-])", re.I)
#: What a class says about its element's surroundings or style, not its role.
MODIFIER = re.compile(r"(?<![^\s_-])(?:has|no|with|overflow)[_-]\S*", re.I)
#: Elements whose text is never read.
UNREAD = frozenset("script style noscript template head title select textarea button input svg canvas iframe object audio video".split())
#: How surely an element is no main text: by a resemblance inside an article, by its class or id, by its name or role, never read.
DOUBTED, BY_CLASS, BY_ELEMENT, NEVER = 1, 2, 3, 4
#: Whole names that state a role outright, also inside an article.
STATED = frozenset("ad ads advert advertisement adsbygoogle sponsored comments comment-list commentlist comments-area disqus_thread navbar sidebar breadcrumb breadcrumbs pagination newsletter "
                   "cookie-banner cookie-notice cookie-consent share share-buttons social-share".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements whose id is an anchor of text rather than the name of a part of the page.
ANCHORS = HEADINGS | {"p", "section", "a", "li", "dt", "dd", "figure", "table", "blockquote", "span"}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
OPENING = re.compile(r"<(?:!--|([!?])|(/?)([A-Za-z][^\s/>]*))")
QUOTED = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe")}
CLOSERS = frozenset().union(*CLOSED_BY.values())


class Markup:
    """The tags of a page. What was looked for in vain, a ``>``, a quote or the end of an element, is not looked for again, so that broken pages take linear time too."""

    def __init__(self, page: str):
        self.page, self.last, self.quotes, self.unclosed = page, page.rfind(">"), True, set()

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" of an end tag, name, attributes) of the next tag from ``at``; a comment or declaration has no name."""
        page, found = self.page, OPENING.search(self.page, at)
        if not found:
            return None
        if found.start() > self.last:
            start = page.find("<!--", found.start())
            return (start, len(page), "", "", "") if start >= 0 else None
        if found[3] is None:
            mark = ">" if found[1] else "-->"
            stop = page.find(mark, found.end())
            return found.start(), len(page) if stop < 0 else stop + len(mark), "", "", ""
        rest = QUOTED.match(page, found.end()) if self.quotes else None
        if rest:
            return found.start(), rest.end(), found[2], found[3], rest[1]
        self.quotes = False
        stop = page.find(">", found.end())
        return found.start(), stop + 1, found[2], found[3], page[found.end():stop]

    def after(self, tag: str, at: int) -> int | None:
        """Where the element that holds raw text ends, if its end tag follows."""
        if tag in self.unclosed:
            return None
        found = RAW[tag].search(self.page, at)
        stop = self.page.find(">", found.end()) if found else -1
        if stop < 0:
            self.unclosed.add(tag)
            return None
        return stop + 1


def is_boilerplate(tag: str, attributes: str, inside: bool) -> int:
    """How surely an element is no main text by its name or attributes, else 0. A header inside an article is the article's own."""
    if tag in SKIPPED or tag == "header" and not inside:
        return NEVER if tag in UNREAD else BY_ELEMENT
    if not attributes or tag in ("html", "body"):
        return 0
    level = 0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).strip().lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return BY_ELEMENT
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return BY_ELEMENT
        if tag in ARTICLES or tag in HEADINGS or name not in ("class", "id") or name == "id" and tag in ANCHORS:
            continue
        if not STATED.isdisjoint(value.split()):
            level = BY_CLASS
        elif BOILERPLATE.search(MODIFIER.sub("", value)):
            level = max(level, DOUBTED if inside or tag == "p" else BY_CLASS)
    return level


def read_blocks(page: str, least: int = BY_CLASS) -> list[tuple[str, bool, bool]]:
    """(text, whether it stands in an article, whether it is in doubt) of the blocks that are not boilerplate by their elements, ``least`` surely, in page order.
    An article inside an element that goes by its class or id only stays, unless it is inside another article."""
    blocks, pieces, stack, at, n = [], [], [("", 0, False)], 0, len(page)
    # How many elements of a name are open, and where the stack holds elements that matter to missing end tags.
    opened, marks, markup = Counter(), [], Markup(page)

    def close():
        text = " ".join(entities.unescape("".join(pieces)).split())
        pieces.clear()
        _, skip, inside = stack[-1]
        if text and skip < least:
            blocks.append((text, inside, skip > 0))

    def leave(depth: int):
        opened.subtract(name for name, *_ in stack[depth:])
        del stack[depth:]
        while marks and marks[-1] >= depth:
            marks.pop()

    while at < n:
        found = markup.next(at)
        if stack[-1][1] < least:
            pieces.append(page[at:found[0] if found else n])
        if not found:
            break
        _, at, end, tag, attributes = found
        if not tag:
            continue
        tag = tag.lower()
        if tag in BLOCKS:
            close()
        elif tag in ("br", "td", "th"):
            pieces.append(" ")
        if end:
            if opened[tag]:
                leave(next(depth for depth in range(len(stack) - 1, 0, -1) if stack[depth][0] == tag))
            continue
        if tag in CLOSERS:
            # Between two barriers every name is marked once at most.
            for depth in marks[:-len(CLOSED_BY) - 2:-1]:
                name = stack[depth][0]
                if tag in CLOSED_BY.get(name, ()):
                    leave(depth)
                    # A paragraph ends within its item, which may end too.
                    if name != "p":
                        break
                elif name in BARRIERS:
                    break
        if tag in RAW and (until := markup.after(tag, at)):
            at = until
            continue
        if tag not in VOID and not attributes.rstrip().endswith("/"):
            _, skip, inside = stack[-1]
            if skip == BY_CLASS and tag in ARTICLES and not inside:
                skip = 0
            if tag in CLOSED_BY or tag in BARRIERS:
                marks.append(len(stack))
            opened[tag] += 1
            stack.append((tag, max(skip, is_boilerplate(tag, attributes, inside or tag in ARTICLES)), inside or tag in ARTICLES))
    close()
    return blocks


def blocks_of(page: str, least: int = BY_CLASS) -> list[tuple[str, bool]]:
    """(text, whether it stands in an article) of ``read_blocks``."""
    return [(text, inside) for text, inside, _ in read_blocks(page, least)]


def main_blocks(page: str) -> list[tuple[str, bool]]:
    """(text, whether it is in doubt) of the blocks that may be main text: those of the articles, or all where the articles do not hold most of the text."""
    found = read_blocks(page)
    within = sum(len(text) for text, inside, _ in found if inside)
    if found and 2 * within >= sum(len(text) for text, *_ in found):
        return [(text, doubt) for text, inside, doubt in found if inside]
    # Where the elements leave nothing, all blocks are in doubt.
    return [(text, True) for text, *_ in found or read_blocks(page, NEVER)]


def host_of(url: str | None) -> str | None:
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else None


def page_blocks(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, key, host, blocks, places): the blocks that may be main text, and the places of those in doubt."""
    def run(batches):
        for batch in text_slices(batches, 3):
            found = [main_blocks(page or "") for page in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("id", "url", "key")), pa.array([host_of(url) for url in batch.column(1).to_pylist()], pa.string()),
                pa.array([[text for text, _ in blocks] for blocks in found], pa.list_(pa.string())),
                pa.array([[i for i, (_, doubt) in enumerate(blocks) if doubt] for blocks in found], pa.list_(pa.int32()))],
                names=["id", "url", "key", "host", "blocks", "places"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.xxhash64(url_col, html_col).alias("key"), F.col(html_col).alias("html"))
    texts = T.ArrayType(T.StringType())
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("host", T.StringType()), T.StructField("blocks", texts), T.StructField("places", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def recurring(pages: DataFrame, min_words: int, min_pages: int) -> DataFrame:
    """(id, key, gone): numbers of the blocks that lie in runs of ``min_words`` words or more on ``min_pages`` distinct pages of a host."""
    lines = pages.select("id", "key", "host", F.posexplode("blocks").alias("line", "content")).select(
        "id", "key", F.col("line").alias("nth"), "line", F.size(F.split("content", " ")).alias("n_words"),
        F.xxhash64(F.lit(1), F.isnull("host"), "host", "content").alias("h1"), F.xxhash64(F.lit(2), F.isnull("host"), "host", "content").alias("h2"))
    ranks, levels = suffix_ranks(lines, min_words)
    found = materialize(stretches(ranks, levels, min_words), "block-runs")
    runs = ["length", "low", "high"]
    common = found.groupBy(*runs, "id", "key").agg(F.lit(1).alias("one")).groupBy(*runs).agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
    return found.join(common, runs).groupBy("id", "key").agg(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last")))).alias("gone"))


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_words: int = MIN_WORDS, min_pages: int = MIN_PAGES) -> DataFrame:
    """(id_col, url_col, text) of every page: its blocks in page order, one line each."""
    read = materialize(page_blocks(pages, id_col, url_col, html_col), "pages")
    gone = recurring(read, min_words, min_pages).withColumnRenamed("id", "gone_id").withColumnRenamed("key", "gone_key")
    doubtful = read.filter("size(places) > 0").join(gone.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    dropped = F.array_intersect("gone", "places")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("blocks") - 1), dropped), lambda i: F.get("blocks", i))
    names = [F.col("id").alias(id_col), F.col("url").alias(url_col)]
    sure = read.filter("size(places) = 0").select(*names, F.array_join("blocks", "\n").alias("text"))
    return sure.unionByName(doubtful.select(*names, F.array_join(F.when(F.coalesce(F.size(left), F.lit(0)) == 0, F.col("blocks")).otherwise(left), "\n").alias("text")))
