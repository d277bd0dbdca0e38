"""Main text of pages."""

import re
from html import unescape

import numpy as np
import pytest

from cellamp.llm import extraction
from cellamp.llm.extraction import main_text
from cellamp.llm.queries import QUERIES
from cellamp.llm.tables import table


def marked_article(html):
    """The text of the one article element of a test page, cut by patterns that fit those pages only."""
    body = re.search(r"<article>(.*)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|ul|li|div)>", body.replace("<br>", " "))
    texts = (" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
    return " ".join(t for t in texts if t)


def test_the_query_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    rows = QUERIES["op12_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.text == marked_article(pages[r.page_id].html) and r.n_chars == len(r.text)


ARTICLE = "<h1>The title</h1><p>First paragraph &amp; its <b>bold</b> text, which is of some length.</p><p>Short.</p><p>Another longer paragraph of the text.</p>"
TEXT = "The title First paragraph & its bold text, which is of some length. Short. Another longer paragraph of the text."
JUNK = [
    "<nav><ul><li><a href=x>Home</a></li></ul></nav>", "<header><h1>Site name</h1><p>Motto of the site, a long one that has many words in it</p></header>",
    "<aside><p>Sidebar with quite a lot of text in it, more than the article has in any of its lines</p></aside>", "<footer>&copy; all rights</footer>",
    "<form><label>Name</label><input name=a><textarea>type</textarea><button>Send</button></form>", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style>",
    "<div class='cookie-notice'><p>We use cookies to make this page better and better for all</p></div>", "<div class=\"ad\">Buy now</div>", "<div id=sidebarLeft>links</div>",
    "<section id='comments'><article><p>First! What a long comment by a reader this is</p></article></section>", "<p class='advert'>Buy", "<div hidden>x</div>",
    "<div role=navigation>Menu</div>", "<div style='display: none'>unseen</div>", "<noscript>Turn it on</noscript>", "<!-- a comment -->", "<template><p>t</p></template>",
]


@pytest.mark.parametrize("holder", ["article", "main", "div id=story"])
def test_junk_around_and_inside_is_left_out(holder):
    end = holder.split()[0]
    for junk in [*JUNK, "".join(JUNK)]:
        inner = re.sub("<header>.*</header>", "", junk)  # an article's own header keeps its headings
        for before, inside, after in ((junk, "", ""), ("", "", junk), ("", inner, ""), (junk, inner, junk)):
            html = f"<html><head><title>T</title></head><body class='has-sidebar'>{before}<{holder}>{inside}{ARTICLE}{inside}</{end}>{after}</body></html>"
            assert main_text(html) == TEXT, (junk, before, inside, after)


def test_headers_of_articles_keep_their_headings():
    html = "<body><header><h1>Site</h1></header><article><header><h1>The <i>title</i></h1><p>By a writer</p></header><p>Text of the article.</p></article>"
    assert main_text(html) == "The title Text of the article."
    assert main_text("<div class='entry-header'><h2>Own</h2><span>today</span></div><article><p>Body of the page</p></article>") == "Body of the page"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("  \n ", ""), ("plain text only", "plain text only"), ("<p>a<br>b<br/>c", "a b c"), ("<p>a&nbsp;&#x41; \t\n b</p>", "a A b"),
        ("<article><p>un<b>closed <i>inline<p>next</article>", "unclosed inline next"), ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one two x y"),
        ("<article><p>a</b></div>b</p></article>", "ab"), ("<head><title>t</title><p>no body tag</p>", "no body tag"), ("<article>co<!-- x -->mment</article>", "comment"),
        ("<article><p>5 < 6 & 7 > 2 &bogus; &lt;p&gt;</p></article>", "5 < 6 & 7 > 2 &bogus; <p>"), ("<nav>only</nav>", ""), ("<article><div/><p>slash</p></article>", "slash"),
        ("<ARTICLE><P>Upper</P></ARTICLE><P>outside</P>", "Upper"), ("<article><p>x</p></article><article><p>y</p></article>", "x y"),
        ("<article><h1>T</h1></article>", "T"), ("<article><p>é\U0001f600 漢</p></article>", "é\U0001f600 漢"),
    ],
)
def test_small_pages(html, text):
    assert main_text(html) == text


def test_pages_without_an_article_element():
    paragraphs = "".join(f"<p>Paragraph {k} of the page has some more words than a menu has, and few tags.</p>" for k in range(6))
    html = f"<body><div><a href=a>One</a> <a href=b>Two</a> <a href=c>Three</a></div><div><h2>Head</h2>{paragraphs}<p>End.</p></div><div><a href=d>Four</a></div></body>"
    got = main_text(html)
    assert got.startswith("Head Paragraph 0") and got.endswith("End.") and "Two" not in got and "Four" not in got


def test_smoothing_and_threshold():
    ratios = np.array([0, 0, 10.0, 0, 0, 0, 0])
    smooth = extraction.smoothed(ratios)
    weights = [np.exp(-(d**2) / 2.0) for d in (-2, -1, 0, 1, 2)]
    assert smooth == pytest.approx([10 * weights[k] / sum(weights) if k < 5 else 0 for k in range(7)])
    assert extraction.content_lines(ratios).tolist() == [False, False, True, False, False, False, False]
    assert extraction.content_lines(np.array([3.0, 3.0])).all() and not extraction.content_lines(np.zeros(3)).any()


def test_long_and_deep_pages():
    deep = "<div>" * 100_000 + "<article><p>in the deep</p></article>"
    assert main_text(deep) == "in the deep"
    long = "<article>" + "<p>word <b>of a text that goes on <a href=x>and on</a>" * 50_000 + "</article>"
    assert len(main_text(long)) == 50_000 * len("word of a text that goes on and on ") - 1
    assert main_text("<article><p>" + "x" * 3_000_000) == "x" * 3_000_000
    assert main_text("<b>" * 100_000 + "<article>a<p>b</article>") == "a b"


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article>a</article>"), (2, "u", ""), (3, "u", "<article>\U0001f600b</article>")]
    frame = spark.createDataFrame([(*r, "taken") for r in rows], "page_id bigint, url string, html string, _text string")
    got = extraction.extract_text(frame).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "a", 1), (2, "u", "", 0), (3, "u", "\U0001f600b", 2)], key=str)
    assert extraction.extract_text(frame.limit(0)).count() == 0
