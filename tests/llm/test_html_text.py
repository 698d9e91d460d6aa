import re
from html import unescape

import duckdb
import pytest

from marketlens.llm.html_text import extracted, main_text, op1_html_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="cookie-notice">We use cookies, yes, yes, yes.</div><nav><a href=/>Home</a></nav><!-- <p>gone</p> -->
<div class=page><div class="content sidebar-left"><main><article class="post"><h1>Real title</h1><p>First, para &amp; more&nbsp;text.<p>Second para
with   break<br>here <script>x<y</script> and <b>bold</b> end.</p><div class="advert">Buy, now, now, now</div><ul><li>one<li>two</ul>
<table><tr><td>a<td>b</table></article><section id="comments"><article class="comment"><p>I, think, this, is, a long comment by a reader
who writes, much, more, than, the, author, ever, did</p></article></section></main></div><div class="sidebar"><p>Side, bar</p></div></div>
<form><p>Your name, please</p></form><footer>foot</footer></body></html>"""


def test_article_without_what_surrounds_it():
    assert main_text(PAGE).split("\n\n") == [
        "Real title", "First, para & more text.", "Second para with break here and bold end.", "one", "two", "a", "b",
    ]


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; text", "plain & text"), ("<p>only", "only"), ("<div/><p>x</p></div></p></zz>", "x"),
        ("<script>a</script>", ""), ("<p>a&#44;&#x42;&lt;c", "a,B<c"), ("<div hidden><p>no</div><div><p>yes", "yes"), ("<p title='>'>t</p>", "t"),
    ],
)
def test_small_pages(html, text):
    assert main_text(html) == text


def test_scores_find_the_container_and_keep_near_siblings():
    long = "A sentence, with some commas, and enough words to count for a paragraph. " * 3
    html = f"<body><div><a href=1>{long}</a></div><div><section><p>{long}</p><p>{long}</p></section><section><p>{long}</p></section></div></body>"
    assert main_text(html).count("A sentence") == 9  # three paragraphs of three; the link is out


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert len(main_text("<article>" + "<p>word, word</p>" * 20_000 + "</article>")) == 20_000 * 12 - 2


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", None), (1, "u", PAGE, "x")], "page_id long, url string, html string, text string")
    rows = extracted(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in rows) == [(0, 0), (1, len(main_text(PAGE))), (1, len(main_text(PAGE))), (2, 0)]
    assert extracted(pages.limit(0)).count() == 0


def test_whole_table(spark):
    """Every page of the table is an article among a menu, an advert and a footer."""
    sf = "/root/testdata/sf0.01"
    pages = dict(duckdb.sql(f"select page_id, html from '{sf}/pages.parquet'").fetchall())
    found = op1_html_text(spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>|<br>", " ", article))
        blocks = [" ".join(unescape(p).split()) for p in parts]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
