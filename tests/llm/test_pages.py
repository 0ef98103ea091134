"""HTML extraction on pages written by hand, and on the given ones against an independent reading of their one template."""

import html
import re

import numpy as np
import pytest

from tillroll.llm import queries
from tillroll.llm.html_text import extract_text, main_text, smoothed, threshold

LONG = "Lorem ipsum dolor sit amet consectetur. " * 12
BODY = " ".join(LONG.split())


def article(inner):
    return f"<html><head><title>t</title></head><body><nav><a href=/>home</a></nav><article>{inner}</article><footer>(c)</footer></body></html>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   \n ", ""), ("just text", "just text"), ("<p>one</p><p>two", "one\ntwo"),
        ("<nav>menu only</nav><footer>end</footer>", ""),
        (article(f"<h1>T &amp; U</h1><p><b>{LONG}<br><p>short.</p><p>{LONG}</p>"), f"T & U\n{BODY}\nshort.\n{BODY}"),
        (article("<p>a  b\n\t c</p>"), "a b c"),
        (article("<p>x &lt;p&gt; &#233; &eacute; &amp</p>"), "x <p> é é &"),
        (article('<p>a</p><script>var t="</p><p>no";</script><style>p{}</style><!-- <p>no</p> --><p>b'), "a\nb"),
        (article('<header><h1>Title</h1></header><p>a</p><aside>no</aside><form><label>no</label><input><button>no</button></form><p>b</p><footer>no</footer>'), "Title\na\nb"),
        (article('<p>a</p><div class="ad-box"><p>no</p></div><div id="cookieNotice">no</div><section class="comments"><article><p>no</p></article></section><p>b</p>'), "a\nb"),
        (article('<p>a <span class="share">no</span> b</p><p class="advert">no</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table>'), "a b\none\ntwo\nx\ny"),
        ('<header><h1>Site</h1></header><div class="sidebar">no</div><main><h1>T</h1><p>' + LONG + "</p></main>", f"T\n{BODY}"),
        # containers without names: the region with the long lines, widened over its heading, without the row of links
        (f'<div><div><a href=a>one</a> <a href=b>two</a></div><div id=content><h1>T</h1><div><p>{LONG}</p><p>short</p><p>{LONG}</p></div></div></div>', f"T\n{BODY}\nshort\n{BODY}"),
        (article("<p>a < b &amp; c</p><p>cut <a hre"), "a < b & c\ncut"),
        (article("<p>a</p><![if IE]><p>b</p><![endif]><?php x ?></div></section><p>c</p>"), "a\nb\nc"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_clusters():
    assert threshold(np.array([3.0, 3.0])) == 3.0
    assert 10 < threshold(np.array([1.0, 2, 1, 30, 28, 31])) < 25
    even = smoothed(np.full(9, 5.0))
    assert np.allclose(even, 5.0)
    assert smoothed(np.array([0, 0, 9.0, 0, 0])).argmax() == 2


def test_long_page():
    many = "".join(f"<p>{i} {LONG}</p>" for i in range(2000))
    assert main_text(article(many)) == "\n".join(f"{i} {BODY}" for i in range(2000))
    assert main_text(article("<p>" + "word " * 1_000_000)) == " ".join(["word"] * 1_000_000)
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<div>" * 3_000 + f"<p>{LONG}</p></div>" * 3_000) == "\n".join([BODY] * 3_000)


def test_rows(spark):
    rows = [(None, "u", article("<p>a")), (1, None, None), (1, "u", article("<p>😀&#xD800;".encode("utf-16", "surrogatepass").decode("utf-16"))), (1, None, None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract_text(pages).collect()
    assert sorted(map(str, ((r.page_id, r.url, r.text) for r in got))) == sorted(map(str, [(None, "u", "a"), (1, None, ""), (1, None, ""), (1, "u", "\U0001f600�")]))
    assert all(r.n_chars == len(r.text) for r in got)
    assert extract_text(pages.limit(0)).collect() == []


def test_given_pages(spark, folder):
    """Their article is plain: blocks between p and h1 tags."""
    got = {r.page_id: r for r in queries.op11_html_text(spark, folder).collect()}
    for page_id, url, page in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect():
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[page_id].text == "\n".join(x for x in blocks if x)
        assert got[page_id].url == url
