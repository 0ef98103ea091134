"""Main text of web pages: text-to-tag ratios of a page's lines, smoothed, clustered, and widened to whole regions.

The standard library's parser streams a page's events. A line is the text between two block tags; it knows its letters
outside links, its tags, and the region (the nearest article, or else the nearest container) that holds it. Lines inside
menus, footers, forms and the like are never made. The ratio of letters to tags of each line is smoothed with a Gaussian
over its neighbours, and a line is content where the smoothed ratio is over the threshold that splits the page's lines into
two clusters. The region with most content letters is the article: all its lines are kept, so that a short paragraph or
heading between long ones is not lost, and it grows to the enclosing container while what that adds is headings or content.
"""

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.workspace import map_arrow

#: Width of the Gaussian in lines, and the reach on either side.
SIGMA, REACH = 1.0, 3

#: Elements that never hold the article's text.
LEFT_OUT = frozenset(
    "head title script style noscript template svg math canvas iframe object audio video map nav menu aside footer form "
    "button select datalist option optgroup textarea label fieldset legend dialog".split()
)
#: Names in class, id or role that mark what surrounds an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars "
    "widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs menu menus nav navbar "
    "navigation navigate pager pagination toolbar footer comment comments commentlist reply replies respond disqus "
    "discussion complementary contentinfo search searchbox skip".split()
)
#: Names that do so only outside an article, where they may hold its own title.
HEADING = frozenset("header masthead topbar".split())

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An end tag closes open elements up to its own, but none of a higher rank.
_RANK = dict.fromkeys("p h1 h2 h3 h4 h5 h6 pre li dt dd tr td th caption figcaption summary address center".split(), 1)
_RANK |= dict.fromkeys("div ul ol dl table tbody thead tfoot blockquote figure details hgroup".split(), 2)
_RANK |= dict.fromkeys("section header nav aside footer form menu fieldset dialog".split(), 3)
_RANK |= {"article": 4, "main": 4, "body": 5, "html": 6}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Lines(HTMLParser):
    """Collects the lines of a page: text, letters outside links, tags, region, and whether it is a heading."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, region, left out
        self.parents = [-1]  # of each region; region 0 is the page
        self.articles = [False]
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self.parts: list[str] = []
        self.letters = self.tags = self.links = 0

    def _state(self) -> tuple[int, bool]:
        return self.open[-1][1:] if self.open else (0, False)

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            heading = bool(self.open) and self.open[-1][0] in _HEADINGS
            self.lines.append((text, self.letters, self.tags, self._state()[0], heading))
        self.parts, self.letters, self.tags, self.links = [], 0, 0, 0

    def _within_article(self) -> bool:
        region = self._state()[0]
        return self.articles[region]

    def _around(self, tag: str, attrs: list) -> bool:
        if tag in LEFT_OUT:
            return True
        if tag in ("html", "body", "main"):
            return False
        names = {n.lower() for k, v in attrs if k in ("class", "id", "role") and v for n in _NAMES.findall(v)}
        if names & AROUND:
            return True
        return (tag == "header" or bool(names & HEADING)) and not self._within_article()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        rank = _RANK.get(tag, 0)
        if tag in _VOID:
            self.parts.append(" " if tag == "br" else "")
            if tag == "hr":
                self._end_line()
            self.tags += 1
            return
        region, out = self._state()
        if rank:
            self._end_line()
            self._imply_end(tag, rank)
            region, out = self._state()
        inner = out or self._around(tag, attrs)
        if rank >= 2 and not inner and not self.articles[region]:
            self.parents.append(region)
            self.articles.append(tag in ("article", "main"))
            region = len(self.parents) - 1
        self.tags += 1
        if tag == "a":
            self.links += 1
        if rank or inner != out:
            self.open.append((tag, region, inner))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # a slash in a start tag closes only void elements

    def _imply_end(self, tag: str, rank: int) -> None:
        """A block ends an open paragraph or heading; a list item, row or cell ends the one before."""
        while self.open and (top := self.open[-1][0]) and (
            _RANK.get(top, 0) == 0 and not self.open[-1][2] or top in ("p", "pre") or top in _HEADINGS
            or rank == 1 and top == tag or (tag, top) in _FOLLOWS
        ):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        rank = _RANK.get(tag, 0)
        if rank:
            self._end_line()
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == tag:
                del self.open[k:]
                return
            if _RANK.get(name, 0) > rank or not rank and _RANK.get(name, 0):
                return

    def handle_data(self, data: str) -> None:
        if not self._state()[1]:
            self.parts.append(data)
            if not self.links:
                self.letters += len(data) - data.count(" ")

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def finish(self) -> None:
        """Ends the page; markup that was cut off in the middle is not text."""
        if re.match(r"<[a-zA-Z/!?]", self.rawdata):
            self.rawdata = ""
        self.close()
        self._end_line()


_FOLLOWS = frozenset([("dt", "dd"), ("dd", "dt"), ("td", "th"), ("th", "td"), ("tr", "td"), ("tr", "th"), ("tbody", "tr"), ("tbody", "td")])
_KERNEL = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Ratios under a Gaussian over neighbouring lines, with its weight cut at the page's ends."""
    n = len(ratios)
    return (np.convolve(ratios, _KERNEL) / np.convolve(np.ones(n), _KERNEL))[REACH : REACH + n]


def threshold(values: np.ndarray) -> float:
    """The cut that splits values into a low and a high cluster (two means, from the extremes). Equal values are one cluster."""
    low, high = float(values.min()), float(values.max())
    if low == high:
        return low
    for _ in range(64):
        cut = (low + high) / 2
        under = values < cut
        now = float(values[under].mean()), float(values[~under].mean())
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article's blocks joined by line feeds; empty for a page without text."""
    page = _Lines()
    page.feed(html or "")
    page.finish()
    if not page.lines:
        return ""
    letters = np.array([x[1] for x in page.lines], float)
    values = smoothed(letters / np.maximum(1, [x[2] for x in page.lines]))
    content = values >= threshold(values)
    regions = np.array([x[3] for x in page.lines])
    n = len(page.parents)
    # content letters of the lines that a region holds itself; articles with content go before containers
    mass = np.bincount(regions[content], letters[content] + 1e-9, minlength=n)
    articles = np.array(page.articles) & (mass > 0)
    best = int(np.argmax(np.where(articles, mass, 0) if articles.any() else mass))
    ends = _ends(page.parents)
    keep = (regions >= best) & (regions < ends[best])
    while (above := page.parents[best]) >= 0:
        wider = (regions >= above) & (regions < ends[above])
        if not all(content[i] or page.lines[i][4] for i in np.flatnonzero(wider & ~keep)):
            break
        best, keep = above, wider
    return "\n".join(x[0] for x, k in zip(page.lines, keep) if k)


def _ends(parents: list[int]) -> list[int]:
    """The number behind the last region inside each. Regions are numbered as they open, so those inside one follow it."""
    ends = list(range(1, len(parents) + 1))
    for i in range(len(parents) - 1, 0, -1):
        ends[parents[i]] = max(ends[parents[i]], ends[i])
    return ends


def extract_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: (id_col, url_col, text, n_chars = code points of text).

    A null or empty page, and one with nothing but what surrounds an article, gives an empty text. Null ids and repeated rows
    keep their rows, an empty table gives none, other columns are not read. A page is parsed whole whatever its length; each is
    handled by itself, so a task holds one batch of pages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            n_chars = pa.array([len(x) for x in texts], pa.int64())
            # a lone surrogate, which a character reference can name, is not valid text
            texts = pa.array([x.encode("utf-8", "replace").decode() for x in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, n_chars], names=["id", "url", "text", "n_chars"])

    columns = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [f.dataType.simpleString() for f in columns.schema.fields[:2]]
    out = map_arrow(columns, run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
