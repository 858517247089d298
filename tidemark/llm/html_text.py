"""Main text of web pages from streaming parser events and text-to-tag ratios.

The standard library's parser streams events. Text between block boundaries is one line; lines carry their region (the innermost
container: article, main, div, section, table cell, or an element marked by name), their number of tags, and whether all of their text is
in links.

Each line's ratio of text to tags is smoothed by a Gaussian kernel over its neighbours in the region; a line of nothing but two
or more links, or a list item that is a link, takes nothing from its neighbours. The threshold is ``SPREAD`` times the standard deviation of
the page's smoothed ratios. It clusters lines into content and the rest:

* On a page without article or main, lines that reach the threshold are taken, in whatever container.
* An article or main names the content of a page: its lines are taken, short ones too, and no others; but an article of links only beside one
  of text, and within an article a container with a name of ``HINTS``, are taken only if the mean of their smoothed ratios reaches the threshold. So cards that
  lead to other pages and a bar of links to share by go, and a chapter that is named ``related`` stays. The mean weighs lines by their text.
* Outside of articles, a container with a name of ``HINTS`` needs twice the threshold, or lies in a main and goes.

What no page's text is goes by element, role, or a name of ``MARKS``: menus, headers, footers, sidebars, adverts, forms, reader comments, scripts and styles. A
class or id counts if one of its words is such a name, not a part of it (``with-sidebar``); an article or main
inside an element dropped by name is not dropped with it. Names of ``HINTS`` never drop single paragraphs.

Character references are decoded, white space in a block becomes one space, blocks are joined by a newline.
Null and empty pages, and pages without content, give an empty text. Regions that tie are all taken. A page of any length is parsed whole. Repeated rows
give repeated results; an empty table gives an empty one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("script style noscript template nav aside footer form button select textarea option iframe object svg canvas head title dialog menu".split())
ROLES = frozenset("navigation banner complementary contentinfo search form menu menubar alert dialog alertdialog".split())
#: Names of what is never the text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo nav navbar navigation menu sidebar aside footer masthead breadcrumb breadcrumbs cookie cookies consent gdpr"
    " popup modal newsletter subscribe paywall comment comments commentlist respond disqus login signup pagination pager".split()
)
#: Names that may be the text's own: the ratios decide.
HINTS = frozenset("notice alert overlay subscription promotion share sharing social related recommended reply replies form search widget toolbar banner links tags meta".split())
BOXES = frozenset("div section td ul ol dl table details figure header fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACES = re.compile(r"\s+")
SIGMA = 1.0
SPREAD = 0.5


class _Lines(HTMLParser):
    """Lines of a page: (text, number of tags, region, kind): kind 1 is all in links, 2 as a menu is, 0 else."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []  # element, dropped, region
        self.lines: list[tuple[str, int, int, int]] = []
        #: (name of the article or main around, whether marked by HINTS) of each region
        self.regions: list[tuple[str, bool]] = [("", False)]
        self.parts: list[str] = []
        self.tags = self.links = self.linked = self.inked = 0

    def _flush(self):
        if self.parts:
            text = SPACES.sub(" ", "".join(self.parts)).strip()
            if text:
                own, linked = [x[0] for x in self.stack[-2:]], self.linked == self.inked
                kind = linked + (linked and (self.links > 1 or "li" in own) and not HEADINGS.intersection(own))
                self.lines.append((text, self.tags + 1, self.stack[-1][2] if self.stack else 0, kind))
                self.tags = 0
            self.parts = []
        self.links = self.linked = self.inked = 0

    def _drops(self, tag, attrs) -> tuple[int, bool]:
        """2: dropped; 1: dropped by its name, up to an article or main inside; and whether it is marked by ``HINTS``."""
        if tag in DROPPED:
            return 2, False
        if tag == "header" and not any(x[0] in ("article", "main") for x in self.stack):
            return 2, False
        found, hint = 0, False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return 2, False
            if not value:
                continue
            if name in ("class", "id") and tag not in ("body", "html", "article", "main"):
                words = value.lower().split()
                if not MARKS.isdisjoint(words):
                    found = 1
                elif tag in BOXES and not HINTS.isdisjoint(words):
                    hint = True
            elif name in ("class", "id") and tag == "article":
                if not {"comment", "reply", "ad", "advert", "sponsored", "promo", "related"}.isdisjoint(value.lower().split()):
                    return 2, False
            elif name == "role" and value.lower() in ROLES:
                return 2, False
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                return 2, False
        return found, hint

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            self.tags += 1
            if tag == "br":
                self.parts.append(" ")
            elif tag not in INLINE:
                self._flush()
            return
        if tag not in INLINE:
            self._flush()
        self.tags += 1
        self.links += tag == "a"
        if tag in ("article", "main"):  # broken markup: content starts outside of menus and headers that were left open
            while self.stack and self.stack[-1][0] in ("nav", "ul", "ol", "li", "a", "header", "head", "p", "b"):
                self.stack.pop()
        elif tag == "body":
            self.stack = [x for x in self.stack if x[0] == "html"]
        dropped, region = self.stack[-1][1:] if self.stack else (0, 0)
        if dropped == 1 and tag in ("article", "main"):
            dropped = 0
        hint = False
        if dropped < 2:
            own, hint = self._drops(tag, attrs)
            dropped = max(dropped, own)
        if not dropped:
            within, marked = self.regions[region]
            if tag in ("article", "main"):
                if (within, marked) != ("article", False):
                    region = len(self.regions)
                    self.regions.append(("article" if within == "article" else tag, False))
            elif hint and not marked or not within and tag in ("div", "section", "td"):
                region = len(self.regions)
                self.regions.append((within, marked or hint))
        self.stack.append((tag, dropped, region))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self._flush()
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break
            if self.stack[i][0] in ("article", "main", "body", "nav", "aside", "footer", "header", "form", "section", "table") and tag in ("p", "b", "i", "a", "span", "li", "em", "strong"):
                break  # a stray end tag does not close what surrounds it

    def handle_data(self, data):
        if self.stack and self.stack[-1][1]:
            return
        self.parts.append(data)
        n = 0 if data.isspace() else len(data)
        self.inked += n
        if any(x[0] == "a" for x in self.stack[-4:]):
            self.linked += n


def _smooth(x: list[float], bare: list[bool]) -> list[float]:
    r = math.ceil(2 * SIGMA)
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-r, r + 1)]
    out = []
    for i in range(len(x)):
        if bare[i]:
            out.append(x[i])
            continue
        total = weight = 0.0
        for d in range(-r, r + 1):
            if 0 <= i + d < len(x):
                total += kernel[d + r] * x[i + d]
                weight += kernel[d + r]
        out.append(total / weight)
    return out


def main_text(html: str, spread: float = SPREAD) -> str:
    p = _Lines()
    p.feed(html)
    p.close()
    p._flush()
    lines, regions = p.lines, p.regions
    if not lines:
        return ""
    named = any(regions[r][0] for _, _, r, _ in lines)
    prose = any(regions[r][0] and not kind for _, _, r, kind in lines)
    ratio: list[float] = []
    for _, group in groupby(lines, key=lambda x: x[2]):  # a menu's container takes nothing from the text beside it
        own = list(group)
        ratio += _smooth([len(t) / n for t, n, _, _ in own], [kind == 2 for _, _, _, kind in own])
    mean = sum(ratio) / len(ratio)
    threshold = spread * math.sqrt(sum((x - mean) ** 2 for x in ratio) / len(ratio))
    size, total, cards = [0] * len(regions), [0.0] * len(regions), [prose] * len(regions)
    for (t, _, r, kind), y in zip(lines, ratio):
        cards[r] &= kind > 0
        size[r] += len(t)
        total[r] += len(t) * y

    def taken(r: int, y: float) -> bool:
        within, marked = regions[r]
        if named:
            dense = total[r] >= threshold * size[r]
            return within == "article" and (dense or not marked and not cards[r]) or within == "main" and not marked
        return y >= threshold and (not marked or total[r] >= 2 * threshold * size[r])

    return "\n".join(t for (t, _, r, _), y in zip(lines, ratio) if taken(r, y))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""

    def run(batches):
        for batch in batches:
            texts = []
            for x in batch.column(2):
                html = x.as_py()
                texts.append(main_text(html) if html else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


#: The query in DuckDB's SQL, for pages of one article each, of headings and paragraphs, as those of the supplied tables are.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(h, '(?:[ \t\r\n]|<br[^>]*>)+', ' ', 'g'), '</?(?:p|h[1-6]|ul|ol|li|div|section)(?: [^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM b),
d AS (SELECT page_id, url, array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(regexp_replace(x, ' +', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM c)
SELECT page_id, url, text, length(text) AS n_chars FROM d"""
