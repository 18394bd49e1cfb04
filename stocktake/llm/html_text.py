"""Main text of HTML pages by tree scoring.

A page becomes a tree (``Page``). Elements that say what they are (navigation, forms, scripts, hidden parts, class
names such as ``sidebar``) are left out with all below them. Each paragraph of what remains gives points for its
length and its commas to its ancestors, the nearer the more; a container's points are multiplied by one less its link
density. The container with the most points is kept, with those siblings that have points of their own or are
plain text, and grows to the ``article`` or ``main`` element around it. Inside it nothing is dropped but lists and
boxes that are mostly links.

Blocks are the texts between the boundaries of block elements; white space in a block (``br`` included) is one space.

Defined cases: a null or empty page, and one without text, gives an empty text; equal pages have equal texts; broken
markup (unclosed or crossed tags, missing ``body``) never fails; a page without markup is all text. Extra columns
are ignored; ``page_id`` and ``url`` are passed on as they are, nulls included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.text import slices

# Element names by what they are for.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "html body address article aside blockquote caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = set(
    "head title script style noscript template nav footer aside form button select textarea input label fieldset iframe object "
    "embed svg canvas math audio video map dialog menu menuitem datalist option progress meter".split()
)
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status tooltip tablist".split())
# Forms may stand around a whole page.
WRAPPERS = {"form", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "li", "dd", "figcaption"}
PLAIN = HEADINGS | {"p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure", "hr"}
BOXES = {"ul", "ol", "dl", "div", "section", "table"}
# Elements whose end tag may be left out: a start tag closes the named open ones, up to the given boundary.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
# Words of class names and ids. A part that holds the readers' words goes whatever else it is called.
READERS = set("comment comments commentlist commentary disqus respond replies reply guestbook".split())
UNLIKELY = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline consent cookie cookies copyright dialog "
    "disclaimer footer foot gdpr header hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager pagination paywall popup popover promo promotion promoted rail recommend recommended recommendations related rss "
    "search share sharing shoutbox sidebar sidebars signup skip skyscraper social sponsor sponsored subscribe subscription taboola tags teaser "
    "toolbar tooltip topbar widget widgets".split()
)
LIKELY = set("article articlebody body column content entry hentry main mainbody page post story text".split())
# `has-sidebar`, `no-comments`: what a page has, not what the element is.
ABOUT = {"has", "with", "no", "without", "is", "open", "closed", "enabled", "disabled"}

#: Shorter paragraphs give no points (they are kept as text), unless the page has none longer.
MIN_POINTS_LENGTH = 25
#: Points: one a paragraph, one a comma, one a hundred characters up to three.
LENGTH_POINT, MOST_LENGTH_POINTS = 100, 3
#: A sibling stays with this share of the best container's points.
SIBLING_SHARE = 0.2
#: A list or box inside the article with more of its text in links than this is a menu.
MENU_LINKS = 0.5
CLASS_POINTS = 25
#: A paragraph's points reach this many containers above it.
LEVELS = 8
TAG_POINTS = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ol": -3, "ul": -3, "dl": -3, "li": -3, "dd": -3, "dt": -3, "th": -5}
TAG_POINTS |= dict.fromkeys(HEADINGS, -5)

SPACE = re.compile(r"\s+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
COMMA = re.compile("[,،﹐﹑、，]")


class Page(HTMLParser):
    """The tree as parallel lists by node number (parents come before their children), texts as nodes named ``#``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.up, self.attrs, self.text, self.end = ["#root"], [-1], [{}], [""], [0]
        self.open = [0]
        self.count = {"#root": 1}  # open elements by name, so that a stray end tag needs no search

    def put(self, tag: str, attrs: dict, text: str = "") -> int:
        self.tag.append(tag), self.up.append(self.open[-1]), self.attrs.append(attrs), self.text.append(text), self.end.append(0)
        return len(self.tag) - 1

    def pop(self) -> str:
        node = self.open.pop()
        self.count[self.tag[node]] -= 1
        self.end[node] = len(self.tag)
        return self.tag[node]

    def shut(self, names: set, boundary: set) -> None:
        """Close the open elements up to the outermost of ``names`` above the nearest ``boundary``."""
        if not any(self.count.get(n) for n in names):
            return
        depth = 0
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[k]]
            if tag in boundary:
                break
            if tag in names:
                depth = k
        while depth and len(self.open) > depth:
            self.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK and tag != "option":
            self.shut({"p"}, BLOCK - {"p"})
        if tag in HEADINGS:
            self.shut(HEADINGS, BLOCK - HEADINGS)
        if tag in CLOSES:
            self.shut(*CLOSES[tag])
        node = self.put(tag, dict(attrs))
        if tag in VOID:
            self.end[node] = node + 1
        else:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing on elements that aren't void

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        if not self.count.get(tag):
            return
        if tag not in BLOCK:  # an inline end tag doesn't close blocks
            for node in reversed(self.open):
                if self.tag[node] == tag:
                    break
                if self.tag[node] in BLOCK:
                    return
        while self.pop() != tag:
            pass

    def handle_data(self, data: str) -> None:
        node = self.put("#", {}, data)
        self.end[node] = node + 1

    def tree(self, html: str) -> Page:
        self.feed(html)
        self.close()
        while self.open:
            self.pop()
        return self


def names_of(attrs: dict) -> set:
    """The words of an element's class names and id, without names that only tell what the page has."""
    words = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        parts = {p.lower() for p in NAME_PARTS.findall(name)}
        if not parts & ABOUT:
            words |= parts
    return words


def left_out(page: Page, by_name: bool) -> list[bool]:
    """Whether each node lies in an element that is no part of any article, by its kind and, if asked for, by its names."""
    n = len(page.tag)
    holds, titled, in_article = [False] * n, [False] * n, [False] * n  # article or main below; main or h1 below; above
    for k in range(n - 1, 0, -1):
        if page.tag[k] in ("article", "main") or holds[k]:
            holds[page.up[k]] = True
        if page.tag[k] in ("main", "h1") or titled[k]:
            titled[page.up[k]] = True
    out = [False] * n
    heads = [False] * n  # header of an article: only its headings are text
    for k in range(1, n):
        up, tag, attrs = page.up[k], page.tag[k], page.attrs[k]
        in_article[k] = in_article[up] or tag in ("article", "main")
        heads[k] = heads[up] or (tag in ("header", "hgroup") and in_article[up])
        if out[up] or (tag in LEFT_OUT and not (tag in WRAPPERS and holds[k])) or (tag == "header" and not in_article[up]):
            out[k] = True
        elif tag == "#":
            out[k] = heads[k] and not any_heading(page, up)
        elif attrs:
            words = names_of(attrs)
            gone = attrs.get("role") in LEFT_OUT_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            gone = gone or bool(re.search(r"(display\s*:\s*none|visibility\s*:\s*hidden)", attrs.get("style") or "", re.I))
            if by_name and tag not in ("html", "body"):
                gone = gone or (bool(words & READERS) and not titled[k])
                gone = gone or (bool(words & UNLIKELY) and tag not in ("article", "main") and not holds[k])
            out[k] = gone
    return out


def any_heading(page: Page, node: int) -> bool:
    while node > 0 and page.tag[node] not in BLOCK:
        node = page.up[node]
    return page.tag[node] in HEADINGS


def main_text(html: str | None) -> str:
    """The article's text, blocks joined by line feeds. If no text is left, names of elements are not looked at."""
    if not html or not html.strip():
        return ""
    page = Page().tree(html)
    return article_text(page, True) or article_text(page, False)


def article_text(page: Page, by_name: bool) -> str:
    n, tag, up = len(page.tag), page.tag, page.up
    out = left_out(page, by_name)
    # Characters, characters in links, and commas of every element; direct text makes a paragraph of any block.
    size, links, commas, linked = [0] * n, [0] * n, [0] * n, [False] * n
    boxed, direct = [False] * n, [False] * n  # has a block child; has text outside block children
    for k in range(1, n):
        linked[k] = linked[up[k]] or tag[k] == "a"
        if tag[k] == "#" and not out[k]:
            size[k] = len(SPACE.sub(" ", page.text[k]).strip())
            links[k] = size[k] if linked[k] else 0
            commas[k] = len(COMMA.findall(page.text[k]))
    for k in range(n - 1, 0, -1):
        u = up[k]
        size[u] += size[k]
        links[u] += links[k]
        commas[u] += commas[k]
        boxed[u] = boxed[u] or tag[k] in BLOCK or boxed[k] and tag[k] not in BLOCK
        direct[u] = direct[u] or (tag[k] == "#" and size[k] > 0) or (direct[k] and tag[k] not in BLOCK)
    if not size[0]:
        return ""
    points = scores(page, out, size, links, commas, boxed, direct, MIN_POINTS_LENGTH) or scores(page, out, size, links, commas, boxed, direct, 1)
    kept = [0]
    if points:
        final = {k: p * (1 - links[k] / size[k]) for k, p in points.items()}
        best = max(final, key=lambda k: (final[k], -k))
        kept = container(page, out, size, links, final, best)
    return blocks(page, out, size, links, kept)


def scores(page: Page, out: list, size: list, links: list, commas: list, boxed: list, direct: list, least: int) -> dict[int, float]:
    """Points of the containers, before the link density."""
    points: dict[int, float] = {}
    for k in range(1, len(page.tag)):
        tag = page.tag[k]
        if out[k] or size[k] < least or tag not in BLOCK:
            continue
        if not (tag in PARAGRAPHS and not boxed[k] or direct[k] and tag not in HEADINGS):
            continue
        given = (1 + commas[k] + min(size[k] // LENGTH_POINT, MOST_LENGTH_POINTS)) * (1 - links[k] / size[k])
        node, level = page.up[k] if tag in PARAGRAPHS or page.up[k] == 0 else k, 0
        while node >= 0 and level < LEVELS:
            if page.tag[node] in BLOCK or node == 0:
                if node not in points:
                    words = names_of(page.attrs[node])
                    points[node] = TAG_POINTS.get(page.tag[node], 0) + (CLASS_POINTS if words & LIKELY else 0) - (CLASS_POINTS if words & UNLIKELY else 0)
                points[node] += given / (1 if level == 0 else 2 if level == 1 else 3 * level)
                level += 1
            node = page.up[node]
    return points


def container(page: Page, out: list, size: list, links: list, final: dict, best: int) -> list[int]:
    """The article or main element around the best container, or else that container and the siblings that belong to it."""
    node, around = best, None
    while node > 0:
        if page.tag[node] == "article" or (page.tag[node] == "main" and around is None):
            around = node
        node = page.up[node]
    if around is not None:
        return [around]
    if best == 0 or page.tag[best] in ("body", "html"):
        return [best]
    kept, least = [], max(10.0, final[best] * SIBLING_SHARE)
    for k in children(page, page.up[best]):
        if k == best:
            kept.append(k)
        elif not out[k] and size[k]:
            density = links[k] / size[k]
            if final.get(k, 0) >= least or (page.tag[k] in PLAIN and density < 0.25):
                kept.append(k)
    return kept


def children(page: Page, node: int) -> Iterator[int]:
    k = node + 1
    while k < page.end[node]:
        yield k
        k = page.end[k]


def blocks(page: Page, out: list, size: list, links: list, kept: list[int]) -> str:
    """Texts of the kept elements between block boundaries, without left-out parts and menus."""
    done, now = [], []

    def flush() -> None:
        block = SPACE.sub(" ", "".join(now)).strip()
        now.clear()
        if block:
            done.append(block)

    for top in kept:
        flush()
        ends: list[int] = []  # of the open blocks
        k = top
        while k < page.end[top]:
            while ends and ends[-1] <= k:
                ends.pop()
                flush()
            tag = page.tag[k]
            if out[k] or (k != top and tag in BOXES and size[k] and links[k] > MENU_LINKS * size[k]):
                if tag in BLOCK:
                    flush()
                k = page.end[k]
                continue
            if tag == "#":
                now.append(page.text[k])
            elif tag == "br":
                now.append(" ")
            elif tag in BLOCK:
                flush()
                ends.append(page.end[k])
            k += 1
        flush()
    return "\n".join(done)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        text = pa.array([main_text(h) for h in batch.column("html").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), text], ["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, its main ``text`` and ``n_chars`` (code points)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = rows.mapInArrow(_texts, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
