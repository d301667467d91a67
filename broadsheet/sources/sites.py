"""Article and link extraction by site profile, for pages whose elements nest.

A profile names what to look for; the standard library's HTML parser finds it inside an
Arrow-batched function, one page at a time, so pages are spread like any other rows.
Pages with plain markup are served by ``functions.pages`` without Python.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import times as TM
from broadsheet.functions.text import compute_once

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())


@dataclass(frozen=True)
class Site:
    """What to read on a site's pages.

    ``title`` and ``content`` are alternatives by priority; each is a comma list of
    selectors (``tag.class``, ``.class``, ``#id``, blanks for ancestors), of which the first
    match in the page counts. ``drop`` is cut out of the content. A press or date may sit
    in an attribute.
    """

    title: tuple[str, ...]
    content: tuple[str, ...]
    drop: str
    press_name: str | None = None
    press: str | None = None
    press_attribute: str | None = None
    date: str | None = None
    date_attribute: str | None = None


@dataclass(frozen=True)
class LinkList:
    """Where a list page keeps its links: items without ``ad_class``, usually the first ``cap``.

    ``link`` is looked up inside an item, ``item`` means the item is the link itself, and
    ``parent`` the link around it. With a ``root`` relative links are completed, without
    one only absolute links are kept.
    """

    items: str
    cap: int
    link: str = "item"
    ad_class: str | None = None
    root: str | None = None


# ---------------------------------------------------------------------------
# Selectors, names and caps of the supported sites.
# ---------------------------------------------------------------------------

SITES = {
    "mk": Site(
        title=("h1.top_title", ".article_title", "h2.news_ttl", "h3.news_ttl"),
        content=("div.news_cnt_detail_wrap",),
        drop="script, style, iframe, .article_footer, .reporter_area",
        press_name="매일경제",
        date="dl.registration dd",
    ),
    "mk_popular": Site(
        title=("h2.news_ttl, h1.top_title",),
        content=("div.news_cnt_detail_wrap, div.article_body",),
        drop="script, style, iframe, .reporter_area, .link_news",
        press_name="매일경제",
        date="dl.registration dd",
    ),
    "naver": Site(
        title=("#title_area",),
        content=("#newsct_article",),
        drop="script, style, iframe, .media_end_head",
        press_name="네이버뉴스",
        press=".media_end_head_top a img",
        press_attribute="title",
        date=".media_end_head_info_datestamp_time, ._ARTICLE_DATE_TIME",
        date_attribute="data-date-time",
    ),
    "hankyung": Site(
        title=("h1.headline",),
        content=("div.article-body",),
        drop="script, style, iframe, .article-ad",
        press_name="한국경제",
        date="span.txt-date",
    ),
}

LINK_LISTS = {
    "mk": LinkList("li.news_node", 10, "a.news_item", "ad_wrap", "https://www.mk.co.kr"),
    "mk_popular": LinkList("h3.news_ttl", 10, "parent"),
    "naver": LinkList(".sa_text_title", 30),
    "hankyung": LinkList("ul.news-list > li", 20, "h3.news-tit a"),
}

PLAIN_SITE = Site(title=("h1", "title"), content=("article",), drop="script, style, iframe, .ad")


def _step(selector: str):
    """``tag.class`` or ``#id`` as (tag, classes, id)."""
    name, _, wanted_id = selector.partition("#")
    tag, *classes = name.split(".")
    return tag, frozenset(classes), wanted_id


def _paths(selectors: str | None):
    """Each selector of a comma list as its steps from the outside in."""
    return [[s if s == ">" else _step(s) for s in one.split()] for one in (selectors or "").split(",") if one.strip()]


class _Element:
    def __init__(self, tag, attributes):
        self.tag = tag
        self.attributes = {k: v or "" for k, v in attributes}
        self.classes = frozenset(self.attributes.get("class", "").split())

    def fits(self, step) -> bool:
        tag, classes, wanted_id = step
        return (
            (not tag or tag == self.tag)
            and classes <= self.classes
            and (not wanted_id or wanted_id == self.attributes.get("id"))
        )


def _fits_any(stack, paths) -> bool:
    return any(_fits(stack, path) for path in paths)


def _fits(stack, path) -> bool:
    """The last element fits the last step and outer elements the steps before it."""
    if not stack[-1].fits(path[-1]):
        return False
    steps = path[:-1]
    if not steps:
        return True
    if steps[-1] == ">":
        return len(stack) > 1 and _fits(stack[:-1], steps[:-1])
    return any(_fits(stack[:i], steps) for i in range(len(stack) - 1, 0, -1))


class _Walker(HTMLParser):
    """Keeps the stack of open elements; subclasses react to opening, closing and text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[_Element] = []

    def handle_starttag(self, tag, attrs):
        self.stack.append(_Element(tag, attrs))
        self.opened()
        if tag in VOID_TAGS:
            self.stack.pop()

    def handle_startendtag(self, tag, attrs):
        self.stack.append(_Element(tag, attrs))
        self.opened()
        self.close_last()

    def handle_endtag(self, tag):
        if any(e.tag == tag for e in self.stack):
            while self.stack[-1].tag != tag:
                self.close_last()
            self.close_last()

    def close_last(self):
        self.closed(self.stack.pop())

    def opened(self):
        pass

    def closed(self, element):
        pass


class _ArticleWalker(_Walker):
    """Text of the first match of every wanted comma list."""

    def __init__(self, wanted: dict[str, str], drop: str):
        super().__init__()
        self.wanted = {name: _paths(selectors) for name, selectors in wanted.items()}
        self.drop = _paths(drop)
        self.found: dict[str, tuple[_Element, list[str]]] = {}
        self.reading: dict[str, _Element] = {}
        self.dropped: _Element | None = None

    def opened(self):
        element = self.stack[-1]
        for name, paths in self.wanted.items():
            if name not in self.found and _fits_any(self.stack, paths):
                self.found[name] = (element, [])
                if element.tag not in VOID_TAGS:
                    self.reading[name] = element
        inside = any(name.startswith("content") and e is not element for name, e in self.reading.items())
        if self.dropped is None and inside and element.tag not in VOID_TAGS and _fits_any(self.stack, self.drop):
            self.dropped = element

    def closed(self, element):
        if element is self.dropped:
            self.dropped = None
        self.reading = {n: e for n, e in self.reading.items() if e is not element}

    def handle_data(self, data):
        for name in self.reading:
            if self.dropped is None or not name.startswith("content"):
                self.found[name][1].append(data)

    def text(self, name) -> str | None:
        return "".join(self.found[name][1]).strip() if name in self.found else None


def read_article(html: str, site: Site) -> dict[str, str | None]:
    """Title, content, press and date text of one page; what is missing is None."""
    wanted = {f"title{i}": s for i, s in enumerate(site.title)}
    wanted |= {f"content{i}": s for i, s in enumerate(site.content)}
    wanted |= {name: s for name, s in (("press", site.press), ("date", site.date)) if s}
    walker = _ArticleWalker(wanted, site.drop)
    walker.feed(html)
    walker.close()

    def first(kind: str) -> str | None:
        return next((walker.text(n) for n in wanted if n.startswith(kind) and n in walker.found), None)

    def value(name: str, attribute: str | None) -> str | None:
        if name not in walker.found:
            return None
        return walker.found[name][0].attributes.get(attribute) if attribute else walker.text(name)

    return {
        "title": first("title") or None,
        "content": first("content") or None,
        "press": value("press", site.press_attribute) or site.press_name,
        "date_text": value("date", site.date_attribute),
    }


class _LinkWalker(_Walker):
    def __init__(self, links: LinkList, cap: int | None):
        super().__init__()
        self.links = links
        self.items = _paths(links.items)
        self.inner = _paths(links.link) if links.link not in ("item", "parent") else []
        self.count, self.cap = 0, cap
        self.item: _Element | None = None
        self.hrefs: list[str] = []

    def opened(self):
        element = self.stack[-1]
        if self.item is not None:
            if _fits_any(self.stack, self.inner):
                self.hrefs.append(element.attributes.get("href", ""))
                self.item = None
            return
        if (self.cap is not None and self.count >= self.cap) or not _fits_any(self.stack, self.items):
            return
        if self.links.ad_class in element.classes:
            return
        self.count += 1
        if self.links.link == "item":
            self.hrefs.append(element.attributes.get("href", ""))
        elif self.links.link == "parent":
            around = [e for e in self.stack[:-1] if e.tag == "a"]
            self.hrefs += [e.attributes.get("href", "") for e in around[-1:]]
        else:
            self.item = element

    def closed(self, element):
        if element is self.item:
            self.item = None


def read_links(html: str, links: LinkList, cap: int | None = None) -> list[str]:
    walker = _LinkWalker(links, cap)
    walker.feed(html)
    walker.close()
    found = [h for h in walker.hrefs if h]
    if links.root:
        return [h if h.startswith("http") else links.root + h for h in found]
    return [h for h in found if h.startswith("http")]


def article_fields(html: Column, site: Site) -> Column:
    @F.pandas_udf("title string, content string, press string, date_text string")
    def read(pages: pd.Series) -> pd.DataFrame:
        rows = [read_article(page or "", site) for page in pages]
        return pd.DataFrame(rows, columns=["title", "content", "press", "date_text"])

    return read(html)


def link_column(html: Column, links: LinkList, cap: int | None = None) -> Column:
    @F.pandas_udf("array<string>")
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: read_links(page or "", links, cap))

    return read(html)


def extract_articles(pages: DataFrame, site: Site, as_of, keep: Iterable[str] = ("url",)) -> DataFrame:
    """Articles of one site's pages; pages without title or content are dropped, and a
    date that does not parse becomes ``as_of``."""
    read = compute_once(pages.select(*keep, "html"), "_fields", article_fields(F.col("html"), site))
    fields = read.select(*keep, "_fields.*").where(F.col("title").isNotNull() & F.col("content").isNotNull())
    return fields.withColumn("published_at", TM.parse_page_date(F.col("date_text"), as_of)).drop("date_text")


def extract_links(
    pages: DataFrame, links: LinkList, keep: Iterable[str] = ("url",), cap: int | None = None
) -> DataFrame:
    """Links of list pages with their position; ``cap`` takes the first items of a page only (the
    usual number of a known site is ``links.cap``)."""
    found = compute_once(pages.select(*keep, "html"), "_links", link_column(F.col("html"), links, cap))
    return found.select(*keep, F.posexplode("_links").alias("position", "link"))
