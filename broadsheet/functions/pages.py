"""Fields of a web page as Column expressions (regular markup, no Python)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import let, strip_space

# Blocks that are not article text, and link caps per kind of list page.
DROPPED_TAGS = ("script", "style", "iframe")

# Named references are read with or without the closing semicolon, as browsers do.
ENTITIES = (
    ("&nbsp;?", "\u00a0"),
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;", "'"),
    ("&amp;?", "&"),
)


def inner_html(html: Column, tag: str) -> Column:
    """Markup inside the first ``tag`` element, elements of the same tag in it included; empty
    when there is none or it is not closed. Splitting at the tags is much faster than a lazy match.

    The first closing tag ends the element where as many were closed as opened; only a page
    that nests the tag in itself has its tags counted.
    """
    opened = F.split(html, rf"(?i)<{tag}\b[^>]*>", 2)
    rest = F.get(opened, F.lit(1))
    either = rf"(?i)<(?:{tag}\b[^>]*|/{tag})>"

    def by_depth(text: Column) -> Column:
        tags = F.regexp_extract_all(text, F.lit(either), F.lit(0))
        steps = F.transform(tags, lambda t: F.when(t.startswith("</"), -1).otherwise(1))
        state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen"), F.lit(-1).alias("end"))
        end = F.aggregate(
            steps,
            state,
            lambda s, x: F.struct(
                (s["depth"] + x).alias("depth"),
                (s["seen"] + 1).alias("seen"),
                F.when((s["end"] < 0) & (s["depth"] + x == 0), s["seen"]).otherwise(s["end"]).alias("end"),
            ),
            lambda s: s["end"],
        )
        gaps = F.split(text, either)
        inside = F.zip_with(
            F.slice(gaps, 1, end + 1), F.slice(tags, 1, end), lambda gap, t: F.concat(gap, F.coalesce(t, F.lit("")))
        )
        return F.when(end >= 0, F.array_join(inside, "")).otherwise("")

    def first_close(parts: Column) -> Column:
        plain = F.get(parts, F.lit(0))
        nested = plain.rlike(rf"(?i)<{tag}\b[^>]*>")
        return F.when(F.size(parts) < 2, "").when(nested, by_depth(rest)).otherwise(plain)

    return let(F.split(rest, rf"(?i)</{tag}>", 2), lambda parts: F.coalesce(first_close(parts), F.lit("")))


def text_of(html: Column, ad_class: str | None = None) -> Column:
    """Text nodes joined as they stand, entities decoded, stripped at both ends.

    With ``ad_class`` script, style, frame and ad blocks go with their content. Blocks,
    comments and tags are cut in one scan of the markup.
    """
    cuts = r"!--.*?--|[^>]+"
    if ad_class is not None:
        blocks = rf"({'|'.join(DROPPED_TAGS)})\b[^>]*>.*?</\1"
        cuts = rf'{blocks}|div class="{ad_class}"[^>]*>.*?</div|{cuts}'

    def decode(text: Column) -> Column:
        decoded = text
        for entity, char in ENTITIES:
            decoded = F.regexp_replace(decoded, entity, char)
        return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)

    return strip_space(let(F.array_join(F.split(html, f"(?is)<(?:{cuts})>"), ""), decode))


def not_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def page_title(html: Column, tags: Iterable[str] = ("h1", "title")) -> Column:
    """First non-blank title by tag priority."""
    return F.coalesce(*[let(inner_html(html, t), lambda inner: not_blank(text_of(inner))) for t in tags])


def page_content(html: Column, tag: str = "article", ad_class: str = "ad") -> Column:
    return not_blank(let(inner_html(html, tag), lambda inner: text_of(inner, ad_class)))


def page_press(html: Column, default: Column) -> Column:
    """Title of the first titled image, else the default."""
    return F.coalesce(not_blank(F.regexp_extract(html, r'(?i)<img\b[^>]*\btitle="([^"]*)"', 1)), default)


def page_links(html: Column, url: Column, cap: int | None = None, ad_class: str = "ad_wrap") -> Column:
    """Absolute links in page order.

    Anchors of the ad class are left out, then the first ``cap`` anchors are taken, then
    ``/path`` links get the page's own root and what is still not http(s) is dropped.
    """
    anchors = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?i)<a\b[^>]*>"), F.lit(0)),
        lambda a: ~a.rlike(rf"""(?i)\bclass\s*=\s*["'][^"']*\b{ad_class}\b"""),
    )
    if cap is not None:
        anchors = F.slice(anchors, 1, cap)
    root = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)
    hrefs = F.transform(anchors, lambda a: F.regexp_extract(a, r"""(?i)\bhref\s*=\s*(["'])(.*?)\1""", 2))
    absolute = F.transform(hrefs, lambda h: F.when(h.startswith("/"), F.concat(root, h)).otherwise(h))
    return F.filter(absolute, lambda h: h.startswith("http"))
