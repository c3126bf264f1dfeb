"""Text of HTML pages. Pages are often not well formed, so a forgiving parser runs in Arrow batches."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import bare_kept

# Elements and hints in a class or id that mark what is not the page's main text.
BOILERPLATE_TAGS = ["script", "style", "nav", "footer", "header", "aside", "form", "iframe", "noscript"]
BOILERPLATE_HINTS = [
    "nav", "footer", "sidebar", "advert", "ad-", "cookie", "subscribe", "newsletter",
    "social-share", "comment", "related-posts", "breadcrumb", "menu",
]
#: Elements without content, and those that a new one of their kind ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


class _Reader(HTMLParser):
    """Keeps the text nodes with the flags of the elements around them, and the links."""

    def __init__(self, drop_tags, hints):
        super().__init__(convert_charrefs=True)
        self.drop_tags, self.hints = drop_tags, hints
        self.stack: list[tuple[str, bool, str]] = []  # name, dropped, zone
        self.nodes: list[tuple[str, frozenset]] = []
        self.seen: set[str] = set()
        self.links: list[dict] = []
        self.open_links: list[tuple[int, dict]] = []

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        closes = CLOSED_BY_NEXT.get(tag)
        while closes and self.stack and self.stack[-1][0] in closes:
            self._pop()
        said = f"{values.get('class') or ''} {values.get('id') or ''}".lower()
        dropped = tag in self.drop_tags or any(h in said for h in self.hints)
        zone = tag if tag in ("article", "main", "body") else "role" if values.get("role") == "main" else ""
        if tag in VOID:
            return
        self.stack.append((tag, dropped, zone))
        if zone and not self.hidden():
            self.seen.add(zone)
        if tag == "a" and values.get("href") is not None and not self.hidden():
            link = {"href": values["href"], "text": ""}
            self.links.append(link)
            self.open_links.append((len(self.stack), link))

    def handle_startendtag(self, tag, attrs):
        pass

    def _pop(self):
        self.stack.pop()
        while self.open_links and self.open_links[-1][0] > len(self.stack):
            self.open_links.pop()

    def handle_endtag(self, tag):
        if any(x[0] == tag for x in self.stack):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def hidden(self):
        return any(x[1] for x in self.stack)

    def handle_data(self, data):
        if self.hidden():
            return
        self.nodes.append((data, frozenset(x[2] for x in self.stack if x[2])))
        for _, link in self.open_links:
            link["text"] += data


def _read(page: str, drop_tags, hints) -> _Reader:
    reader = _Reader(frozenset(drop_tags), tuple(hints))
    reader.feed(page)
    reader.close()
    return reader


def main_text(page: str) -> str:
    """Text of the article, else the element of role main, the main element, the body or all: a paragraph for each line."""
    reader = _read(page, BOILERPLATE_TAGS, BOILERPLATE_HINTS)
    zone = next((z for z in ("article", "role", "main", "body") if z in reader.seen), None)
    lines = "\n".join(t for t, zones in reader.nodes if zone is None or zone in zones).split("\n")
    return "\n\n".join(x for x in map(str.strip, lines) if x)


@F.pandas_udf(T.StringType())
def _main(s: pd.Series) -> pd.Series:
    return s.map(lambda x: "" if x is None else main_text(x))


@F.pandas_udf(T.StringType())
def _main_closed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: "" if x is None else main_text(bare_kept(x)))


@F.pandas_udf(T.StringType())
def _visible(s: pd.Series) -> pd.Series:
    return s.map(lambda x: "" if x is None else " ".join(t for t, _ in _read(x, ("script", "style"), ()).nodes))


_LINK = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))


@F.pandas_udf(_LINK)
def _links(s: pd.Series) -> pd.Series:
    return s.map(lambda x: [] if x is None else _read(x, (), ()).links)


def clean_html(c: Column, bare: bool = True) -> Column:
    """The main text of a page. bare: entities without a semicolon are characters too, as HTML has some."""
    return _main(c) if bare else _main_closed(c)


def visible_text(c: Column) -> Column:
    return _visible(c)


def links(c: Column) -> Column:
    """All links of a page: (href, text)."""
    return _links(c)


def find_link(c: Column, base: Column, word: str = "pricing") -> Column:
    """The first link with word in its address, or as its text: absolute as it is, rooted behind base; others are passed over."""
    hits = F.filter(links(c), lambda x: (F.contains(F.lower(x["href"]), F.lit(word)) | (F.lower(F.trim(x["text"])) == word))
                    & (F.startswith(x["href"], F.lit("http")) | F.startswith(x["href"], F.lit("/"))))
    href = F.get(hits, F.lit(0))["href"]
    return F.when(F.startswith(href, F.lit("/")), F.concat(F.regexp_replace(base, "/+$", ""), href)).otherwise(href)
