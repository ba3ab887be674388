"""Metadata of an article's HTML, in one Arrow UDF over a lenient parser."""

from __future__ import annotations

import re
from datetime import datetime
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import parse_value
from .text import clean_space_value, normalize_value

# fixed values: where a page states things, best first
_TITLE = (("property", "og:title"), ("name", "twitter:title"), ("name", "title"))
_SUMMARY = (("name", "description"), ("property", "og:description"), ("name", "twitter:description"), ("name", "summary"))
_SUMMARY_CLASSES = ("subtitle", "subheadline", "article-subtitle")
_MOMENT = (("property", "article:published_time"), ("name", "article:published_time"), ("name", "pubdate"), ("itemprop", "datePublished"), ("property", "og:updated_time"))
_TAGS = (("name", "news_keywords"), ("name", "keywords"), ("property", "article:tag"))
_SHORTEST_SUMMARY = 20
_LINKED_DATE = re.compile(r'"datePublished"\s*:\s*"([^"]+)"')
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


class _Reader(HTMLParser):
    """Collects metas, and the texts of the elements that may hold metadata."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.metas: list[dict[str, str]] = []
        self.times: list[str] = []
        self.linked: list[str] = []
        self.texts: dict[str, list[str]] = {}  # first element of each kind
        self.anchors: list[list[str]] = []
        self.title: list[str] | None = None
        self.open: list[tuple[str, list[list[str]]]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        have = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.metas.append(have)
        if tag == "time" and have.get("datetime"):
            self.times.append(have["datetime"])
        into: list[list[str]] = []
        kinds = [tag] if tag in ("h1", "h2") else []
        kinds += [f".{c}" for c in have.get("class", "").split() if c in _SUMMARY_CLASSES]
        for kind in kinds:
            if kind not in self.texts:
                into.append(self.texts.setdefault(kind, []))
        if tag == "title" and self.title is None:
            self.title = []
            into.append(self.title)
        if tag == "a" and (" ".join(have.get("rel", "").split()) == "tag" or "/tag/" in have.get("href", "")):
            self.anchors.append([])
            into.append(self.anchors[-1])
        if tag == "script" and have.get("type") == "application/ld+json":
            self.linked.append("")
            self.open.append(("script+", []))
        elif tag not in _VOID:
            self.open.append((tag, into))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0].rstrip("+") == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "script+":
            self.linked[-1] += data
            return
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, into in self.open:
            for texts in into:
                texts.append(data)

    def meta(self, key: str, value: str) -> str | None:
        """content of the first such meta."""
        return next((m.get("content", "") for m in self.metas if m.get(key) == value), None)


def _joined(parts: list[str]) -> str:
    return clean_space_value(" ".join(p for p in (x.strip() for x in parts) if p))


def title_of(page: _Reader) -> str | None:
    for where in _TITLE:
        if found := clean_space_value(page.meta(*where) or ""):
            return found
    if page.title and "".join(page.title):
        return clean_space_value("".join(page.title))  # may be '': then the heading is not asked
    return _joined(page.texts["h1"]) if "h1" in page.texts else None


def description_of(page: _Reader) -> str | None:
    stated = [clean_space_value(page.meta(*where) or "") for where in _SUMMARY]
    shown = [_joined(page.texts.get(kind, [])) for kind in ("h2", *(f".{c}" for c in _SUMMARY_CLASSES))]
    return next((x for x in stated + shown if len(x) >= _SHORTEST_SUMMARY), None)


def moment_of(page: _Reader) -> datetime | None:
    stated = [page.meta(*where) or "" for where in _MOMENT]
    linked = [d for script in page.linked for d in _LINKED_DATE.findall(script)]
    return next((t for t in map(parse_value, stated + page.times + linked) if t), None)


def tags_of(page: _Reader) -> list[str]:
    values = [v for key, value in _TAGS for m in page.metas if m.get(key) == value for v in re.split("[;,|]", m.get("content", ""))]
    out: dict[str, str] = {}
    for v in values + [_joined(a) for a in page.anchors]:
        if k := normalize_value(v):
            out.setdefault(k, clean_space_value(v))
    return list(out.values())


def read_page(html: str | None) -> tuple:
    page = _Reader()
    page.feed(html or "")
    page.close()
    return title_of(page), description_of(page), moment_of(page), tags_of(page)


def page_metadata(html: Column) -> Column:
    """struct(title, description, published_at, tags) of a page.

    Marked as not deterministic, so that filters on its fields don't make Spark
    parse each page again.
    """

    def read(pages: pd.Series) -> pd.DataFrame:
        rows = [read_page(x) for x in pages]
        out = pd.DataFrame(rows, columns=[f.name for f in SCHEMA.fields])
        out["published_at"] = pd.Series([r[2] for r in rows], dtype="datetime64[us, UTC]")
        return out

    return F.pandas_udf(read, SCHEMA).asNondeterministic()(html)
