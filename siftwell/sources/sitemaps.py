"""XML sitemaps as DataFrames, read in the JVM.

A table of fetched XML texts becomes rows by namespace URI, whatever the prefix:
prefixes that a root binds to the two namespaces are written in one way, then
Spark's own reader pulls the entries. A text that isn't well-formed gives one
row with ``error`` set and no others, so one broken sitemap doesn't end a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_datetime
from ..functions.text import bound

# fixed values: the namespaces of sitemaps and of their news extension
_SITEMAP = "http://www.sitemaps.org/schemas/sitemap/0.9"
_NEWS = "http://www.google.com/schemas/sitemap-news/0.9"

#: The text of the root's start tag, after declarations and comments.
_ROOT = r"^(?:\s|\ufeff|<\?(?s:.*?)\?>|<!--(?s:.*?)-->|<!DOCTYPE[^>]*>)*(<[^!?][^>]*>)"
_LIST = "array<string>"
_NEWS_FIELDS = f"array<struct<`n:publication_date`: {_LIST}, `n:title`: {_LIST}>>"
_SCHEMA = f"`s:{{}}` array<struct<`s:loc`: {_LIST}, `s:lastmod`: {_LIST}, `n:news`: {_NEWS_FIELDS}>>, _broken string"


def _prefix(root: Column, uri: str) -> Column:
    """The prefix that a root's start tag binds to a namespace, '' for the default one, null if none."""
    quoted = uri.replace(".", r"\.")
    bindings = F.regexp_extract_all(root, F.lit(rf"\sxmlns(?::([^\s=]+))?\s*=\s*[\"']{quoted}[\"']"), F.lit(1))
    return F.get(bindings, 0)


def _escaped(xml: Column) -> Column:
    """CDATA sections as escaped text; one that doesn't end stays."""
    begin, end = "<![CDATA[", "]]>"

    def piece(p: Column, i: Column) -> Column:
        held = F.substring_index(p, end, 1)
        plain = F.replace(F.replace(F.replace(held, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        whole = F.concat(plain, F.substring(p, F.length(held) + len(end) + 1, F.length(p)))
        return F.when(i == 0, p).when(F.contains(p, F.lit(end)), whole).otherwise(F.concat(F.lit(begin), p))

    return F.when(F.contains(xml, F.lit(begin)), F.array_join(F.transform(F.split(xml, r"<!\[CDATA\["), piece), "")).otherwise(xml)


def _spelled(xml: Column) -> Column:
    """The text with the two namespaces under the prefixes s and n, and other names under none of them."""

    def one_way(x: Column) -> Column:
        site, news = x["site"], x["news"]
        # names with a prefix of their own first: what is s: or n: by chance becomes other
        text = F.regexp_replace(x["xml"], r"(</?)([sn]):", "$1other$2:")
        again = lambda p: F.when(p.isin("s", "n"), F.concat(F.lit("other"), p)).otherwise(p)
        plain = lambda p: F.concat(F.lit(r"(</?)\Q"), again(p), F.lit(r"\E:"))
        text = F.when(F.coalesce(news, F.lit("")) != "", F.regexp_replace(text, plain(news), F.lit("$1n:"))).otherwise(text)
        text = F.when(F.coalesce(site, F.lit("")) != "", F.regexp_replace(text, plain(site), F.lit("$1s:"))).otherwise(text)
        bare = F.when(site == "", "$1s:").when(news == "", "$1n:").otherwise("$1other:")
        return F.regexp_replace(text, F.lit(r"(</?)(?=[^\s/>:!?]+[\s/>])"), bare)

    def named(x: Column) -> Column:
        root = F.regexp_extract(x, _ROOT, 1)
        return bound(F.struct(x.alias("xml"), _prefix(root, _SITEMAP).alias("site"), _prefix(root, _NEWS).alias("news")), one_way)

    return bound(_escaped(xml), named)


def _first(values: Column) -> Column:
    """The first of an element's texts, without white space around; '' if there is none."""
    return F.coalesce(F.regexp_replace(F.get(values, 0), r"^[\s\x1c-\x1f\x85\xa0]+|[\s\x1c-\x1f\x85\xa0]+$", ""), F.lit(""))


def _rows(df: DataFrame, xml: str, entry: str, fields: dict) -> DataFrame:
    """A row for each ``entry`` under the root: the stripped text of each field, '' if absent."""
    names = [c for c in df.columns if c != xml]
    text = F.coalesce(F.col(xml), F.lit(""))
    # parsed once: what is read is bound, and so is what follows from it
    read = F.from_xml(_spelled(text), _SCHEMA.format(entry), {"columnNameOfCorruptRecord": "_broken", "ignoreSurroundingSpaces": "false"})
    ends = text.rlike(r">\s*(?:<!--(?s:.*?)-->\s*)*\z")  # no text after the root
    broken = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in fields], F.lit("not well-formed").alias("error")))
    one = lambda e: F.struct(*[f(e).alias(c) for c, f in fields.items()], F.lit(None).cast("string").alias("error"))
    entries = bound(F.struct(read.alias("r"), ends.alias("ends")), lambda x: F.when(~x["ends"] | x["r"]["_broken"].isNotNull(), broken).otherwise(F.transform(x["r"][f"s:{entry}"], one)))
    return df.select(*names, F.explode(entries).alias("__entry")).select(*names, "__entry.*")


def _filled(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))


def sitemap_index(df: DataFrame, xml: str = "text") -> DataFrame:
    """loc, lastmod (null if absent or unreadable), error; blank locs are dropped."""
    rows = _rows(df, xml, "sitemap", {"loc": lambda e: _first(e["s:loc"]), "lastmod": lambda e: _first(e["s:lastmod"])})
    return rows.where("loc <> '' or error is not null").withColumn("lastmod", parse_datetime(_filled("lastmod")))


def url_set(df: DataFrame, xml: str = "text") -> DataFrame:
    """loc, published_at, title, error. The publication date counts if it is there, even unreadable; else lastmod."""
    news = lambda e, name: _first(F.get(e["n:news"], 0)[f"n:{name}"])
    fields = {"loc": lambda e: _first(e["s:loc"]), "stated": lambda e: news(e, "publication_date"), "changed": lambda e: _first(e["s:lastmod"]), "title": lambda e: news(e, "title")}
    rows = _rows(df, xml, "url", fields).where("loc <> '' or error is not null")
    moment = parse_datetime(F.coalesce(_filled("stated"), _filled("changed")))
    return rows.withColumns({"published_at": moment, "title": _filled("title")}).drop("stated", "changed")
