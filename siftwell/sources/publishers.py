"""Publishers: which sitemaps to read, and the rows they give.

A publisher is a name, an index URL and a rule for each level of sitemaps below
it; a new one is a line of data. Texts come from a ``fetch`` function, DataFrame
of URLs in, DataFrame of (url, text, ...) out, so that all runs offline on a
stored table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators.relational import date_range, month_overlaps, union_sources
from ..operators.rules import Rules
from .sitemaps import sitemap_index, url_set

Fetch = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Dated:
    """Sitemaps whose address states their month, or their day: groups year, month and perhaps day."""

    pattern: str

    def chosen(self, start: str, end: str) -> Column:
        dated = F.regexp_extract("loc", self.pattern, 0) != ""
        parts = [F.regexp_extract("loc", self.pattern, i + 1) for i in range(self.pattern.count(r"(\d"))]
        day = F.try_to_date(F.concat_ws("-", *parts, *[F.lit("01")] * (3 - len(parts))), "yyyy-MM-dd")
        return dated & (month_overlaps(day, start, end) if len(parts) == 2 else date_range(day, start, end))


@dataclass(frozen=True)
class Changed:
    """Sitemaps under some addresses that were changed around the days asked for."""

    prefixes: tuple[str, ...]
    before: int  #: days
    after: int

    def chosen(self, start: str, end: str) -> Column:
        under = F.exists(F.array(*map(F.lit, self.prefixes)), lambda p: F.startswith("loc", p))
        return under & F.to_date("lastmod").between(F.date_sub(F.lit(start).cast("date"), self.before), F.date_add(F.lit(end).cast("date"), self.after))


@dataclass(frozen=True)
class Publisher:
    name: str
    index_url: str
    levels: tuple[Dated | Changed, ...]  #: of the index, then of the indexes that it leads to

    def select(self, index: DataFrame, start: str, end: str, fetch: Fetch) -> DataFrame:
        """The URLs (column ``url``) of the sitemaps to read for the days from start to end."""
        for rule in self.levels[:-1]:
            index = self._index(index.where(rule.chosen(start, end)).select(F.col("loc").alias("url")), fetch)
        return index.where(self.levels[-1].chosen(start, end)).select(F.col("loc").alias("url"))

    @staticmethod
    def _index(urls: DataFrame, fetch: Fetch) -> DataFrame:
        return sitemap_index(fetch(urls).select("text")).where("error is null")

    def candidates(self, spark: SparkSession, fetch: Fetch, start: str, end: str, rules: Rules) -> DataFrame:
        """source, url, published_at, title, section of the entries in range that pass the gross filter."""
        index = self._index(spark.createDataFrame([(self.index_url,)], "url string"), fetch)
        entries = url_set(fetch(self.select(index, start, end, fetch)).select("text"))
        entries = entries.where("error is null and published_at is not null").where(date_range(F.col("published_at"), start, end))
        rows = entries.select(F.lit(self.name).alias("source"), F.col("loc").alias("url"), "published_at", "title", t.section(F.col("loc")).alias("section"))
        return rows.where(rules.gross_match(F.col("source"), F.col("url")))


# fixed values: names, addresses, patterns and margins
PUBLISHERS = (
    Publisher(
        "InfoMoney", "https://www.infomoney.com.br/sitemap_index.xml",
        (Changed(tuple(f"https://www.infomoney.com.br/{x}-sitemap" for x in ("post", "fundos", "colunistas")), 45, 3),),
    ),
    Publisher("Valor Econômico", "https://valor.globo.com/sitemap/valor/sitemap.xml", (Dated(r"/sitemap/valor/(\d{4})/(\d{2})/(\d{2})_\d+\.xml$"),)),
    Publisher(
        "Exame", "https://exame.com/artigos/sitemap.xml",
        (Dated(r"/artigos/(\d{4})-(\d{2})/sitemap\.xml$"), Dated(r"/artigos/(\d{4})-(\d{2})/(\d{2})/sitemap\.xml$")),
    ),
)


def publishers() -> list[Publisher]:
    return list(PUBLISHERS)


def all_candidates(
    spark: SparkSession, fetch: Fetch, start: str, end: str, rules: Rules, of: list[Publisher] | None = None, counted: dict[str, Observation] | None = None
) -> DataFrame:
    """The candidates of all publishers. ``counted`` gets an observation for each: n, first_at and last_at of its rows, as they are listed."""
    parts = []
    for p in of or publishers():
        rows = p.candidates(spark, fetch, start, end, rules)
        if counted is not None:
            counted[p.name] = Observation()
            rows = rows.observe(counted[p.name], F.count(F.lit(1)).alias("n"), F.min("published_at").alias("first_at"), F.max("published_at").alias("last_at"))
        parts.append(rows)
    return union_sources(parts)
