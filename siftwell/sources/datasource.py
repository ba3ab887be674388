"""``spark.read.format("siftwell_pages")``: pages over HTTP as a data source.

Options: ``urls``, a list with one URL a line, and the settings of
``HttpFetcher`` (``agent``, ``delay``, ``tries``, ``backoff``, ``redirects``,
``timeout``, ``robots_timeout``, ``at_once``). Each origin is a partition, which
keeps the origin's pace and obeys its robots.txt. The list comes with the
query, so it is one that a driver holds; URLs in a table go through
``HttpFetcher`` itself.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .fetching import SCHEMA, HttpFetcher, _Session

NAME = "siftwell_pages"
MOST_URLS = 100_000


class _Pages(InputPartition):
    def __init__(self, urls: list[str]):
        super().__init__(urls[0])
        self.urls = urls


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        kinds = {f.name.lower(): (f.name, type(f.default)) for f in fields(HttpFetcher) if f.default is not None}
        unknown = set(options) - {"urls"} - set(kinds)
        if unknown:
            raise ValueError(f"no such option: {', '.join(sorted(unknown))}")
        self.settings = HttpFetcher(**{kinds[k][0]: kinds[k][1](v) for k, v in options.items() if k in kinds})
        self.urls = list(dict.fromkeys(filter(None, map(str.strip, options.get("urls", "").split("\n")))))
        if len(self.urls) > MOST_URLS:
            raise ValueError(f"more than {MOST_URLS} URLs; read them from a table with HttpFetcher")

    def partitions(self) -> list[InputPartition]:
        by_origin = defaultdict(list)
        for url in self.urls:
            by_origin[urlsplit(url)[:2]].append(url)
        return [_Pages(urls) for urls in by_origin.values()]

    def read(self, partition: _Pages) -> Iterator[tuple]:
        if partition is None:  # an empty list has no partitions, and one is asked for
            return
        session = _Session(self.settings)
        with ThreadPoolExecutor(self.settings.at_once) as pool:
            yield from pool.map(session.row, partition.urls)


class PageSource(DataSource):
    """Columns url_key, url, final_url, text and status; a failure is a status."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
