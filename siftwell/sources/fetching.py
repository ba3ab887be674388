"""Reading pages: from a stored table, or politely over HTTP.

``stored`` joins wanted URLs with a bronze table. ``HttpFetcher`` reads what is
missing there: URLs are dealt by origin, so one task owns an origin and keeps its
pace without locks across executors. robots.txt is obeyed on every redirect, and
read again for pages that are stored; those are judged by their URLs alone.
Failures become a status, not an exception; passing ones, broken connections and
timeouts among them, are tried again first.
"""

from __future__ import annotations

import hashlib
import http.client
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from . import robots

SCHEMA = "url_key string, url string, final_url string, text string, status string"
_TROUBLE = (OSError, ValueError, http.client.HTTPException)


class Stored:
    """A fetch function over a table with url and text (and final_url, if it has it)."""

    def __init__(self, bronze: DataFrame):
        final = F.coalesce(F.col("final_url"), F.col("url")) if "final_url" in bronze.columns else F.col("url")
        self.pages = bronze.select(t.url_key(F.col("url")).alias("url_key"), final.alias("final_url"), "text")

    def __call__(self, urls: DataFrame) -> DataFrame:
        return self.onto(urls.select("url").where("url is not null").distinct()).select("url_key", "url", "final_url", "text", "status")

    def onto(self, rows: DataFrame) -> DataFrame:
        """``rows``, each with a url, and beside them what was read: one join, nothing is asked twice."""
        return rows.withColumn("url_key", t.url_key(F.col("url"))).join(self.pages, "url_key").withColumn("status", F.lit("ok"))


def stored(bronze: DataFrame) -> Stored:
    return Stored(bronze)


def missing(urls: DataFrame, bronze: DataFrame) -> DataFrame:
    """Wanted URLs that the bronze table lacks."""
    have = bronze.select(t.url_key(F.col("url")).alias("url_key"))
    return urls.select("url").distinct().withColumn("url_key", t.url_key(F.col("url"))).join(have, "url_key", "left_anti").select("url")


def stated_pause(rules: RobotFileParser, agent: str) -> float | None:
    """Seconds between requests that robots.txt asks for: a crawl delay before a request rate, this agent's before all agents'."""
    delays = [rules.crawl_delay(x) for x in (agent, "*")]
    rates = [rules.request_rate(x) for x in (agent, "*")]
    asked = [float(d) for d in delays if d is not None] + [r.seconds / r.requests for r in rates if r and r.requests and r.seconds]
    return asked[0] if asked else None


class Blocked(Exception):
    """robots.txt forbids the URL."""


class _NoRedirect(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


@dataclass
class HttpFetcher:
    """A fetch function over HTTP. One task reads an origin's pages, a few at a time, each in its turn.

    An origin that states a pace in robots.txt gets one request at a time.
    """

    agent: str = "siftwell/0.1"
    delay: float = 0.2
    tries: int = 5
    backoff: float = 0.5
    redirects: int = 10
    timeout: float = 90.0
    robots_timeout: float = 30.0
    at_once: int = 4  #: requests that an origin answers at a time
    workers: int | None = None  #: tasks that fetch; None: as many as the session shuffles to

    def _by_origin(self, df: DataFrame, url: str) -> DataFrame:
        # some origins are much larger than others: each is a unit, as its pace is
        origin = t.url_origin(F.col(url))
        return df.repartition(self.workers, origin) if self.workers else df.repartition(origin)

    def __call__(self, urls: DataFrame) -> DataFrame:
        wanted = urls.select("url").where("url is not null").distinct()
        return self._by_origin(wanted, "url").mapInPandas(self._read_all, SCHEMA)

    def _read_all(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session = _Session(self)
        with ThreadPoolExecutor(self.at_once) as pool:
            for batch in batches:
                yield pd.DataFrame(list(pool.map(session.row, batch["url"])), columns=[c.split()[0] for c in SCHEMA.split(", ")])

    def policies(self, origins: DataFrame) -> DataFrame:
        """(origin, status, text) of the robots.txt of each origin; none there is a null text."""

        def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            session = _Session(self)
            with ThreadPoolExecutor(16) as pool:  # one request an origin
                for batch in batches:
                    yield pd.DataFrame(list(pool.map(session.policy, batch["origin"])), columns=["origin", "status", "text"])

        wanted = origins.select("origin").where("origin is not null").distinct()
        wanted = wanted.repartition(self.workers, "origin") if self.workers else wanted.repartition("origin")
        return wanted.mapInPandas(load, "origin string, status string, text string")

    def permitted(self, pages: DataFrame) -> DataFrame:
        """Stored pages (SCHEMA), with the status of those whose final URL robots.txt forbids by now.

        Keys and final URLs are judged; the verdicts go back by key, as pages are dealt already.
        """
        asked = pages.select("url_key", "final_url", t.url_origin(F.col("final_url")).alias("origin"))
        texts = self.policies(asked.select("origin")).persist()  # read twice: an origin is asked once
        judged = robots.permissions(asked, robots.rules(texts.where("text is not null")), self.agent, "final_url").join(texts.select("origin", "status"), "origin", "left")
        status = F.when(F.coalesce("status", F.lit("ok")) != "ok", F.col("status")).when(~F.col("allowed"), "blocked").otherwise("ok")
        # a key's verdicts by final URL: pages that are dealt by key stay where they are
        verdicts = judged.groupBy("url_key").agg(F.collect_set(F.struct("final_url", status.alias("status"))).alias("verdicts"))
        mine = F.get(F.filter("verdicts", lambda v: v["final_url"].eqNullSafe(F.col("final_url"))), 0)["status"]
        out = pages.drop("status").join(verdicts, "url_key").withColumn("status", mine)
        return out.select("url_key", "url", "final_url", F.when(F.col("status") == "ok", F.col("text")).alias("text"), "status")


class _Origin:
    """An origin's rules, and when its next request may start."""

    def __init__(self, settings: HttpFetcher):
        self.rules: RobotFileParser | None = None  # none: all is allowed
        self.known, self.trouble = False, None  # why robots.txt can't be read
        self.pause, self.slots = settings.delay, threading.Semaphore(settings.at_once)
        self.turn, self.loading = threading.Lock(), threading.RLock()
        self.free_at = 0.0

    def wait(self) -> None:
        with self.turn:
            start = max(self.free_at, time.monotonic())
            self.free_at = start + self.pause
        time.sleep(max(0.0, start - time.monotonic()))


class _Session:
    def __init__(self, settings: HttpFetcher):
        self.settings = settings
        self.opener = urllib.request.build_opener(_NoRedirect)
        self.origins: dict[str, _Origin] = {}
        self.lock = threading.Lock()

    def origin(self, url: str) -> _Origin:
        with self.lock:
            return self.origins.setdefault("{0.scheme}://{0.netloc}".format(urlsplit(url)), _Origin(self.settings))

    def row(self, url: str) -> tuple:
        key = hashlib.sha1(url.encode()).hexdigest()
        try:
            text, final = self.read(url)
            return key, url, final, text, "ok"
        except Blocked:
            return key, url, None, None, "blocked"
        except _TROUBLE as e:
            return key, url, None, None, f"failed: {e}"

    def policy(self, origin: str) -> tuple:
        """(origin, status, text) of its robots.txt."""
        try:
            return origin, "ok", self.robots_text(f"{origin}/robots.txt")
        except _TROUBLE as e:
            return origin, f"failed: {e}", None

    def read(self, url: str) -> tuple[str, str]:
        """Text and final URL; every hop needs leave from its own robots.txt."""
        status, headers, body, final = self.follow(url, self.settings.timeout, self.permit)
        if status >= 400:
            raise OSError(f"HTTP {status}")
        return body.decode(headers.get_content_charset() or "utf-8", "replace"), final

    def follow(self, url: str, timeout: float, before: Callable[[str], None]):
        """The answer at the end of a chain of redirects; ``before`` is called with each URL."""
        for _ in range(self.settings.redirects + 1):
            before(url)
            status, headers, body = self.request(url, timeout)
            if status not in (301, 302, 303, 307, 308) or not headers.get("Location"):
                return status, headers, body, url
            url = urljoin(url, headers["Location"])
        raise OSError("too many redirects")

    def permit(self, url: str) -> None:
        origin = self.origin(url)
        with origin.loading:
            if not origin.known:
                origin.known = True  # an origin that is down is asked once
                try:
                    self.load(origin, "{0.scheme}://{0.netloc}/robots.txt".format(urlsplit(url)))
                except _TROUBLE as e:
                    origin.trouble = OSError(f"robots.txt: {e}")
        if origin.trouble is not None:
            raise origin.trouble
        if origin.rules is not None and not origin.rules.can_fetch(self.settings.agent, url):
            raise Blocked(url)

    def robots_text(self, url: str) -> str | None:
        """robots.txt, wherever it moved to; None where there is none, which allows everything."""
        status, _, body, _ = self.follow(url, self.settings.robots_timeout, lambda _: None)
        if status >= 400 and status != 404:
            raise OSError(f"HTTP {status}")
        return None if status == 404 else body.decode("utf-8", "replace")

    def load(self, origin: _Origin, url: str) -> None:
        """An origin's rules and pace; a robots.txt that can't be read allows nothing."""
        text = self.robots_text(url)
        if text is not None:
            origin.rules = RobotFileParser()
            origin.rules.parse(text.splitlines())
            pause = stated_pause(origin.rules, self.settings.agent)
            if pause is not None:
                origin.pause, origin.slots = max(self.settings.delay, pause), threading.Semaphore(1)

    def request(self, url: str, timeout: float):
        """One request in its origin's turn; passing troubles, of the server or on the way, are tried again."""
        origin = self.origin(url)
        last = self.settings.tries - 1
        for attempt in range(self.settings.tries):
            with origin.slots:
                origin.wait()
                try:
                    with self.opener.open(urllib.request.Request(url, headers={"User-Agent": self.settings.agent}), timeout=timeout) as r:
                        return r.status, r.headers, r.read()
                except urllib.error.HTTPError as e:
                    if e.code not in (429, 500, 502, 503, 504) or attempt == last:
                        return e.code, e.headers, e.read()
                except (OSError, http.client.HTTPException):
                    if attempt == last:
                        raise
            time.sleep(self.settings.backoff * 2**attempt)
        raise OSError("unreachable")


def store(bronze_path: str, fetched: DataFrame) -> None:
    """Append what was read to the bronze table, one row for each URL."""
    fetched.where("status = 'ok'").dropDuplicates(["url_key"]).drop("status").write.mode("append").parquet(bronze_path)


def cached(spark, bronze_path: str, live: HttpFetcher, slice_urls: int = 10_000):
    """A fetch function that reads the bronze table, and over HTTP only what it lacks, which it then keeps.

    What is lacking is fetched and stored in slices of about ``slice_urls``, so
    that a run which ends early has lost one slice at most. Stored pages are
    returned if robots.txt still allows them.
    """
    from .jsonl import exists

    def fetch(urls: DataFrame) -> DataFrame:
        wanted = urls.where("url is not null").select("url").distinct()
        if exists(spark, bronze_path):
            wanted = missing(wanted, spark.read.parquet(bronze_path))
        wanted = wanted.persist()
        try:
            parts = max(1, -(-wanted.count() // slice_urls))
            for i in range(parts):
                store(bronze_path, live(wanted.where(F.pmod(F.xxhash64("url"), F.lit(parts)) == i)))
        finally:
            wanted.unpersist()
        pages = stored(spark.read.parquet(bronze_path))(urls)
        return live.permitted(pages) if hasattr(live, "permitted") else pages

    return fetch
