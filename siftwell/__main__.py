"""``python -m siftwell``: the whole run over HTTP, pages kept in a bronze table."""

from __future__ import annotations

import argparse
import logging
import time

from pyspark.sql import SparkSession

from .plans import pipeline
from .plans.config import RunConfig
from .sources.fetching import HttpFetcher, cached


def arguments(argv: list[str] | None = None) -> tuple[RunConfig, str]:
    d = RunConfig()
    p = argparse.ArgumentParser(prog="siftwell", description=__doc__)
    p.add_argument("--start-date", default=d.start_date, help="first day, YYYY-MM-DD")
    p.add_argument("--end-date", default=d.end_date, help="last day, YYYY-MM-DD")
    p.add_argument("--output", default=d.output, help="folder of JSON Lines part files")
    p.add_argument("--cache-dir", default="data/bronze", help="Parquet table of fetched pages")
    p.add_argument("--workers", type=int, default=d.workers, help="tasks that fetch at the same time")
    p.add_argument("--metrics", default=None, help="folder for counters by source and week")
    p.add_argument("--resume", action="store_true", help="append, leaving out URLs that are in the output")
    p.add_argument("--seen", default=None, help="bucketed table of the URLs written, asked when resuming instead of reading the output")
    p.add_argument("--weeks-per-commit", type=int, default=d.weeks_per_commit, help="weeks that are written at a time")
    a = p.parse_args(argv)
    return RunConfig(a.start_date, a.end_date, a.output, a.resume, metrics=a.metrics, seen=a.seen, weeks_per_commit=a.weeks_per_commit, workers=a.workers), a.cache_dir


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    config, bronze = arguments()
    spark = SparkSession.builder.appName("siftwell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    began = time.time()
    n = pipeline.run(spark, cached(spark, bronze, HttpFetcher(config.user_agent, config.request_delay, workers=config.workers)), config)
    logging.info("%d records in %.0f s", n, time.time() - began)


if __name__ == "__main__":
    main()
