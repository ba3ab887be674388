"""Candidates as a stream: each micro-batch enriches and appends what is new.

A file source and a checkpoint replace the resume flag: files that were read are
not read again, URLs that are in the output are left out, and of a batch's rows
with one URL the newest counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.rules import Rules
from ..plans import pipeline
from ..plans.config import RunConfig
from ..sources import jsonl
from ..sources.seen import SeenUrls

CANDIDATES = "source string, url string, published_at timestamp, title string, section string"


def incremental(spark: SparkSession, inbox: str, checkpoint: str, fetch: Callable[[DataFrame], DataFrame], config: RunConfig, rules: Rules | None = None) -> StreamingQuery:
    """A query that handles all files now in ``inbox`` (Parquet of CANDIDATES), then ends."""
    rules = rules or Rules()

    table = SeenUrls(spark, config.seen) if config.seen else None

    def handle(batch: DataFrame, number: int) -> None:
        newest = pipeline.newest(batch, rules)
        if table:  # reads the buckets of the batch's URLs, not all that was written
            fresh = pipeline.judge_candidates(table.unseen(newest), rules).where("reject_reason is null")
        else:
            fresh = pipeline.select_candidates(newest, jsonl.seen_urls(spark, config.output), rules)
        out = pipeline.records(pipeline.enrich(fresh.drop("reject_reason"), fetch, config, rules))
        if table is None:
            jsonl.write_records(out, config.output, append=True)
            return
        out = out.persist()
        try:
            jsonl.write_records(out, config.output, append=True)
            table.add(out)
        finally:
            out.unpersist()

    stream = spark.readStream.schema(CANDIDATES).parquet(inbox)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
