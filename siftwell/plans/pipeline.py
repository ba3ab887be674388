"""The whole run: collect candidates, choose those worth reading, enrich, write."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.page import page_metadata
from ..operators import relational as r
from ..operators.rules import Rules
from ..sources import jsonl
from ..sources.publishers import Publisher, all_candidates
from ..sources.seen import SeenUrls
from .config import RunConfig

Fetch = Callable[[DataFrame], DataFrame]


def collect_candidates(
    spark: SparkSession, fetch: Fetch, config: RunConfig, rules: Rules, of: list[Publisher] | None = None, counted: dict[str, Observation] | None = None
) -> DataFrame:
    """Candidates of all publishers, the newest of each URL; ``counted`` gets what each publisher listed before that.

    Ties keep the first by (source priority, title); the order of fetching, which
    decides elsewhere, isn't defined on a cluster.
    """
    return newest(all_candidates(spark, fetch, config.start_date, config.end_date, rules, of, counted), rules)


def newest(rows: DataFrame, rules: Rules) -> DataFrame:
    """The newest candidate of each URL; ties as in ``collect_candidates``, a null moment is oldest."""
    order = F.struct(F.coalesce(-F.unix_micros("published_at"), F.lit(2**63 - 1)), rules.priority(F.col("source")), F.coalesce("title", F.lit("")), F.coalesce("section", F.lit("")))
    best = rows.groupBy("url").agg(F.min_by(F.struct("source", "published_at", "title", "section"), order).alias("row"))
    return best.select("row.source", "url", "row.published_at", "row.title", "row.section")


def judge_candidates(fresh: DataFrame, rules: Rules) -> DataFrame:
    """Candidates with week, weekday and ``reject_reason``, the early rules' verdict (null: worth reading)."""
    return rules.early_reason(fresh).withColumns({"week_key": t.week_key(F.col("published_at")), "weekday": t.weekday(F.col("published_at"))})


def select_candidates(candidates: DataFrame, seen: DataFrame, rules: Rules) -> DataFrame:
    """Unseen candidates that the early rules keep, with week and weekday."""
    return judge_candidates(r.without_seen(candidates, seen), rules).where("reject_reason is null").drop("reject_reason")


def with_turns(selected: DataFrame, rules: Rules, seed: int, exact: bool = False) -> DataFrame:
    """Adds turn and source_priority: the sources of a day take turns, each in a seeded order.

    ``exact`` deals the turns by the seeded generator itself, a day a task.
    """
    priority = rules.priority(F.col("source"))
    if exact:
        return r.shuffled_turns(selected, ["week_key", "weekday"], "source", "published_at", "url", F.lit(seed) + F.col("weekday")).withColumn("source_priority", priority)
    return r.round_robin(selected, ["week_key", "weekday"], "source", priority, r.shuffle_key(F.col("url"), seed))


def in_turns(selected: DataFrame, rules: Rules, seed: int, exact: bool = False) -> DataFrame:
    """The order in which pages are asked for; it doesn't change what is written."""
    return with_turns(selected, rules, seed, exact).orderBy("week_key", "weekday", "turn", "source_priority", "source")


#: Weeks in order, days in a week, and turns in a day.
ORDER = ("week", "weekday", "turn", "source_priority", "source", "url")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows dealt by ranges of ORDER, and in order within each: files by name are in order."""
    return rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def enrich(selected: DataFrame, fetch: Fetch, config: RunConfig, rules: Rules) -> DataFrame:
    """Records of the selected candidates, with ``reject_reason`` (null: kept)."""
    if hasattr(fetch, "onto"):  # what is read comes beside the candidates
        rows = fetch.onto(selected).where("status = 'ok'").drop("url_key", "final_url", "status")
    else:
        rows = selected.join(fetch(selected.select("url")).where("status = 'ok'").select("url", "text"), "url")
    rows = rows.withColumn("page", page_metadata(F.col("text"))).drop("text")
    title = F.coalesce(t.not_empty(F.col("page.title")), t.not_empty(F.col("title")), t.slug_title(F.col("url")))
    rows = rows.withColumns({"title": title, "published_at": F.coalesce("page.published_at", "published_at"), "tags": F.col("page.tags"), "found": F.col("page.description")})
    rows = rows.where(r.date_range(F.col("published_at"), config.start_date, config.end_date)).where(t.not_empty(F.col("title")).isNotNull())
    # each step computed once: the filter on the reason would repeat what it is made of wherever it is used
    rows = r.with_once(rows, {"description": t.sanitize_description(F.col("found"), F.col("title"))}).drop("page", "found")
    rows = r.with_once(rows, {"hits": rules.signals(t.join_parts(F.col("title"), F.col("description"), F.array_join("tags", " ")))})
    return rules.record_reason(rows.withColumns({"core_hits": F.col("hits.core"), "brazil_hits": F.col("hits.brazil")}).drop("hits"))


def records(enriched: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """The output's ten fields of the records that stay, and columns to carry along."""
    ts = F.col("published_at")
    return enriched.where("reject_reason is null").select(
        "source", "url", t.iso_timestamp(ts).alias("published_at"), t.week_key(ts).alias("week_key"), t.week_start(ts).cast("string").alias("week_start"),
        t.week_end(ts).cast("string").alias("week_end"), "tags", "title", "description", t.sentiment_text(F.col("title"), F.col("description")).alias("sentiment_text"), *more,
    )


def run(spark: SparkSession, fetch: Fetch, config: RunConfig, rules: Rules | None = None, of: list[Publisher] | None = None) -> int:
    """Writes config.output, week by week; the number of records written.

    A folder for each week that candidates were listed in; rows in their turns.
    Weeks are committed in order, a few at a time. A run that ends early has lost
    the weeks that weren't committed; resuming adds only URLs that aren't there.
    A run without anything worth reading leaves the output alone.

    With config.metrics, counters are written there too: ``sources`` (what each
    source listed, before repeated URLs fall together) and ``weeks`` (pool,
    rejected before reading, passed and so read, approved).
    """
    rules = rules or Rules()
    counted: dict[str, Observation] = {}
    table = SeenUrls(spark, config.seen) if config.seen else None
    fresh = candidates = collect_candidates(spark, fetch, config, rules, of, counted).persist()
    candidates.count()  # all of them, whatever is left of them below: what was listed is known now
    if config.resume:
        fresh = table.unseen(fresh) if table else r.without_seen(fresh, jsonl.seen_urls(spark, config.output))
    judged = with_turns(judge_candidates(fresh, rules), rules, config.seed).withColumnRenamed("week_key", "week").persist()
    try:
        pools = judged.groupBy("week").agg(F.count("*").alias("pool"), F.count_if(F.col("reject_reason").isNotNull()).alias("rejected")).collect()  # a row for each week
        counts = {x["week"]: {"week_key": x["week"], "pool": x["pool"], "rejected": x["rejected"], "passed": x["pool"] - x["rejected"], "approved": 0} for x in pools}
        todo = sorted(w for w, c in counts.items() if c["passed"])
        if todo and not config.resume:
            jsonl.clear(spark, config.output)
            if table:
                jsonl.clear(spark, config.seen)
        for i in range(0, len(todo), config.weeks_per_commit):
            weeks = todo[i : i + config.weeks_per_commit]
            rows = enrich(judged.where(F.col("week").isin(weeks) & F.col("reject_reason").isNull()).drop("reject_reason"), fetch, config, rules)
            approved = Observation()
            out = ordered(records(rows, ("week", "weekday", "turn", "source_priority"))).observe(approved, *[F.count_if(F.col("week") == w).alias(w) for w in weeks])
            jsonl.write_weeks(out, config.output, append=config.resume)
            for w, n in approved.get.items():
                counts[w]["approved"] = n
            if table:
                written = spark.read.schema("url string, week string").json(config.output).where(F.col("week").isin(weeks))
                table.add(table.unseen(written))
        if config.metrics:
            sources = [(name, *observed(o)) for name, o in counted.items()]
            spark.createDataFrame(sources, "source string, n long, first_at timestamp, last_at timestamp").write.mode("overwrite").json(f"{config.metrics}/sources")
            kind = "week_key string, pool long, rejected long, passed long, approved long"
            spark.createDataFrame([tuple(c.values()) for _, c in sorted(counts.items())], kind).write.mode("overwrite").json(f"{config.metrics}/weeks")
        return sum(c["approved"] for c in counts.values())
    finally:
        judged.unpersist()
        candidates.unpersist()


def observed(listing: Observation) -> tuple:
    """n, first_at and last_at of a listing. Where Spark has seen that it is empty, it leaves the step out, with what it observes."""
    try:
        found = listing.get
    except Py4JJavaError:
        return 0, None, None
    return found["n"], found["first_at"], found["last_at"]
