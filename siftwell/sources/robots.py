"""robots.txt as a relation, and the leave that it gives URLs.

A robots.txt is small: the standard parser reads one text for each origin, and
its rules become rows. Deciding is a join on the origin and a look at the rules
that hold for an agent, in the JVM; of the rules whose prefix fits, the first
counts. The texts of pages take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

RULES = "origin string, entry int, agent string, pause double, rule int, prefix string, allow boolean"
#: The entry for all agents comes after those that name one.
_LAST = 2**31 - 1


def _pause(entry) -> float | None:
    """Seconds that an entry asks for: a crawl delay before a request rate."""
    if entry.delay is not None:
        return float(entry.delay)
    rate = entry.req_rate
    return rate.seconds / rate.requests if rate and rate.requests and rate.seconds else None


def rule_rows(origin: str, text: str | None) -> list[tuple]:
    """Rows of RULES: one for each agent and rule of an entry, or one without a rule."""
    parser = RobotFileParser()
    parser.parse((text or "").splitlines())
    entries = [(i, e, e.useragents) for i, e in enumerate(parser.entries)]
    if parser.default_entry:
        entries.append((_LAST, parser.default_entry, ["*"]))
    return [
        (origin, i, agent, _pause(e), k, prefix, allow)
        for i, e, agents in entries
        for agent in agents
        for k, prefix, allow in ([(k, line.path, line.allowance) for k, line in enumerate(e.rulelines)] or [(None, None, None)])
    ]


def rules(robots: DataFrame) -> DataFrame:
    """RULES of the robots.txt texts (origin, text); a null text has no rules."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RULES.split(", ")]
        for batch in batches:
            yield pd.DataFrame([r for o, x in zip(batch["origin"], batch["text"], strict=True) for r in rule_rows(o, x)], columns=names).astype({"rule": "Int32", "allow": "boolean"})

    return robots.select("origin", "text").mapInPandas(read, RULES)


def for_agent(table: DataFrame, agent: str) -> DataFrame:
    """(origin, pause, rules) of the entry that holds for ``agent``: the first that names it, else the one for all."""
    token = F.lit(agent.split("/")[0].lower())
    fits = (F.col("agent") == "*") | F.contains(token, F.lower("agent"))
    entries = table.where(fits).groupBy("origin", "entry").agg(F.first("pause").alias("pause"), F.array_sort(F.collect_set(F.when(F.col("rule").isNotNull(), F.struct("rule", "prefix", "allow")))).alias("rules"))
    return entries.groupBy("origin").agg(F.min_by(F.struct("pause", "rules"), "entry").alias("e")).select("origin", "e.pause", "e.rules")


def robots_path(url: Column) -> Column:
    """What rules are held against: all after the host, unescaped and escaped again; at least ``/``."""
    plain = F.regexp_replace(t.percent_decode(F.coalesce(url, F.lit(""))), r"^[\x00-\x20]+|[\t\r\n]", "")
    rest = F.regexp_replace(F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*:", ""), r"^//[^/?#]*", "")
    # marks with nothing after them go
    rest = F.regexp_replace(rest, r"^([^#]*)#\z", "$1")
    rest = F.regexp_replace(rest, r"^([^?#]*)\?(?=#|\z)", "$1")
    rest = F.regexp_replace(rest, r"^((?:[^?#]*/)?[^/?#;]*);(?=[?#]|\z)", "$1")
    rest = F.when(F.startswith(rest, F.lit("//")), F.concat(F.lit("//"), rest)).otherwise(rest)
    quoted = F.url_encode(rest)
    for written, kept in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        quoted = F.replace(quoted, F.lit(written), F.lit(kept))
    return F.coalesce(t.not_empty(quoted), F.lit("/"))


def allowed(path: Column, rules: Column) -> Column:
    """Whether the first rule that fits a path allows it; without one, yes."""
    fitting = F.filter(rules, lambda r: (r["prefix"] == "*") | F.startswith(path, r["prefix"]))
    return F.coalesce(F.get(fitting, 0)["allow"], F.lit(True))


def permissions(urls: DataFrame, table: DataFrame, agent: str, url: str = "url") -> DataFrame:
    """``urls`` with ``allowed``; an origin without rules allows everything. Spark chooses the join by size."""
    held = for_agent(table, agent).select(F.col("origin").alias("__origin"), F.col("rules").alias("__rules"))
    rows = urls.withColumn("__origin", t.url_origin(F.col(url))).join(held, "__origin", "left")
    return rows.withColumn("allowed", allowed(robots_path(F.col(url)), F.col("__rules"))).drop("__origin", "__rules")
