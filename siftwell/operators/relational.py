"""Keyed operators: latest per key, set difference, counters, interleaving."""

from __future__ import annotations

import random
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t


def latest_per_key(df: DataFrame, key: str, moment: str, sequence: str) -> DataFrame:
    """The newest row of each key; of equally new ones, the first in sequence.

    A min/max aggregate of structs, so that map tasks reduce a hot key to one row
    each before the shuffle. Null keys form one group; null moments are oldest.
    """
    rest = [c for c in df.columns if c != key]
    # newest first, then smallest sequence: the largest (moment, -sequence)
    order = F.struct(F.col(moment).alias("o_moment"), (-F.col(sequence)).alias("o_sequence"))
    best = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("row"))
    return best.select(*[F.col(key) if c == key else F.col(f"row.{c}") for c in df.columns])


def without_seen(df: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is not in ``seen``; rows with a null key stay. Spark picks the join by size."""
    return df.join(seen.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def only_seen(df: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    return df.join(seen.select(key).distinct(), key, "left_semi")


def date_range(moment: Column, start: str, end: str) -> Column:
    """Both days included, on the UTC date."""
    return F.to_date(moment).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def month_overlaps(first_day: Column, start: str, end: str) -> Column:
    return (F.last_day(first_day) >= F.lit(start).cast("date")) & (first_day <= F.lit(end).cast("date"))


def union_sources(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row: Spark moves no filter on them below, and repeats them in no later expression."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def source_stats(df: DataFrame, source: str, moment: str) -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("n"), F.min(moment).alias("first_at"), F.max(moment).alias("last_at"))


def week_counters(df: DataFrame, moment: str, reason: Column) -> DataFrame:
    """Per week: rows, those with a reason to go, those without."""
    return df.groupBy(t.week_key(F.col(moment)).alias("week_key")).agg(
        F.count("*").alias("pool"), F.count_if(reason.isNotNull()).alias("rejected"), F.count_if(reason.isNull()).alias("passed")
    )


def week_day_counts(df: DataFrame, moment: str) -> DataFrame:
    return df.groupBy(t.week_key(F.col(moment)).alias("week_key"), t.weekday(F.col(moment)).alias("weekday")).agg(F.count("*").alias("n"))


def round_robin(df: DataFrame, group: list[str], source: str, priority: Column, shuffle_key: Column) -> DataFrame:
    """Adds turn and source_priority: sources take turns within a group.

    Ordering by (group, turn, source_priority, source) interleaves. A source's
    rows follow a seeded hash, and ties their key; an exhausted source drops out.
    """
    w = Window.partitionBy(*group, source).orderBy(shuffle_key)
    return df.withColumns({"turn": F.row_number().over(w), "source_priority": priority})


def positions(written: DataFrame) -> DataFrame:
    """Rows of a Parquet folder with ``position``, from 1: files by name, rows as they stand in them.

    Offsets come from the files' sizes, a row for each file; no row moves.
    """
    rows = written.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = rows.groupBy("__file").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__file", F.coalesce(before, F.lit(0)).alias("__before"))
    return rows.join(offsets, "__file").withColumn("position", F.col("__before") + F.col("__row") + 1).drop("__file", "__row", "__before")


def shuffle_key(key: Column, seed: int) -> Column:
    """A pseudo-random order that doesn't depend on partitions; the key breaks ties."""
    return F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), key)


def shuffled_turns(df: DataFrame, group: list[str], source: str, moment: str, key: str, seed: Column) -> DataFrame:
    """Adds turn as a seeded generator deals it: one generator for a group's sources.

    In order of their first rows, each source's rows, by moment, are shuffled by
    the group's generator, and take turns in that order. Equal moments are
    ordered by source and key. Only keys and moments enter the grouped step, where
    a group's rows meet, so a group is what one worker holds: a day.
    """

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["m", "s", "k"], kind="stable")
        generator, turns = random.Random(int(rows["seed"].iloc[0])), {}
        for _, own in rows.groupby("s", sort=False, dropna=False):
            order = own.index.tolist()
            generator.shuffle(order)
            turns.update({at: i + 1 for i, at in enumerate(order)})
        rows["turn"] = pd.Series(turns)
        return rows[[*names, "s", "k", "turn"]]

    names = [f"g{i}" for i in range(len(group))]
    keys = df.select(*[F.col(c).alias(n) for c, n in zip(group, names, strict=True)], F.col(source).alias("s"), F.col(key).alias("k"), F.unix_micros(moment).alias("m"), seed.cast("long").alias("seed")).distinct()
    kinds = dict(keys.dtypes)
    dealt = keys.groupBy(*names).applyInPandas(deal, ", ".join(f"{n} {kinds[n]}" for n in (*names, "s", "k")) + ", turn int")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip([*group, source, key], [*names, "s", "k"], strict=True)]
    return df.join(dealt, reduce(lambda a, b: a & b, same)).select(*df.columns, "turn")
