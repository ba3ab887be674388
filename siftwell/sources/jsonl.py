"""JSON Lines: the output's fields in order, and the URLs already written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.vocabulary import OUTPUT_FIELDS


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def seen_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct urls of the lines that can be read; none if there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url string")
    # files in folders by week, or none of these
    lines = spark.read.schema("url string").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)
    return lines.where(F.col("url").isNotNull() & (F.col("url") != "")).distinct()


def write_records(records: DataFrame, path: str, append: bool) -> None:
    """One JSON object a line, nulls written, characters unescaped."""
    fields = records.select(*OUTPUT_FIELDS)
    fields.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_weeks(records: DataFrame, path: str, append: bool) -> None:
    """The same in a folder for each value of the column ``week``, rows in the order that they are in.

    Without ``append``, the weeks written replace what these weeks had, so that
    writing them once more leaves no row twice; other weeks stay.
    """
    fields = records.select("week", *OUTPUT_FIELDS)
    mode = ("append", "static") if append else ("overwrite", "dynamic")
    fields.write.mode(mode[0]).option("partitionOverwriteMode", mode[1]).option("ignoreNullFields", "false").partitionBy("week").json(path)


def clear(spark: SparkSession, path: str) -> None:
    """Removes an output, if there is one."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
