"""URLs that were seen, as a table in buckets by hash, with a Bloom filter for each bucket.

A small batch asks the filters of its own buckets, and reads the URLs of those
buckets alone in which a filter says that something may be there. What a filter
denies was never added, so nothing is left out by mistake and nothing that was
seen comes through. All of it is joins and bit operations in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .jsonl import exists


class SeenUrls:
    """The table under ``path``. Choose ``buckets`` so that one holds at most about a tenth of ``bits`` URLs.

    Fuller filters cost reads, not results. Each addition leaves one file of URLs
    and one filter in every bucket that it touches.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, bits: int = 1 << 16, hashes: int = 5):
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.spark, self.path, self.buckets, self.bits, self.hashes = spark, path, buckets, bits, hashes

    def _bucket(self, url: Column) -> Column:
        return F.pmod(F.xxhash64(url), F.lit(self.buckets)).cast("int")

    def _places(self, url: Column) -> Column:
        """The bits of a URL: (word, mask) of each."""
        a, b = (F.pmod(F.xxhash64(url, F.lit(k)), F.lit(1 << 31)) for k in (1, 2))
        at = F.transform(F.array(*[F.lit(k) for k in range(self.hashes)]), lambda k: (a + b * k) % self.bits)
        return F.transform(at, lambda p: F.struct(F.floor(p / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int")).alias("mask")))

    def add(self, urls: DataFrame, key: str = "url") -> None:
        """Adds the distinct URLs of ``urls``; nulls are ignored. One that is there already may be added again."""
        rows = urls.select(F.col(key).alias("url")).where("url is not null").distinct().withColumn("bucket", self._bucket(F.col("url")))
        rows = rows.repartition("bucket").persist()
        try:
            # the URLs first: a run that ends in between has URLs without a filter, which the next addition can repeat
            rows.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/urls")
            words = rows.select("bucket", F.explode(self._places(F.col("url"))).alias("p")).select("bucket", "p.word", "p.mask")
            blank = rows.select("bucket").distinct().select("bucket", F.explode(F.sequence(F.lit(0), F.lit(self.bits // 64 - 1))).alias("word"), F.lit(0).cast("long").alias("mask"))
            words = words.union(blank).groupBy("bucket", "word").agg(F.bit_or("mask").alias("mask"))
            filters = words.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("w"))
            filters.select("bucket", F.col("w.mask").alias("words")).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/filters")
        finally:
            rows.unpersist()

    def _read(self, part: str, schema: str, buckets: list[int]) -> DataFrame:
        return self.spark.read.schema(f"{schema}, bucket int").parquet(f"{self.path}/{part}").where(F.col("bucket").isin(buckets))

    def maybe(self, urls: DataFrame) -> DataFrame:
        """(url, bucket) of the distinct URLs that a filter doesn't deny."""
        keys = urls.select("url").where("url is not null").distinct().withColumn("bucket", self._bucket(F.col("url")))
        touched = [r["bucket"] for r in keys.select("bucket").distinct().collect()]  # at most as many as there are buckets
        held = F.forall(self._places(F.col("url")), lambda p: F.get(F.col("words"), p["word"]).bitwiseAND(p["mask"]) != 0)
        return keys.join(self._read("filters", "words array<bigint>", touched), "bucket").where(held).select("url", "bucket").distinct()

    def seen(self, urls: DataFrame, key: str = "url") -> DataFrame:
        """The distinct URLs (column ``key``) that were added."""
        named = urls.select(F.col(key).alias("url"))
        if not (exists(self.spark, f"{self.path}/urls") and exists(self.spark, f"{self.path}/filters")):
            return named.where("false").withColumnRenamed("url", key)
        near = self.maybe(named).persist()
        buckets = [r["bucket"] for r in near.select("bucket").distinct().collect()]
        return near.join(self._read("urls", "url string", buckets), ["bucket", "url"], "left_semi").select(F.col("url").alias(key))

    def unseen(self, rows: DataFrame, key: str = "url") -> DataFrame:
        """Rows whose URL was not added; those without a URL stay."""
        return rows.join(self.seen(rows, key), key, "left_anti")
