"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the
columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import line_dedup, ngram_join, packing, quality, shared, substring_dedup

#: A text with a word in it.
_WORDED = r"text rlike r'[^\x20\x09-\x0D]'"
#: A passage that repeats has over 50 words; these have so many bytes at least, in any language with words.
PASSAGE_WORDS, PASSAGE_BYTES = 51, 200


def _apart(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns under names that no operator uses, but for doc_id and text."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in ("doc_id", "text") else f"__column{i}") for i, c in enumerate(docs.columns)])


def _as_before(after: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with n_chars, if there, as the text now has it."""
    size = F.length("text").cast("long")
    return after.select(*[size.alias(c) if c == "n_chars" else F.col(c if c in ("doc_id", "text") else f"__column{i}").alias(c) for i, c in enumerate(docs.columns)])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return _as_before(quality.score(_apart(docs)).where("kept"), docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line passages go, and documents with nothing else."""
    return _as_before(line_dedup.dedup_lines(_apart(docs)).where(_WORDED), docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id stays."""
    return _as_before(ngram_join.first_of_groups(_apart(docs)), docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that repeat go, and documents with nothing else."""
    out = substring_dedup.remove_repeats(_apart(docs), size=PASSAGE_BYTES, min_words=PASSAGE_WORDS, decoded=True)
    return _as_before(out.withColumn("text", F.col("kept")).where(_WORDED), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, in sequences of at most 1024."""
    return packing.digests(packing.pack_documents(docs, packing.tokenizer_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack_sequences),
]

#: SQL can not state the tokenizer and the packing; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
