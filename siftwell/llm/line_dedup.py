"""Removal of repeated passages by windows of three lines.

Every run of three consecutive lines that hold a word is hashed. Windows found
more than once, in any text, keep their first occurrence (smallest doc_id, then
text, then line); the lines that later occurrences cover are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

LINES = 3
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def worded_lines(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start and end without the white space around) of each line that holds a word."""
    starts, ends, _ = shared.word_spans(raw, offs)
    begin = np.unique(np.concatenate([offs[:-1], np.flatnonzero(raw == 10) + 1]))
    begin = begin[begin < len(raw)]
    stop = np.append(begin[1:], len(raw))[: len(begin)]
    w0, w1 = np.searchsorted(starts, begin), np.searchsorted(starts, stop)
    worded = w1 > w0
    w0, w1, begin = w0[worded], w1[worded], begin[worded]
    return np.searchsorted(offs, begin, side="right") - 1, starts[w0], ends[w1 - 1]


def line_windows(raw: np.ndarray, offs: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, number of its first line, hash) of each window; blank lines don't count."""
    text, begin, end = worded_lines(raw, offs)
    line = shared.SpanHash(raw).of(begin, end)
    keys = shared.window_hashes(line, lines)
    number = np.arange(len(line)) - np.searchsorted(text, text)
    inside = text[: len(keys)] == text[lines - 1 :] if len(keys) else np.zeros(0, bool)
    return text[: len(keys)][inside], number[: len(keys)][inside], keys[inside]


def without_lines(text: str, windows: list[int], lines: int) -> tuple[str, int]:
    """``text`` without the lines that the windows cover, and how many these are."""
    gone = {w + k for w in windows for k in range(lines)}
    out, number = [], 0
    for line in text.split("\n"):
        if _WORD.search(line):
            number += 1
            if number - 1 in gone:
                continue
        out.append(line)
    return "\n".join(out), len(gone)


def dedup_lines(docs: DataFrame, text: str = "text", lines: int = LINES) -> DataFrame:
    """``docs`` with ``text`` shortened, and with n_lines and n_removed (long).

    Every row stays. Lines are what newlines separate, compared without the
    white space around them; n_lines counts those with a word, only these form
    windows and are removed. Null texts stay null; texts with fewer than
    ``lines`` lines stay as they are. Rows with the same doc_id and text are one
    document stated twice and are cut alike; a null doc_id comes first. Columns
    named n_lines or n_removed are replaced.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*[f"`{c}`" for c in names])
    shared.small_batches(docs.sparkSession)
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, raw, offs in shared.text_chunks(b.column(2)):
                at, number, key = line_windows(raw, offs, lines)
                rows = pa.array(at + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(number.astype(np.int32)), pa.array(key.view(np.int64))], names=["k_id", "k_text", "w", "h"]
                )

    windows = docs.select(*shared.row_key(text_col=text), F.col(text)).mapInArrow(shared.tidy(cut), "k_id long, k_text long, w int, h long")
    windows = shared.materialize(windows, "windows")
    place = F.struct("k_id", "k_text", "w")
    twice = windows.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = windows.join(twice, "h").where(place != F.col("first"))
    later = later.select("k_id", "k_text", "w").distinct().groupBy("k_id", "k_text").agg(F.array_sort(F.collect_list("w"))).toDF(*shared.RESERVED, "__siftwell_cut")
    joined = docs.select("*", *shared.row_key(text_col=text, names=shared.RESERVED)).join(later, [*shared.RESERVED], "left").drop(*shared.RESERVED)
    frame = shared.widened(docs, "n_lines long, n_removed long")
    k = names.index(text)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, texts = [], []
            count = [np.bincount(worded_lines(raw, offs)[0], minlength=j - i) for i, j, raw, offs in shared.text_chunks(b.column(k))]
            for t, gone in zip(b.column(k).to_pylist(), b.column(len(names)).to_pylist(), strict=True):
                new, n = without_lines(t, gone, lines) if gone else (t, 0)
                texts.append(new)
                removed.append(n)
            columns = b.columns[: len(names)]
            columns[k] = pa.array(texts, columns[k].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([np.zeros(0, np.int64), *count])), pa.array(removed, pa.int64())], names=[*names, "n_lines", "n_removed"])

    return joined.mapInArrow(shared.tidy(apply), frame)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), lines AS (
  SELECT doc_id, pos, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM raw
), worded AS (
  SELECT doc_id, pos, bare, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM lines WHERE bare <> ''
), windows AS (
  SELECT doc_id, n, bare AS a, lead(bare, 1) OVER w AS b, lead(bare, 2) OVER w AS c FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY n)
), ranked AS (
  SELECT doc_id, n, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, n) AS k FROM windows WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, n + i AS n FROM ranked, (VALUES (0), (1), (2)) AS t(i) WHERE k > 1
), marked AS (
  SELECT l.doc_id, l.pos, l.line, w.n, g.n AS g
  FROM lines l LEFT JOIN worded w ON l.doc_id = w.doc_id AND l.pos = w.pos LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.n = w.n
)
SELECT doc_id, count(n) AS n_lines, count(g) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE g IS NULL), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""
