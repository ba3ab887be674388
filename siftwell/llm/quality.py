"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths find, in numpy, the words that lie in
n-grams which a text repeats, and the lines that it repeats; the shares of a
text's characters inside them decide. A text's windows are only compared with
that text's own, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import shared

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "dup_line_share double, dup_5gram_share double, dup_10gram_share double, top_2gram_share double"
)


@dataclass(frozen=True)
class Limits:
    """Largest shares of a text's word characters that may be repetition."""

    dup_line: float = 0.30
    dup_ngram: tuple[tuple[int, float], ...] = ((5, 0.40), (6, 0.38), (7, 0.36), (8, 0.34), (9, 0.32), (10, 0.30))
    top_ngram: tuple[tuple[int, float], ...] = ((2, 0.30), (3, 0.25), (4, 0.25))
    symbol: float = 0.30  #: symbols for each word
    min_words: int = 20
    repeat_percent: int = 30  #: words in repeated 8-word windows


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = 10


def measure(column: pa.Array, limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """The columns of SCHEMA for an array of texts (null counts as empty)."""
    parts = [_measure(raw, offs, limits) for _, _, raw, offs in shared.text_chunks(column)]
    if not parts:
        parts = [_measure(np.zeros(0, np.uint8), np.zeros(1, np.int64), limits)]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def _covered(hit: np.ndarray, k: int, n: int) -> np.ndarray:
    """Positions inside the windows of ``k`` that start where ``hit`` is set."""
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + k, -1)
    return np.cumsum(edge[:-1]) > 0


def _measure(raw: np.ndarray, offs: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    n_text = len(offs) - 1
    starts, ends, first = shared.word_spans(raw, offs)
    n_words = np.diff(first)
    hashes = shared.SpanHash(raw)
    words = hashes.of(starts, ends)
    text_of = np.repeat(np.arange(n_text), n_words)
    points = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]  # code points of each word
    chars_to = np.zeros(len(words) + 1, np.int64)
    np.cumsum(chars, out=chars_to[1:])
    word_chars = chars_to[first[1:]] - chars_to[first[:-1]]
    salt = shared.mix(text_of.astype(np.uint64) + np.uint64(1))

    def windows(k: int) -> np.ndarray:
        """A key for each window of one text, by its first word; -1 marks none."""
        n = max(len(words) - k + 1, 0)
        return np.flatnonzero(text_of[:n] == text_of[k - 1 : k - 1 + n]) if n else np.zeros(0, np.int64)

    def found_twice(k: int, at: np.ndarray) -> np.ndarray:
        """Of the windows of ``k`` words at ``at``, those a text holds twice."""
        key = np.zeros(len(at), np.uint64)
        for j in range(k):
            key *= np.uint64(shared._BASE)
            key += words[at + j]
        return at[shared.repeated(shared.mix(key) ^ salt[at])]

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.where(mask, chars, 0), out=total[1:])
        return (total[first[1:]] - total[first[:-1]]) / np.maximum(word_chars, 1)

    def cover(at: np.ndarray, k: int) -> np.ndarray:
        hit = np.zeros(len(words), bool)
        hit[at] = True
        return _covered(hit, k, len(words)) if len(words) else hit

    # A repeated window of n words starts with a repeated window of n - 1.
    two = found_twice(2, windows(2))
    dup = {2: two}
    for k in range(3, 11):
        fit = dup[k - 1]
        fit = fit[fit + k <= len(words)]
        fit = fit[text_of[fit] == text_of[fit + k - 1]] if len(fit) else fit
        dup[k] = found_twice(k, fit)

    repeat_words = _per_text(cover(dup[8], 8), first)
    dup_share = {k: share(cover(dup[k], k)) for k, _ in limits.dup_ngram}
    top_share = {k: _top(dup[k], k, words, chars_to, salt, text_of, n_text) / np.maximum(word_chars, 1) for k, _ in limits.top_ngram}

    # Lines: between newlines, of one text each, that hold a word.
    cut = np.flatnonzero(raw == _NEWLINE)
    line_start = np.unique(np.concatenate([offs[:-1][offs[:-1] < offs[1:]], cut + 1]))
    line_start = line_start[line_start < len(raw)]
    line_text = np.searchsorted(offs, line_start, side="right") - 1
    line_end = np.append(line_start[1:], len(raw))[: len(line_start)]
    line_end = np.where((line_end > line_start) & (raw[line_end - 1] == _NEWLINE) & (line_end - 1 >= line_start), line_end - 1, line_end) if len(line_start) else line_end
    w0, w1 = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    worded = w1 > w0
    line_start, line_end, line_text, w0, w1 = (x[worded] for x in (line_start, line_end, line_text, w0, w1))
    key = hashes.of(line_start, line_end) ^ shared.mix(line_text.astype(np.uint64) + np.uint64(1))
    later = np.ones(len(key), bool)
    later[np.unique(key, return_index=True)[1]] = False
    n_dup_lines = np.bincount(line_text[later], minlength=n_text)
    line_chars = np.bincount(line_text[later], (chars_to[w1] - chars_to[w0])[later], minlength=n_text)
    line_share = line_chars / np.maximum(word_chars, 1)

    symbols = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_SYMBOL[raw], out=symbols[1:])
    n_symbols = symbols[offs[1:]] - symbols[offs[:-1]]

    failed = (n_words < limits.min_words) | (100 * repeat_words > limits.repeat_percent * n_words)
    bad = (line_share > limits.dup_line) | (n_symbols > limits.symbol * n_words)
    for k, most in limits.dup_ngram:
        bad |= dup_share[k] > most
    for k, most in limits.top_ngram:
        bad |= top_share[k] > most
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": repeat_words,
        "base_failed": failed, "kept": ~(failed | bad), "dup_line_share": line_share, "dup_5gram_share": dup_share[5], "dup_10gram_share": dup_share[10],
        "top_2gram_share": top_share[2],
    }


def _top(at: np.ndarray, k: int, words: np.ndarray, chars_to: np.ndarray, salt: np.ndarray, text_of: np.ndarray, n_text: int) -> np.ndarray:
    """Characters in all occurrences of each text's heaviest repeated n-gram."""
    out = np.zeros(n_text)
    if not len(at):
        return out
    key = np.zeros(len(at), np.uint64)
    for j in range(k):
        key *= np.uint64(shared._BASE)
        key += words[at + j]
    _, one, where = np.unique(shared.mix(key) ^ salt[at], return_index=True, return_inverse=True)
    total = np.bincount(where, chars_to[at + k] - chars_to[at])
    np.maximum.at(out, text_of[at[one]], total)
    return out


def score(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the columns of SCHEMA added; every row stays.

    Null and empty texts have no words and fail. Ties and repeated rows are
    judged alike. A column of ``docs`` named like one of ours is replaced.
    """
    ours = [x.strip().split(" ")[0] for x in SCHEMA.split(",")]
    keep = [f for f in docs.schema.fields if f.name not in ours]
    frame = docs.select(*[f"`{f.name}`" for f in keep])
    shared.small_batches(docs.sparkSession)
    out = shared.widened(frame, SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = measure(b.column(b.schema.get_field_index(text)), limits)
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(got[k]) for k in ours], names=b.schema.names + ours)

    return frame.mapInArrow(shared.tidy(run), out)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(shared.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
