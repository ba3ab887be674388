"""Removal of long repeated byte strings by sharded suffix arrays.

Each string of ``size`` bytes has an anchor: the smallest hash among its grams
of half its size. Equal strings have equal anchors, so runs of strings with one
anchor ("regions") are all that must be brought together. Regions whose anchor
occurs once repeat nothing. Of the others, equal regions are one; where an
anchor's regions differ, their bytes go into a shard, whose suffix array and
permuted common prefixes tell which strings repeat.

An anchor with more different regions than a shard takes is cut finer: its
regions are split by the smallest hash among longer grams, which drops and
merges most of what is left, and so on until every anchor's regions fit a shard.
At grams of ``size`` bytes a region is one string, so equal ones are one and
nothing is left over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .suffix_array import common_prefixes, suffix_array

SIZE = 400
#: Bits of the filter of repeated anchors; fixed, so what is broadcast doesn't grow.
FILTER_BITS = 1 << 25
#: Bytes of a shard (more only to keep an anchor's regions together).
SHARD = 1 << 20
#: Different regions of an anchor that a shard takes; those of more are cut finer.
TOGETHER = 2048
#: Bytes of a text that are looked at in one go.
LONG = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def gram_sizes(size: int) -> list[int]:
    """Gram lengths of the levels: each leaves a quarter of the strings that may share an anchor side by side."""
    out, window = [], size - size // 2 + 1
    while window > 1:
        out.append(size - window + 1)
        window = -(-window // 4)
    return [*out, size]


def regions(raw: np.ndarray, offs: np.ndarray, size: int = SIZE, gram: int | None = None) -> tuple[np.ndarray, ...]:
    """(text, first and last start, anchor, hash of its bytes, tied) of each region.

    tied: the region holds a string twice.
    """
    n, gram = len(raw), gram or gram_sizes(size)[0]
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    if n < size:
        return none
    hashes = shared.SpanHash(raw)
    at = np.arange(n - gram + 1)
    h = hashes.of(at, at + gram)
    width = size - gram + 1
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(h)] = h
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - size + 1
    low = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    text = np.searchsorted(offs, np.arange(starts), side="right") - 1
    inside = np.arange(starts) + size <= offs[text + 1]
    new = np.ones(starts, bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    new &= inside
    first = np.flatnonzero(new)
    if not len(first):
        return none
    limit = np.append(first[1:], starts)
    last = np.minimum(limit - 1, offs[text[first] + 1] - size)
    # a run over periodic text is split; its strings keep their anchor
    parts = (last - first) // width + 1
    begin = np.repeat(first, parts) + width * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    last = np.minimum(begin + width - 1, np.repeat(last, parts))
    anchor = low[begin]
    # Can a region repeat itself? Its anchor's hash must be there twice; a table
    # of the anchors' upper bits leaves few places to look at.
    bits = 18
    known = np.zeros(1 << bits, bool)
    known[(anchor >> np.uint64(64 - bits)).astype(np.int64)] = True
    near = np.flatnonzero(known[(h >> np.uint64(64 - bits)).astype(np.int64)])
    near = near[np.argsort(h[near], kind="stable")]  # by hash, then by place
    value = h[near]
    lo, hi = np.searchsorted(value, anchor, "left"), np.searchsorted(value, anchor, "right")
    tied = np.zeros(len(begin), bool)
    for i in np.flatnonzero((hi - lo > 1) & (last > begin)).tolist():
        places = near[lo[i] : hi[i]]
        if np.searchsorted(places, last[i] + width) - np.searchsorted(places, begin[i]) > 1:
            at = np.arange(begin[i], last[i] + 1)
            tied[i] = len(np.unique(hashes.of(at, at + size))) < len(at)
    return text[begin], begin - offs[text[begin]], last - offs[text[begin]], anchor, hashes.of(begin, last + size), tied


def repeats(parts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """For each string, the starts of its ``size``-byte strings that occur elsewhere in ``parts`` too."""
    length = np.array([len(x) + 1 for x in parts])
    raw = np.frombuffer(b"".join(x + b"\0" for x in parts), np.uint8)
    start = np.cumsum(length) - length
    end = start + length - 1
    symbols = raw.astype(np.int64) + 1
    symbols[end] = 0  # what parts the strings
    order = suffix_array(symbols)
    common, before = common_prefixes(raw, order, start, end, size)
    hit = np.flatnonzero(common >= size)
    twice = np.zeros(len(raw), bool)
    twice[hit] = True
    twice[before[hit]] = True
    return [np.flatnonzero(twice[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]


def _runs(at: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return list(zip(at[np.append(0, cut + 1)].tolist(), at[np.append(cut, len(at) - 1)].tolist(), strict=True))


def _bit(v: np.ndarray) -> np.ndarray:
    return (shared.mix(v.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_of(anchors: DataFrame) -> np.ndarray:
    """A bit for each anchor's slot: what it lets through is looked up afterwards."""
    block = 1 << 16

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for b in batches:
            bits[_bit(b.column(0).to_numpy())] = True
        packed = np.packbits(bits, bitorder="little")
        used = [i for i in range(len(packed) // block) if packed[i * block : (i + 1) * block].any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([packed[i * block : (i + 1) * block].tobytes() for i in used], pa.binary())], names=["at", "bits"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                got = np.frombuffer(x, np.uint8)
                total[i] = total[i] | got if i in total else got
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["at", "bits"])

    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for i, x in anchors.mapInArrow(shared.tidy(put), "at int, bits binary").repartition("at").mapInArrow(shared.tidy(join), "at int, bits binary").collect():  # FILTER_BITS in all
        out[i * block : (i + 1) * block] = np.frombuffer(x, np.uint8)
    return out


_KEY = "k_id long, k_text long, base long"
_PIECE = f"{_KEY}, v long, d long, done boolean, bytes binary"


def _regions_of(source: DataFrame, size: int, gram: int) -> DataFrame:
    """(key, a, b, v, r, tied, done) of the regions of each row of ``source`` (_PIECE); a and b count from the text's start."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, of, done = (np.array(b.column(i)) for i in (2, 3, 5))
            for i, _, raw, offs in shared.byte_chunks(b.column(6)):
                step = LONG if len(offs) == 2 else len(raw)
                for lo in range(0, len(raw), step):  # a very long text in parts, each with the strings that start in it
                    part = raw[lo : lo + step + size - 1]
                    at, first, last, anchor, whole, tied = regions(part, np.minimum(offs, len(part)), size, gram)
                    at = at + i
                    rows = pa.array(at)
                    anchor = shared.mix(anchor ^ of[at].view(np.uint64))  # strings of one anchor stay among themselves
                    start = base[at] + lo
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(k).take(rows) for k in range(3)), pa.array(first + start), pa.array(last + start), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(tied), pa.array(done[at])],
                        names=["k_id", "k_text", "base", "a", "b", "v", "r", "tied", "done"],
                    )

    return source.mapInArrow(shared.tidy(find), f"{_KEY}, a long, b long, v long, r long, tied boolean, done boolean")


def _pieces_of(source: DataFrame, differ: DataFrame, size: int) -> DataFrame:
    """The bytes of the regions ``differ`` (key, a, b, v, d, done), cut from ``source``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(i, 128) for b in batches for i in range(0, b.num_rows, 128)):
            rows = []
            for k, t, base, parts, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rows += [(k, t, p["a"], p["v"], p["d"], p["done"], data[p["a"] - base : p["b"] - base + size]) for p in parts]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], x) for i, x in enumerate(kinds)], names=["k_id", "k_text", "base", "v", "d", "done", "bytes"])

    by_row = differ.groupBy("k_id", "k_text", "base").agg(F.collect_list(F.struct("a", "b", "v", "d", "done")).alias("parts"))
    joined = source.select("k_id", "k_text", "base", "bytes").join(by_row, ["k_id", "k_text", "base"]).select("k_id", "k_text", "base", "parts", "bytes")
    return joined.mapInArrow(shared.tidy(cut), _PIECE)


def _sift(found: DataFrame, size: int, corpus: bool) -> tuple[DataFrame, DataFrame]:
    """Of regions: the spans of those that occur twice, and the different ones of an anchor, one each, with their number ``d``.

    ``corpus``: regions of all texts, most of whose anchors occur once; a filter
    of fixed size keeps these out of the join.
    """
    many = found.groupBy("v").agg(F.count("*").alias("c"), F.max("tied").alias("t")).where("c > 1 or t").select("v")
    if corpus:
        many = shared.materialize(many, "anchors")
        seen = found.sparkSession.sparkContext.broadcast(_filter_of(many))
        at = found.columns.index("v")

        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bit = _bit(b.column(at).to_numpy())
                yield b.filter(pa.array((seen.value[bit >> 3] >> (bit & 7) & 1).astype(bool)))

        kept = found.mapInArrow(shared.tidy(likely), found.schema).join(many, "v").select(found.columns)
    else:
        kept = found.join(many, "v").select(found.columns)
    kept = shared.materialize(kept, "repeated")
    shared.discard(found)
    # one row for each different region; if it occurs twice, all its strings repeat
    same = kept.groupBy("v", "r").agg(F.count("*").alias("c"), F.min(F.struct("k_id", "k_text", "base", "a", "b")).alias("p"), F.max("tied").alias("t"), F.max("done").alias("done"))
    same = shared.materialize(same, "distinct")
    several = same.groupBy("v").agg(F.count("*").alias("d"), F.max("t").alias("tied")).where("d > 1 or tied")
    spans = kept.where("not done").join(same.where("c > 1").select("v", "r"), ["v", "r"]).select("k_id", "k_text", F.col("a").alias("s"), (F.col("b") + size).alias("e"))
    differ = same.join(several.select("v", "d"), "v").select("p.*", "v", "d", F.expr("done or c > 1").alias("done"))
    return spans, differ


def _search(pieces: DataFrame, size: int) -> DataFrame:
    """(k_id, k_text, s, e): runs of strings that repeat among an anchor's pieces, by the suffix array of their shard."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for row, at in zip(rows, repeats([r[6] for r in rows], size), strict=True):
            if not row[5]:
                out += [(row[0], row[1], row[2] + i, row[2] + j + size) for i, j in _runs(at)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names=["k_id", "k_text", "s", "e"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, anchor, before = [], 0, None, None
        for b in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if row[:4] == before:  # a document stated twice
                    continue
                if held >= SHARD and row[3] != anchor:
                    yield flush(rows)
                    rows, held = [], 0
                anchor, before = row[3], row[:4]
                rows.append(row)
                held += len(row[6])
        if rows:
            yield flush(rows)

    return pieces.repartition("v").sortWithinPartitions("v", "k_id", "k_text", "base").mapInArrow(shared.tidy(search), "k_id long, k_text long, s long, e long")


def repeated_spans(docs: DataFrame, text: str, size: int) -> DataFrame:
    """(k_id, k_text, spans): byte spans of each text that repeated strings cover."""
    spark = docs.sparkSession
    shared.small_batches(spark)
    none = F.lit(0).cast("long")
    source = docs.select(
        *shared.row_key(text_col=text), none.alias("base"), none.alias("v"), none.alias("d"), F.lit(False).alias("done"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("bytes")
    )
    out = None
    for level, gram in enumerate(gram_sizes(size)):
        found = shared.materialize(_regions_of(source, size, gram), "regions")
        spans, differ = _sift(found, size, not level)
        pieces = shared.materialize(_pieces_of(source, differ, size), "pieces")
        fits = pieces.where(F.col("d") <= TOGETHER)
        spans = spans.union(shared.materialize(_search(fits, size), "spans"))
        out = spans if out is None else out.union(spans)
        source = pieces.where(F.col("d") > TOGETHER).dropDuplicates(["k_id", "k_text", "base"])
        if source.isEmpty():
            break
    return out.groupBy("k_id", "k_text").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in spans:
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def remove_repeats(docs: DataFrame, text: str = "text", size: int = SIZE, min_words: int = 0, decoded: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (long) and kept (binary) added.

    ``decoded``: kept is a string, as ``as_text`` makes it, without a second
    Python worker a task.

    Every byte that a ``size``-byte string covers which starts anywhere else too
    is removed, in all its places, judged on the input as it is; with
    ``min_words``, only where such bytes lie in a run that holds so many words.
    Every row stays. Null texts count as empty; rows with the same doc_id and
    text repeat each other. Columns named like ours are replaced.
    """
    ours = ["n_bytes", "n_removed", "n_spans", "kept"]
    names = [c for c in docs.columns if c not in ours]
    docs = docs.select(*[f"`{c}`" for c in names])
    spans = repeated_spans(docs, text, size).withColumnsRenamed(dict(zip(("k_id", "k_text"), shared.RESERVED, strict=True)))
    joined = docs.select("*", *shared.row_key(text_col=text, names=shared.RESERVED)).join(spans, [*shared.RESERVED], "left").drop(*shared.RESERVED)
    schema = shared.widened(docs, f"n_bytes long, n_removed long, n_spans long, kept {'string' if decoded else 'binary'}")
    k = names.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                size_of, removed, runs, kept = [], [], [], []
                for x, found in zip(part.column(k).to_pylist(), part.column(len(names)).to_pylist(), strict=True):
                    data = (x or "").encode()
                    gone = merged([(p["s"], p["e"]) for p in found or ()])
                    if min_words:
                        gone = [g for g in gone if len(_WORD.findall(data, *g)) >= min_words]
                    edges = [0, *(y for p in gone for y in p), len(data)]
                    kept.append(b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
                    size_of.append(len(data))
                    removed.append(len(data) - len(kept[-1]))
                    runs.append(len(gone))
                left = pa.array([x.decode(errors="ignore") for x in kept], pa.string()) if decoded else pa.array(kept, pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *(pa.array(x, pa.int64()) for x in (size_of, removed, runs)), left], names=[*names, *ours])

    return joined.mapInArrow(shared.tidy(cut), schema)


def as_text(kept: str) -> Column:
    """A column of bytes as text; what is left of a character that was cut goes."""

    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda x: x.decode(errors="ignore"), na_action="ignore")

    return F.pandas_udf(decode, "string")(F.col(kept))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
