"""Packing of tokenized texts into sequences, next to texts they share words with.

Whole sequences are cut off long texts. The remainders are dealt to shards by
content: a tree of splits along the main directions of a bounded sample of
projected texts, cut where a shard is small enough, so that texts with the same
words share a shard wherever they stand in the input. A shard is indexed for
BM25, an inverted index over token ids with frequencies and lengths of the whole
corpus. Each remainder in turn is a seed, and the index returns its best unused
neighbours, which fill the seed's window; the last one is cut to fit. What is
left at a shard's end goes into sequences whose lengths are powers of two, so
nothing is padded. A shard has a fixed size, whatever the corpus.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared
from .bpe import read_added, read_ranks

WINDOW = 1024
END = 0  #: id that follows each document
#: A shard holds about so many remainders, or tokens of them, at most.
SHARD_ITEMS = 2048
SHARD_TOKENS = 1 << 21
SAMPLE = 16_384  #: remainders that fit the tree, about
PLANES = 32  #: dimensions that texts are projected to
DEPTH = 12  #: of the tree, at most
_K1, _B = 1.2, 0.75  # fixed values: usual BM25 parameters
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
_TOGETHER = 512  #: whole sequences that are written in one batch, at most


_AHEAD = r"\s+(?!\S)|"
_GAP = re.compile(r"\s\s")  # Python's white space is the pattern's and 1C to 1F
_LAST = re.compile(r"(?<=[^\S\x1C-\x1F])(?=[^\S\x1C-\x1F][\S\x1C-\x1F])")  # before the last character of white space that something follows


@functools.cache
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens=read_added(path))


@functools.cache
def _plain(path: str):
    """The encoder without the pattern's look ahead, for texts cut where that says something, and the added tokens, which it doesn't know."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN.replace(_AHEAD, ""), mergeable_ranks=read_ranks(path), special_tokens={}), list(read_added(path))


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, path: str) -> list[int]:
    """The ids of ``text`` under the tokenizer in ``path``, without special tokens.

    The faster encoder gives up on very long runs of white space; the tokenizer
    library itself then reads the text.
    """
    try:
        return _encoding(path).encode(text, allowed_special="all")
    except ValueError:
        return _tokenizer(path).encode(text, add_special_tokens=False).ids


def token_array(text: str, path: str) -> np.ndarray:
    """``token_ids`` as an array, without a Python object for each id.

    Matching without look ahead takes two thirds of the time, and finds the same in
    texts that are cut before the last of several characters of white space.
    """
    if not text:
        return np.zeros(0, np.uint32)
    plain, added = _plain(path)
    try:
        if any(x in text for x in added):
            return _encoding(path).encode_to_numpy(text, allowed_special="all")
        if not _GAP.search(text):
            return plain.encode_to_numpy(text)
        return np.concatenate([plain.encode_to_numpy(x) for x in _LAST.split(text)])
    except ValueError:
        return np.array(token_ids(text, path), np.uint32)


def _idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0)  # 0: a term of more than half the items says nothing


def _terms(items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, term and frequency of every term of every item, in this order."""
    both = np.repeat(np.arange(len(items), dtype=np.int64) << 32, [len(x) for x in items])
    if len(both):
        both |= np.concatenate(items)
    both.sort()
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
    tf = np.diff(np.append(first, len(both)))
    both = both[first]
    return both >> 32, both & 0xFFFFFFFF, tf


class Index:
    """BM25 over the remainders of a shard; terms are token ids.

    ``corpus`` has the idf of every term and the mean length, over more than these items.
    """

    def __init__(self, items: list[np.ndarray], corpus: tuple[np.ndarray, float] | None = None):
        n = self.n = len(items)
        length = np.array([len(x) for x in items])
        self.item, self.term, tf = _terms(items)
        size = int(self.term.max()) + 1
        idf, mean = corpus or (_idf(np.bincount(self.term, minlength=size), n), length.mean())
        weight = idf[self.term] * tf * (_K1 + 1) / (tf + _K1 * (1 - _B + _B * length[self.item] / mean))
        says = weight > 0
        self.item, self.term, weight = self.item[says], self.term[says], weight[says]
        self.first = np.searchsorted(self.item, np.arange(n + 1))
        order = np.argsort(self.term.astype(np.uint16) if size <= 1 << 16 else self.term, kind="stable")  # 16 bits are sorted by radix
        self.posting, self.weight = self.item[order], weight[order]
        del self.item
        self.df = np.bincount(self.term, minlength=size)
        self.at = np.cumsum(self.df) - self.df
        self.steps = np.arange(len(order))

    def keep(self, items: np.ndarray) -> None:
        """Only ``items`` (a boolean each) are scored from now on; any can be asked for."""
        stay = items[self.posting]
        before = np.append(0, np.cumsum(stay))
        self.posting, self.weight = self.posting[stay], self.weight[stay]
        self.at, self.df = before[self.at], before[self.at + self.df] - before[self.at]

    def scores(self, item: int) -> np.ndarray:
        terms = self.term[self.first[item] : self.first[item + 1]]
        count = self.df[terms]
        end = np.cumsum(count)
        step = np.repeat(self.at[terms] - (end - count), count)
        step += self.steps[: len(step)]
        return np.bincount(self.posting[step], self.weight[step], minlength=self.n)


def pack(docs: list[np.ndarray], window: int = WINDOW, corpus: tuple[np.ndarray, float] | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); every id lies in exactly one piece."""
    owner, start = [], []
    for d, ids in enumerate(docs):
        whole = len(ids) // window * window
        for at in range(0, whole, window):
            yield [(d, at, window)]
        if len(ids) > whole:
            owner.append(d)
            start.append(whole)
    if not owner:
        return
    index = Index([docs[d][s:] for d, s in zip(owner, start, strict=True)], corpus)
    n = len(owner)
    unused = np.ones(n, bool)
    nxt = 0  # items before it are used
    left = held = n  # unused, and those of the index
    for seed in range(n):
        if not unused[seed]:
            continue
        unused[seed] = False
        left -= 1
        if left < 0.875 * held:
            index.keep(unused)
            held = left
        d = owner[seed]
        pieces, room = [(d, start[seed], len(docs[d]) - start[seed])], window - len(docs[d]) + start[seed]
        ranked = _ranked(np.where(unused, index.scores(seed), 0.0))
        while room:
            i = next(ranked, None)
            if i is None:
                while nxt < n and not unused[nxt]:
                    nxt += 1
                if nxt == n:
                    break
                i = nxt  # no neighbour is left: the next unused one
            d = owner[i]
            size = len(docs[d]) - start[i]
            take = min(size, room)
            pieces.append((d, start[i], take))
            room -= take
            if take == size:
                unused[i] = False
                left -= 1
            else:
                start[i] += take
        if not room:
            yield pieces
            continue
        total = window - room
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                yield _cut(pieces, 1 << bit)


def _ranked(scores: np.ndarray, k: int = 64) -> Iterator[int]:
    """Items with a positive score, best first; ``k`` are ranked at a time. ``scores`` is changed."""
    while True:
        top = np.argpartition(-scores, k)[:k] if len(scores) > k else np.arange(len(scores))
        top = top[scores[top] > 0]
        if not len(top):
            return
        yield from top[np.lexsort((top, -scores[top]))].tolist()
        scores[top] = 0


def _cut(pieces: list[tuple[int, int, int]], size: int) -> list[tuple[int, int, int]]:
    """Takes ``size`` ids off the front of ``pieces``."""
    out = []
    while size:
        d, s, n = pieces.pop(0)
        take = min(n, size)
        out.append((d, s, take))
        size -= take
        if take < n:
            pieces.insert(0, (d, s + take, n - take))
    return out


@functools.cache
def _planes(terms: int) -> np.ndarray:
    return np.random.default_rng(3).standard_normal((terms, PLANES)).astype(np.float32)


def project(items: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit vectors that are close where texts share telling words; zero where no word tells."""
    plane, idf = _planes(len(idf)), idf.astype(np.float32)
    out = np.zeros((len(items), PLANES), np.float32)
    for lo in range(0, len(items), 64):
        item, term, tf = _terms(items[lo : lo + 64])
        if len(item):
            first = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
            says = np.sqrt(tf, dtype=np.float32) * idf[term]
            out[lo + item[first]] = np.add.reduceat(plane[term] * says[:, None], first)
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)


def tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and thresholds of a binary tree, node i over 2i+1 and 2i+2.

    A node is split along its main direction, at the widest gap near the median;
    one that can't be split sends everything left.
    """
    way, cut = np.zeros((2**depth - 1, PLANES), np.float32), np.full(2**depth - 1, np.inf)
    rows = {0: np.arange(len(sample))}
    for i in range(2**depth - 1):
        at = rows.pop(i, None)
        if at is None or len(at) < 4:
            continue
        x = sample[at].astype(float)
        way[i] = np.linalg.eigh(np.cov(x.T))[1][:, -1]
        along = (sample[at] * way[i]).sum(1)
        order = np.sort(along)
        gaps = np.diff(order)
        lo, hi = int(0.4 * len(gaps)), int(0.6 * len(gaps)) + 1
        j = lo + int(np.argmax(gaps[lo:hi]))
        if gaps[j] <= 1e-6:  # copies; the widest gap anywhere
            j = int(np.argmax(gaps))
        if gaps[j] <= 1e-6:
            continue
        cut[i] = (order[j] + order[j + 1]) / 2
        rows[2 * i + 1], rows[2 * i + 2] = at[along <= cut[i]], at[along > cut[i]]
    return way, cut


def leaves(vectors: np.ndarray, way: np.ndarray, cut: np.ndarray) -> np.ndarray:
    at = np.zeros(len(vectors), np.int64)
    while len(at) and at[0] < len(cut):
        at = 2 * at + 1 + ((vectors * way[at]).sum(1) > cut[at])
    return at - len(cut)


def deal(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each leaf, and how many its rows are dealt to. ``sizes``: items and tokens by leaf.

    Leaves below one node share a shard where they fit.
    """
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, todo = 0, [(0, len(sizes))]
    while todo:
        lo, hi = todo.pop()
        items, tokens = sizes[lo:hi].sum(0).tolist()
        need = max(1, -(-items // SHARD_ITEMS), -(-tokens // SHARD_TOKENS))
        if need > 1 and hi - lo > 1:
            todo += [((lo + hi) // 2, hi), (lo, (lo + hi) // 2)]
            continue
        first[lo:hi], parts[lo:hi] = shard, need
        shard += need
    return first, parts


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The pieces of SCHEMA; ``ids`` holds a piece's ids, 4 bytes each, little-endian.

    A document is its ids under the tokenizer in ``path`` (a file that every
    worker can read; its added tokens are matched in texts, none is added), then
    id 0. Null and empty texts are that id alone. Repeated rows are packed each; a null doc_id stays
    null. Other columns are left out. Which pieces share a sequence depends on
    the rows, not on their order or partitions.
    """
    spark = docs.sparkSession
    shared.small_batches(spark)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(np.uint16 if _encoding(path).max_token_value < 1 << 16 else np.uint32)
        for b in batches:
            total, whole, rest = [], [], []
            for x in b.column(1):
                got = token_array(x.as_py() or "", path)
                ids = np.full(len(got) + 1, END, kind)
                ids[:-1] = got
                cut = len(ids) // window * window
                total.append(len(ids))
                whole.append(ids[:cut].tobytes())
                rest.append(ids[cut:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(total, pa.int64()), pa.array([kind.itemsize] * len(total), pa.int32()), pa.array(whole, pa.binary()), pa.array(rest, pa.binary())],
                names=["doc_id", "doc_tokens", "width", "whole", "rest"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string"))
    table = shared.materialize(source.mapInArrow(shared.tidy(encoded), "doc_id long, doc_tokens long, width int, whole binary, rest binary"), "encoded")
    key = F.xxhash64(F.coalesce("doc_id", F.lit(-(2**63)).cast("long")), "rest", "doc_tokens").alias("h")
    rests = table.where(F.length("rest") > 0).select("doc_id", "doc_tokens", "width", "rest", key)

    def read(rows: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x.as_py(), f"<u{w.as_py()}") for x, w in zip(rows.column("rest"), rows.column("width"), strict=True)]

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, tokens = np.zeros(1, np.int64), 0, 0
        for b in batches:
            _, terms, tf = _terms(read(b))
            more = np.bincount(terms)
            if len(more) > len(df):
                df, more = more, df
            df[: len(more)] += more
            n, tokens = n + b.num_rows, tokens + int(tf.sum())
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *terms.tolist()], pa.int64()), pa.array([n, tokens, *df[terms].tolist()], pa.int64())], names=["term", "n"])

    # as many rows as the tokenizer has ids; toLocalIterator would run a job a partition, here and below
    df = {r["term"]: r["n"] for r in rests.mapInArrow(shared.tidy(counts), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, tokens = df.pop(-1, 0), df.pop(-2, 0)
    frequency = np.zeros(max(df, default=0) + 1, np.int64)
    frequency[list(df)] = list(df.values())
    corpus = spark.sparkContext.broadcast((_idf(frequency, n), tokens / max(n, 1)))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = project(read(b), corpus.value[0])
            yield pa.RecordBatch.from_arrays([b.column(b.schema.names.index("h")), pa.array(list(v), pa.list_(pa.float32()))], names=["h", "v"])

    depth = min(DEPTH, max(0, (max(n // SHARD_ITEMS, tokens // SHARD_TOKENS)).bit_length() + 2)) if n > SHARD_ITEMS or tokens > SHARD_TOKENS else 0
    sample = np.zeros((0, PLANES), np.float32)
    if depth:
        # the same rows each time: those with a small hash, equal ones once
        some = rests.where(F.pmod("h", F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))).dropDuplicates(["h"])
        got = sorted((r["h"], r["v"]) for r in some.mapInArrow(shared.tidy(projected), "h long, v array<float>").collect())
        sample = np.array([v for _, v in got], np.float32).reshape(-1, PLANES)
    nodes = spark.sparkContext.broadcast(tree(sample, depth))

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = read(b)
            at = leaves(project(items, corpus.value[0]), *nodes.value) if depth else np.zeros(len(items), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at), pa.array([len(x) for x in items], pa.int64())], names=[*b.schema.names, "leaf", "n"])

    kind = "doc_id long, doc_tokens long, width int, rest binary, h long, leaf long, n long"
    placed = shared.materialize(rests.mapInArrow(shared.tidy(leaf), kind), "placed")
    sizes = np.zeros((2**depth, 2), np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("items"), F.sum("n").alias("tokens")).collect():
        sizes[r["leaf"]] = r["items"], r["tokens"]
    first, parts = deal(sizes)
    at = lambda x: F.element_at(F.lit(x.tolist()), (F.col("leaf") + 1).cast("int"))
    dealt = placed.withColumn("shard", at(first) + F.pmod("h", at(parts)))

    def shard(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("leaf", "ascending"), ("h", "ascending")])
        items = read(rows)
        ids, total = rows.column("doc_id").to_pylist(), rows.column("doc_tokens").to_pylist()
        sequence = rows.column("shard")[0].as_py() << 40
        out = []
        for pieces in pack(items, window, corpus.value):
            offset = 0
            for d, s, n in pieces:
                out.append((ids[d], total[d] - len(items[d]) + s, n, total[d], sequence, offset, items[d][s : s + n].astype("<u4").tobytes()))
                offset += n
            sequence += 1
        found = _pieces(out)
        shared.release()
        return found

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sequences(batches, window, (1 << 62) + (TaskContext.get().partitionId() << 40))  # beyond those of shards

    cut = table.where(F.length("whole") > 0).select("doc_id", "doc_tokens", "width", "whole").mapInArrow(shared.tidy(whole), SCHEMA)
    return cut.union(dealt.groupBy("shard").applyInArrow(shard, SCHEMA))


def _sequences(batches: Iterator[pa.RecordBatch], window: int, sequence: int) -> Iterator[pa.RecordBatch]:
    """SCHEMA of whole sequences, numbered from ``sequence``; those of many documents go in one batch."""
    for b in batches:
        for i, j, raw, offs in shared.byte_chunks(b.column("whole")):
            width = b.column("width")[i].as_py()  # of all rows: the tokenizer's
            many = np.diff(offs) // (width * window)
            of = np.repeat(np.arange(i, j), many)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)) * window
            for lo in range(0, len(of), _TOGETHER):
                n = min(_TOGETHER, len(of) - lo)
                rows = pa.array(of[lo : lo + n])
                ids = raw[lo * width * window : (lo + n) * width * window].view(f"<u{width}").astype("<u4")
                ends = np.arange(n + 1, dtype=np.int32) * (4 * window)
                numbers = [pa.array(x, pa.int64()) for x in (start[lo : lo + n], np.full(n, window), np.arange(sequence, sequence + n), np.zeros(n, np.int64))]
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(rows), *numbers[:2], b.column("doc_tokens").take(rows), *numbers[2:], binary], names=_NAMES)
                sequence += n


def _pieces(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True))
    return pa.table([pa.array(c, pa.binary() if k == "ids" else pa.int64()) for k, c in zip(_NAMES, columns, strict=True)], names=_NAMES)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(pack_documents(shared.table(spark, sf_dir, "documents"), path or tokenizer_path()))
