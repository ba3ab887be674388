"""Byte-level BPE: encoding in two tiers, and decoding.

A text is split into pre-tokens in numpy, on code points. Each pre-token's hash
goes to a minimal perfect hash over the vocabulary, which resolves those that
are whole vocabulary entries. The others are merged once each, with a heap over
a linked list of bytes, and remembered.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

#: Ids that are decoded in one go.
DECODED = 1 << 17
#: Merged pre-tokens that a worker remembers; after that it starts afresh.
REMEMBERED = 1 << 19
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@functools.cache
def _char_class() -> np.ndarray:
    """The class of every code point: white space, \\p{L}, \\p{N} or else."""
    out = np.full(0x110000, _OTHER, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for c in range(0x110000):
        k = kinds.get(unicodedata.category(chr(c))[0])
        if k is not None:
            out[c] = k
    # fixed values: the Unicode property White_Space
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


def pretokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the pre-tokens, and the first one of each text.

    Equals all matches of ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`` in each text.
    """
    n_bytes = len(raw)
    if not n_bytes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    at_byte = np.flatnonzero((raw & 0xC0) != 0x80)
    chars = raw if len(at_byte) == n_bytes else np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(chars)
    kind = _char_class()[chars]
    fresh = np.zeros(n + 1, bool)  # the first code point of a text, and the end
    fresh[np.searchsorted(at_byte, offs)] = True
    fresh[n] = True
    run = np.empty(n, bool)
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= fresh[:n]
    begin = run.copy()
    after = np.flatnonzero(run[1:] & ~fresh[1:n] & (kind[:-1] == _SPACE)) + 1  # a run that follows white space in its text
    begin[after - 1] = True
    begin[after] = chars[after - 1] != 0x20

    # contractions: a lone apostrophe that starts a pre-token, then letters
    quote = np.flatnonzero((chars == 0x27) & begin)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == _LETTER) & ~fresh[quote + 1]]
    if len(quote):
        one = chars[quote + 1]
        two = np.where((quote + 2 < n) & ~fresh[np.minimum(quote + 2, n)], chars[np.minimum(quote + 2, n - 1)], 0)
        single = np.isin(one, [ord(x) for x in "stmd"])
        double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        size = np.where(single, 1, np.where(double, 2, 0))
        quote, size = quote[size > 0], size[size > 0]
        begin[quote + 1] = False
        rest = quote + 1 + size
        begin[rest[rest < n]] = True
    starts = at_byte[begin]
    return starts, np.append(starts[1:], n_bytes), np.searchsorted(starts, offs)


class PerfectHash:
    """Minimal perfect hash (hash and displace) of distinct 64-bit keys."""

    def __init__(self, keys: np.ndarray):
        n = self.n = len(keys)
        self.buckets = max(1, n // 4)
        of = (keys % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        cut = np.searchsorted(of[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        slot_of = np.zeros(n, np.int64)
        taken = np.zeros(n, bool)
        sizes = np.diff(cut)
        for size in range(int(sizes.max(initial=0)), 1, -1):
            left = np.flatnonzero(sizes == size)
            d = 0
            while len(left):  # all buckets of a size try a shift; those that fit, in order, take it
                mine = order[cut[left][:, None] + np.arange(size)]
                slots = self._slot(keys[mine], d)
                flat = slots.ravel()
                one = np.full(n, len(flat))
                np.minimum.at(one, flat, np.arange(len(flat)))
                fits = ((one[flat] == np.arange(len(flat))) & ~taken[flat]).reshape(slots.shape).all(axis=1)
                self.shift[left[fits]] = d
                slot_of[mine[fits]] = slots[fits]
                taken[slots[fits]] = True
                left = left[~fits]
                d += 1
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(sizes == 1).tolist():  # one key: its slot is stored as such
            slot = next(free)
            self.shift[b], slot_of[order[cut[b]]] = -slot - 1, slot
        self.entry = np.zeros(n, np.int64)  # slot -> index of its key
        self.entry[slot_of] = np.arange(n)
        self.keys = keys[self.entry]

    def _slot(self, keys: np.ndarray, d) -> np.ndarray:
        d = np.asarray(d, np.int64).astype(np.uint64)
        return (shared.mix(keys + d * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, or -1."""
        if not self.n:
            return np.full(len(keys), -1)
        d = self.shift[(keys % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, self._slot(keys, np.maximum(d, 0)))
        return np.where(self.keys[slot] == keys, self.entry[slot], -1)


def _same_bytes(raw: np.ndarray, start: np.ndarray, other: np.ndarray, other_start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether spans of two byte strings, each pair of one length, are equal; eight bytes at a time."""
    words = [np.ndarray(len(x) + 1, "<u8", buffer=np.concatenate([x, np.zeros(9, np.uint8)]).tobytes(), strides=(1,)) for x in (raw, other)]
    mask = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)
    same = np.ones(len(start), bool)
    at, done = np.arange(len(start)), 0
    while len(at):
        differ = (words[0][start[at] + done] ^ words[1][other_start[at] + done]) & mask[np.minimum(length[at] - done, 8)]
        same[at[differ != 0]] = False
        done += 8
        at = at[(differ == 0) & (length[at] > done)]
    return same


def _spans_hash(parts: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(x) for x in parts])
    return shared.SpanHash(np.frombuffer(b"".join(parts), np.uint8)).of(ends - [len(x) for x in parts], ends)


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.token = [b""] * size
        for k, v in ranks.items():
            self.token[v] = k
        entries = list(ranks)
        self.ids = np.array([ranks[x] for x in entries], np.int32)
        self.table = PerfectHash(_spans_hash(entries))
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(x) for x in entries])
        self.start = np.cumsum(self.size) - self.size
        at = np.cumsum([0, *map(len, self.token)])
        self.text, self.text_start, self.text_size = np.frombuffer(b"".join(self.token), np.uint8), at[:-1], np.diff(at)  # by id
        self.memo: dict[bytes, bytes] = {}  # pre-token -> its ids, 4 bytes each

    def merge(self, piece: bytes) -> list[int]:
        """BPE of one pre-token: lowest rank first, then leftmost."""
        n, ranks = len(piece), self.ranks
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or after[j] != end:
                continue  # one of the two has been merged since
            live[j] = False
            after[i] = end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : after[end]])) is not None:
                    heapq.heappush(heap, (r, i, after[end]))
            if (p := before[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
                heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out

    def encode(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        starts, ends, first = pretokens(raw, offs)
        keys = shared.SpanHash(raw).of(starts, ends)
        at = self.table.find(keys)
        # a hash that is in the table may still be another pre-token's: the bytes decide
        hit = np.flatnonzero(at >= 0)
        found, size = at[hit], ends[hit] - starts[hit]
        fits = size == self.size[found]
        fits[fits] = _same_bytes(raw, starts[hit][fits], self.bytes, self.start[found][fits], size[fits])
        at[hit[~fits]] = -1
        miss = np.flatnonzero(at < 0)
        if not len(miss):
            return self.ids[at], first
        distinct, one, where = np.unique(keys[miss], return_index=True, return_inverse=True)
        if len(self.memo) > REMEMBERED:
            self.memo.clear()
        memo, data = self.memo, raw.tobytes()
        # pre-tokens of one hash are merged once, if their bytes are the same
        like = miss[one][where]
        size = ends[miss] - starts[miss]
        same = size == ends[like] - starts[like]
        same[same] = _same_bytes(raw, starts[miss][same], raw, starts[like][same], size[same])
        odd = np.flatnonzero(~same)
        where[odd] = len(distinct) + np.arange(len(odd))
        each = np.concatenate([miss[one], miss[odd]])
        merged = []
        for a, b in zip(starts[each].tolist(), ends[each].tolist(), strict=True):
            piece = data[a:b]
            got = memo.get(piece)
            if got is None:
                got = memo[piece] = array("i", self.merge(piece)).tobytes()
            merged.append(got)
        length = np.array([len(x) for x in merged]) >> 2
        begin = np.cumsum(length) - length
        flat = np.frombuffer(b"".join(merged), np.int32)
        count = np.ones(len(at), np.int64)
        count[miss] = length[where]
        to = np.zeros(len(at) + 1, np.int64)
        np.cumsum(count, out=to[1:])
        out = np.empty(to[-1], np.int32)
        hit = at >= 0
        out[to[:-1][hit]] = self.ids[at[hit]]
        n = length[where]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[:-1][miss], n) + step] = flat[np.repeat(begin[where], n) + step]
        return out, to[first]

    def decode(self, ids: list[int]) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])

    def decode_lists(self, column: pa.ListArray) -> Iterator[pa.BinaryArray]:
        """``decode`` of each list of ids (null: no bytes), run by run of lists, without a Python object for each id."""
        ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(), dtype=np.int64)
        ids = column.flatten().to_numpy()  # raises where an id is null
        i, done = 0, 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(ends, done + DECODED, side="right")))
            run = ids[done : ends[j - 1]]
            offs = np.append(0, np.cumsum(self.text_size[run]))[np.append(done, ends[i:j]) - done]
            data = np.concatenate([np.zeros(0, np.uint8), *(self._bytes(run[k : k + DECODED]) for k in range(0, len(run), DECODED))])  # one list can be longer
            yield pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(data)])
            i, done = j, int(ends[j - 1])

    def _bytes(self, ids: np.ndarray) -> np.ndarray:
        size = self.text_size[ids]
        step = np.repeat(self.text_start[ids] - (np.cumsum(size) - size), size)
        step += np.arange(len(step))
        return self.text[step]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id from a ``.tiktoken`` file or a ``.json`` tokenizer file, without special tokens."""
    with open(path, "rb") as f:
        data = f.read()
    if not path.endswith(".json"):
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    found = json.loads(data)
    special = {x["content"] for x in found.get("added_tokens", [])}
    # the printable stand-ins of byte-level BPE: a byte's own character, or the next one from U+0100
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(x for x in range(256) if x not in plain)}
    return {bytes(byte[c] for c in k): v for k, v in found["model"]["vocab"].items() if k not in special}


def read_added(path: str) -> dict[str, int]:
    """Added tokens of a ``.json`` tokenizer file -> id."""
    if not path.endswith(".json"):
        return {}
    with open(path, "rb") as f:
        return {x["content"]: x["id"] for x in json.load(f).get("added_tokens", [])}


@functools.cache
def load(path: str) -> Codec:
    return Codec(read_ranks(path))


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids``: array of int.

    ``path`` is a vocabulary file that every worker can read. Null and empty
    texts get no ids; a text's whole length is encoded; special tokens do not
    exist. A column of ``docs`` named like ``ids`` is replaced; the others and
    repeated rows pass through.
    """
    names = [c for c in docs.columns if c != ids]
    shared.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        for b in batches:
            k = names.index(text)
            for i, j, raw, offs in shared.text_chunks(b.column(k)):
                got, first = codec.encode(raw, offs)
                column = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(got))
                yield pa.RecordBatch.from_arrays([c.slice(i, j - i) for c in b.columns] + [column], names=[*names, ids])

    frame = docs.select(*[f"`{c}`" for c in names])
    return frame.mapInArrow(shared.tidy(run), _with(frame.schema, ids, T.ArrayType(T.IntegerType())))


def decode(coded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the column ``out``: the bytes that the ids stand for (null: none)."""
    names = [c for c in coded.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(path)
        for b in batches:
            at = 0
            for got in codec.decode_lists(b.column(names.index(ids))):
                yield pa.RecordBatch.from_arrays([*(c.slice(at, len(got)) for c in b.columns), got], names=[*names, out])
                at += len(got)

    frame = coded.select(*[f"`{c}`" for c in names])
    return frame.mapInArrow(shared.tidy(run), _with(frame.schema, out, T.BinaryType()))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(shared.table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
