"""Audit of how far the sources of a language differ in the words they use.

Every (lang, source) group is a vector of smoothed shares over the language's
kept terms. Terms are dealt to blocks of bounded size, groups to seats. A seat's
vectors of a block stay in one partition; in each round of a round-robin
tournament the compressed vectors of its peer arrive there and both directions
of every meeting are evaluated. Sums over blocks give the divergence of two
groups, a heap in each group and block the terms that stand out.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

SCALE = 1_000_000_000  #: shares are whole numbers of so many parts
SMOOTH = 5  #: added to each count
LEAST_DOCS = 30  #: documents of its language that a term must be in
TERMS = 50  #: ranks of terms by group
SEATS = 8  #: that the groups of a language are dealt to
BLOCK_TERMS = 1 << 13  #: of a language in a block, about
BLOCK_ENTRIES = 1 << 21  #: counts of a seat in a block, about
#: Distinct terms that a task counts before it hands them on, and bytes of a text that it takes at a time.
COUNTED, SLICE = 1 << 18, 1 << 20
#: Languages and blocks to join by broadcast; with more of them Spark chooses.
FEW = 10_000

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")


def terms(text: str | None) -> Counter:
    """How often each term is in a text: runs of ASCII letters, lower-cased, and all else beyond ASCII, as UTF-8."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()  # of bytes only A-Z change
    out: Counter = Counter()
    at = 0
    while at < len(raw):
        cut = _BREAK.search(raw, at + SLICE) if len(raw) - at > SLICE else None
        end = cut.start() if cut else len(raw)
        out.update(_TERM.findall(raw, at, end))
        at = end
    return out


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, occurrences, in so many documents); a group's own row has no term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: defaultdict = defaultdict(Counter)
        having: defaultdict = defaultdict(Counter)  # documents

        def hand_on() -> Iterator[pa.RecordBatch]:
            rows: list[list] = [[], [], [], [], []]
            for (lang, source), own in found.items():
                of = having[lang, source]
                for column, values in zip(rows, ([lang] * (len(own) + 1), [source] * (len(own) + 1), [None, *(k.decode("utf-8", "replace") for k in own)], [0, *own.values()], [0, *(of[k] for k in own)]), strict=True):
                    column += values
            found.clear()
            having.clear()
            kinds = [pa.string()] * 3 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names=["lang", "source", "term", "n", "docs"])

        held = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                here = terms(text.as_py())
                own = found[lang, source]
                held -= len(own)
                own.update(here)
                having[lang, source].update(here.keys())
                held += len(own)
                if held > COUNTED:
                    yield from hand_on()
                    held = 0
        yield from hand_on()

    shared.small_batches(docs.sparkSession)
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    rows = docs.select(*blank).mapInArrow(shared.tidy(count), "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term in parts of SCALE, at least 1; exact."""
    wide = lambda x: x.cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", (wide(count) + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)"), wide(total) + wide(terms) * SMOOTH)


def _shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The same of counts in numpy, in digits to the base 1000, so that nothing overflows below 9e15."""
    rest, by, out = count.astype(np.int64) + SMOOTH, total + SMOOTH * terms, np.zeros(len(count), np.int64)
    if by >= 2**53:
        return np.array([1 + SCALE * int(x) // by for x in rest.tolist()], np.int64)
    out += rest // by
    for _ in range(3):
        rest = rest % by * 1000
        out = out * 1000 + rest // by
    return out + 1


def encode(ids: np.ndarray, shares: np.ndarray) -> bytes:
    """Ascending ids as gaps, and shares, compressed."""
    return zlib.compress(np.concatenate([np.diff(ids, prepend=0), shares]).astype("<u4").tobytes(), 1)


def decode(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(vector), "<u4").astype(np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


class Seat:
    """The vectors of a block that stay in a partition."""

    def __init__(self, rows: pa.Table):
        self.source, self.zero = rows.column("source").to_pylist(), np.array(rows.column("zero").to_pylist(), np.int64)
        parts = [decode(v.as_py()) for v in rows.column("vector")]
        self.size = np.array([len(ids) for ids, _ in parts])
        self.ids, self.share = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        self.owner = np.repeat(np.arange(len(parts)), self.size)

    def meet(self, ids: np.ndarray, shares: np.ndarray, zero: int, terms: int) -> np.ndarray:
        """Sum of absolute differences, over the block's ``terms``, of each own vector to the peer's."""
        # as if the own vectors were all zero counts ...
        order = np.sort(shares)
        below = np.append(0, np.cumsum(order))
        k = np.searchsorted(order, self.zero)
        out = self.zero * k - below[k] + below[-1] - below[k] - self.zero * (len(order) - k) + (terms - len(ids)) * np.abs(self.zero - zero)
        # ... and what their counts change
        at = np.searchsorted(ids, self.ids)
        has = at < len(ids)
        has[has] = ids[at[has]] == self.ids[has]
        theirs = np.full(len(self.ids), zero)
        theirs[has] = shares[at[has]]
        change = np.abs(self.share - theirs) - np.abs(self.zero[self.owner] - theirs)
        np.add.at(out, self.owner, change)
        return out


_MEETING = "lang string, source string, item string, value long"


def _met(lang: str, found: list[tuple]) -> pa.Table:
    source, item, value = ([x[k] for x in found] for k in range(3))
    return pa.table([pa.array([lang] * len(found), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])


def _at_home(rows: pa.Table) -> pa.Table:
    """Meetings within a seat."""
    seat, found = Seat(rows), []
    for i, (v, zero, terms) in enumerate(zip(rows.column("vector"), seat.zero.tolist(), rows.column("terms").to_pylist(), strict=True)):
        values = seat.meet(*decode(v.as_py()), zero, terms).tolist()
        found += [(seat.source[j], seat.source[i], values[j]) for j in range(len(values)) if j != i]
    return _met(rows.column("lang")[0].as_py(), found)


def _meetings(residents: pa.Table, peers: pa.Table) -> pa.Table:
    """Meetings of a seat with the peer that has come, in both directions."""
    found: list[tuple] = []
    if residents.num_rows and peers.num_rows:  # the other seat may be empty
        seat = Seat(residents)
        for source, v, zero, terms in zip(*(peers.column(c) for c in ("source_", "vector_", "zero_", "terms_")), strict=True):
            name = source.as_py()
            for own, value in zip(seat.source, seat.meet(*decode(v.as_py()), zero.as_py(), terms.as_py()).tolist(), strict=True):
                found += [(own, name, value), (name, own, value)]
    return _met(residents.column("lang")[0].as_py() if found else "", found)


def rounds(seats: int) -> list[dict[int, int]]:
    """A round-robin tournament: for each round, the seats that travel and where each goes; every two meet once."""
    n = seats + seats % 2
    out = []
    for r in range(n - 1):
        ring = [n - 1, *((r + k) % (n - 1) for k in range(n - 1))]
        pairs = [(ring[0], ring[1])] + [(ring[1 + k], ring[n - k]) for k in range(1, n // 2)]
        away = {}
        for a, b in pairs:
            a, b = sorted((a, b))
            if b < seats:
                # hosts take turns, so that every seat travels about as often as it stays
                away |= {a: b} if (a + b) % 2 else {b: a}
        out.append(away)
    return out


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TERMS, seats: int = SEATS, block_terms: int = BLOCK_TERMS, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """lang, source, part, item, value, rank: divergence of each group to the language's others, and its terms that stand out.

    A null text, lang or source counts as ''. Every occurring (lang, source) is a
    group, even without terms; the other columns are left out. Repeated rows are
    documents each. In a language without kept terms all pairs have 0; ties go to
    the smaller item in UTF-8. An empty table has no rows.
    """
    counts = shared.materialize(_counts(docs), "counts")
    worded = counts.where("term is not null")
    kept = worded.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"), F.count("*").alias("entries")).where(F.col("docs") >= least_docs)
    kept = shared.materialize(kept.drop("docs"), "kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("all_total"), F.sum("entries").alias("entries"))
    langs = counts.select("lang").distinct().join(langs, "lang", "left").na.fill(0)
    need = F.greatest(F.lit(1), F.ceil(F.col("v") / block_terms), F.ceil(F.col("entries") / (seats * block_entries)))
    langs = shared.materialize(langs.select("lang", "v", "all_total", need.cast("int").alias("blocks")), "langs")
    few = langs.count() <= FEW
    by_lang = F.broadcast(langs) if few else langs

    # terms have a place in a block
    place = Window.partitionBy("lang", "block").orderBy("term")
    placed = kept.join(by_lang.select("lang", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int"))
    placed = shared.materialize(placed.select("lang", "term", "all_n", "block", F.row_number().over(place).alias("id")), "places")
    sizes = placed.groupBy("lang", "block").agg(F.count("*").alias("terms"))

    # a row for each group and block, with the block's counts of the group
    entries = worded.select("lang", "source", "term", "n").join(placed, ["lang", "term"])
    packed = entries.groupBy("lang", "block", "source").agg(F.sum("n").alias("here"), F.array_sort(F.collect_list(F.struct("id", "n", "all_n", "term"))).alias("entries"))
    packed = shared.materialize(packed, "packed")
    totals = packed.groupBy("lang", "source").agg(F.sum("here").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(by_lang, "lang")
    blank = groups.select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), "v", "all_total", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    blank = blank.join(F.broadcast(sizes) if few and sizes.count() <= FEW else sizes, ["lang", "block"], "left")
    rows = blank.join(packed.drop("here"), ["lang", "block", "source"], "left").select(
        "lang", "source", "block", F.pmod(F.xxhash64("source"), F.lit(seats)).cast("int").alias("seat"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms"), "total", "v", "all_total", "entries"
    )

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zeros, vectors, tops = [], [], []
            for total, v, all_total, found in zip(*(b.column(b.schema.names.index(c)) for c in ("total", "v", "all_total", "entries")), strict=True):
                total, v, all_total = total.as_py(), v.as_py(), all_total.as_py()
                zeros.append(int(_shares(np.zeros(1, np.int64), total, v)[0]) if v else 0)
                e = found.values
                if e is None or not v:
                    vectors.append(encode(np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    tops.append([])
                    continue
                ids, n, all_n = (np.asarray(e.field(k)).astype(np.int64) for k in range(3))
                p = _shares(n, total, v)
                vectors.append(encode(ids, p))
                over = p - _shares(all_n, all_total, v)
                # the heap: largest value, then smallest term
                words, at = e.field(3), np.flatnonzero(over > 0)
                best = heapq.nsmallest(top, ((-x, words[i].as_py().encode()) for x, i in _candidates(over, at, top)))
                tops.append([{"item": w.decode(), "value": -x} for x, w in best])
            names = ["lang", "source", "block", "seat", "terms"]
            keep = [b.column(b.schema.names.index(c)) for c in names]
            kind = pa.list_(pa.struct([("item", pa.string()), ("value", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*keep, pa.array(zeros, pa.int64()), pa.array(vectors, pa.binary()), pa.array(tops, kind)], names=[*names, "zero", "vector", "top"])

    kind = "lang string, source string, block int, seat int, terms long, zero long, vector binary, top array<struct<item: string, value: long>>"
    ready = shared.materialize(rows.mapInArrow(shared.tidy(prepare), kind), "vectors")

    # residents are dealt once: all rounds read the same exchange
    key = ["lang", "block", "seat"]
    residents = ready.drop("top")
    met = [residents.groupBy(*key).applyInArrow(_at_home, _MEETING)]
    for away in rounds(seats):
        to = F.element_at(F.create_map(*[F.lit(x) for pair in away.items() for x in pair]), F.col("seat"))
        # columns of their own, or the two sides can't be told apart
        peers = residents.where(F.col("seat").isin(*away)).select(*[(to if c == "seat" else F.col(c)).alias(f"{c}_") for c in residents.columns])
        met.append(residents.groupBy(*key).cogroup(peers.groupBy(*[f"{c}_" for c in key])).applyInArrow(_meetings, _MEETING))
    pairs = met[0]
    for m in met[1:]:
        pairs = pairs.union(m)
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    out = ready.select("lang", "source", F.explode("top").alias("t")).select("lang", "source", F.lit("term").alias("part"), "t.item", "t.value")
    out = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(out)


def _candidates(value: np.ndarray, at: np.ndarray, top: int) -> Iterator[tuple[int, int]]:
    """(value, place) of those among ``at`` that reach the ``top``-th value."""
    if len(at) > top:
        at = at[value[at] >= np.partition(value[at], len(at) - top)[len(at) - top]]
    yield from zip(value[at].tolist(), at.tolist(), strict=True)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(shared.table(spark, sf_dir, "documents"))


OP13_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
words AS (SELECT d, lang, source, unnest(t) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY 1, 2 HAVING count(DISTINCT d) >= {LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY 1, 2, 3),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, sum(n) AS total FROM dense GROUP BY 1, 2),
shares AS (SELECT d.lang, d.source, d.term, d.n, 1 + ({SCALE}::HUGEINT * (d.n + {SMOOTH})) // (t.total + {SMOOTH} * l.v) AS p, 1 + ({SCALE}::HUGEINT * (d.all_n + {SMOOTH})) // (l.total + {SMOOTH} * l.v) AS q
  FROM dense d JOIN totals t ON t.lang = d.lang AND t.source = d.source JOIN langs l ON l.lang = d.lang),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN
  (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INT) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT), CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INT) AS rank FROM shares WHERE n > 0 AND p > q QUALIFY rank <= {TERMS}"""
