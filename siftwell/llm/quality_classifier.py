"""A quality classifier that learns from trusted positives and unlabelled text.

Each text becomes a bounded vector: how classes of bytes follow each other, how
words look, how much repeats. A small network learns from documents labelled as
good and from unlabelled ones, never from a label that says bad: it minimises
the non-negative unbiased risk, in which the share of good documents among the
unlabelled stands in for the missing negatives. That share is estimated, by the
best bin of a classifier that tells positives from unlabelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared


@dataclass(frozen=True)
class Settings:
    sample: int = 16_384  #: positives, and unlabelled documents, that fit the model, at most (unlabelled: about)
    hidden: int = 32
    steps: int = 1500
    batch: int = 1024
    rate: float = 0.005
    decay: float = 1e-3  #: of weights
    threshold: float = 0.7
    seed: int = 5


# --- features --------------------------------------------------------------------

_KINDS = {
    "space": b" \t\x0b\x0c\r", "line": b"\n", "digit": b"0123456789", "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)),
    "stop": b".?!", "pause": b",;:", "quote": b"'\"()-", "symbol": b"#*$%&|<>@^~=+_/\\[]{}`",
}
_CLASS = np.full(256, len(_KINDS), np.uint8)  # controls
for _i, _bytes in enumerate(_KINDS.values()):
    _CLASS[list(_bytes)] = _i
_CLASS[128:192] = len(_KINDS) + 1  # inside a character beyond ASCII
_CLASS[192:] = len(_KINDS) + 2
CLASSES = len(_KINDS) + 3
_K = list(_KINDS)
_LETTER = np.isin(_CLASS, [_K.index("lower"), _K.index("upper"), CLASSES - 2, CLASSES - 1])
_STATS = 14
WIDTH = CLASSES * CLASSES + _STATS


def _by_text(first: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text's words; ``first`` are the words' bounds."""
    total = np.append(0, np.cumsum(flags))
    return (total[first[1:]] - total[first[:-1]]).astype(float)


def _again(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: share of keys that occurred before in it, share of its most frequent key."""
    n = len(first) - 1
    count = np.diff(first).astype(float)
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    # one sort of (text, 44 bits of the key); a run has under 2**20 texts
    both = np.sort((owner << np.uint64(44)) | (keys >> np.uint64(20)))
    new = np.append(True, both[1:] != both[:-1])
    at = (both[new] >> np.uint64(44)).astype(np.int64)
    run = np.diff(np.append(np.flatnonzero(new), len(both)))
    most = np.zeros(n)
    head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    most[at[head]] = np.maximum.reduceat(run, head)
    distinct = np.bincount(at, minlength=n)
    some = np.maximum(count, 1)
    return np.where(count > 0, 1 - distinct / some, 0), most / some


def features(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A row of WIDTH numbers for each text of a run of texts."""
    n, size = len(offs) - 1, np.diff(offs)
    out = np.zeros((n, WIDTH))
    kind = _CLASS[raw]
    # pairs of bytes within a text, a slice at a time
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    pairs = np.zeros(n * CLASSES**2, np.int64)
    for at in range(0, len(raw) - 1, shared.CHUNK):
        left, right = (slice(at + k, min(at + shared.CHUNK + k, len(raw) - 1 + k)) for k in (0, 1))
        pair = (owner[left].astype(np.int64) * CLASSES + kind[left]) * CLASSES + kind[right]
        pairs += np.bincount(pair[owner[left] == owner[right]], minlength=len(pairs))
    out[:, : CLASSES**2] = np.sqrt(pairs.reshape(n, -1) / np.maximum(size - 1, 1)[:, None])
    starts, ends, first = shared.word_spans(raw, offs)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    length = ends - starts
    lower = shared.SpanHash(raw, shared.LOWER_BYTE).of(starts, ends)
    # white space is none of these, so a sum to the next word is the word's
    within = lambda flag: np.add.reduceat(flag, starts, dtype=np.int32) if len(starts) else np.zeros(0, np.int32)
    letters, upper, symbol = within(_LETTER[raw]), within(kind == _K.index("upper")), within(kind == _K.index("symbol"))
    owner = np.repeat(np.arange(n), np.diff(first))
    same = np.zeros(len(lower), bool)
    same[1:] = (lower[1:] == lower[:-1]) & (owner[1:] == owner[:-1])
    stats = [np.log1p(words), _by_text(first, length) / some, np.sqrt(_by_text(first, length.astype(float) ** 2) / some), _by_text(first, same) / some]
    stats += [_by_text(first, x) / some for x in (letters == 0, upper == length, (upper > 1) & (letters == upper), symbol > 0, kind[ends - 1] == _K.index("stop"))]
    repeat, most = _again(lower, first)
    stats += [repeat / np.sqrt(np.log(some + 1) + 1), most]
    eight = shared.window_hashes(lower, 8)
    # windows within a text
    whole = np.flatnonzero(owner[: len(eight)] == owner[7 : 7 + len(eight)]) if len(eight) else np.zeros(0, np.int64)
    stats += [_again(eight[whole], np.searchsorted(owner[whole], np.arange(n + 1)))[0]]
    lines = _by_text(np.searchsorted(np.flatnonzero(raw == 10), offs), np.ones(int((raw == 10).sum()))) + 1
    stats += [np.log1p(words / lines), (size == 0).astype(float)]
    out[:, CLASSES**2 :] = np.array(stats).T
    return out


# --- the model ---------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Summed term by term: matrix products add in an order that depends on the rows beside, so equal texts could differ in the last digit."""
        w, b, v, c = self.layers
        x, inner, z = self.scaled(x), np.tile(b, (len(x), 1)), np.full(len(x), c[0])
        for k in range(len(w)):
            inner += x[:, k, None] * w[k]
        h = np.tanh(inner)
        for k in range(len(v)):
            z += h[:, k] * v[k]
        return _sigmoid(z)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -6, 6)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _forward(layers, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, b, v, c = layers
    h = np.tanh(x @ w + b)
    return h, h @ v + c[0]


def _backward(layers, x: np.ndarray, h: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
    """Gradients, given the loss's slope by output."""
    inner = slope[:, None] * layers[2] * (1 - h * h)
    return [x.T @ inner, inner.sum(0), h.T @ slope, np.array([slope.sum()])]


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, s: Settings) -> tuple[np.ndarray, ...]:
    """Weights that minimise the non-negative risk for ``prior``, or, without one, that tell positives from unlabelled.

    With the logistic loss l: risk = prior * mean l(+, positives) + max(0, mean l(-, unlabelled) - prior * mean l(-, positives)).
    Where the second part is negative, a step goes against it instead.
    """
    rng = np.random.default_rng(s.seed)
    width = positive.shape[1]
    layers = [rng.standard_normal((width, s.hidden)) / np.sqrt(width), np.zeros(s.hidden), rng.standard_normal(s.hidden) / np.sqrt(s.hidden), np.zeros(1)]
    moment, square = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, s.steps + 1):
        p, u = (x[rng.integers(0, len(x), min(s.batch, len(x)))] for x in (positive, unlabelled))
        (hp, zp), (hu, zu) = _forward(layers, p), _forward(layers, u)
        # slopes of l(+) and l(-) by the output
        plus_p, minus_p, minus_u = -_sigmoid(-zp) / len(p), _sigmoid(zp) / len(p), _sigmoid(zu) / len(u)
        if prior is None:
            grad = [a + b for a, b in zip(_backward(layers, p, hp, plus_p), _backward(layers, u, hu, minus_u), strict=True)]
        else:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                grad = [a + b for a, b in zip(_backward(layers, p, hp, prior * (plus_p - minus_p)), _backward(layers, u, hu, minus_u), strict=True)]
            else:
                grad = [a + b for a, b in zip(_backward(layers, p, hp, prior * minus_p), _backward(layers, u, hu, -minus_u), strict=True)]
        rate = s.rate * min(1.0, 2 * (1 - step / (s.steps + 1)))
        for k, g in enumerate(grad):
            if layers[k].ndim:
                g = g + s.decay * layers[k]
            moment[k] = 0.9 * moment[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            layers[k] = layers[k] - rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of held-out rows of both.

    Above a good threshold there are positives only, so the quotient of what
    lies above it is the share; the threshold is the one whose quotient has the
    least upper bound.
    """
    if not len(positive) or not len(unlabelled):
        return 1.0
    cut = np.unique(positive)
    up = 1 - np.searchsorted(np.sort(positive), cut) / len(positive)
    uu = 1 - np.searchsorted(np.sort(unlabelled), cut) / len(unlabelled)
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = np.argmin((uu + slack) / np.maximum(up, 1e-9))
    return float(np.clip(uu[best] / up[best], 0.01, 0.99))


# --- fitting and scoring -------------------------------------------------------------


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a document's label is never learned from; a null id isn't held out, and has no label."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _measured(rows: DataFrame, text: str, kept: list[str]) -> DataFrame:
    """``kept`` columns of the rows, and the features of ``text`` as bytes of floats."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, raw, offs in shared.text_chunks(b.column(0)):
                x = features(raw, offs).astype("<f4")
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[1:]), pa.array([r.tobytes() for r in x], pa.binary())], names=[*kept, "x"])

    found = rows.select(F.col(text).cast("string"), *kept)
    return found.mapInArrow(shared.tidy(measure), shared.widened(found.drop(text), "x binary"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model | None:
    """The model, or None where no document is labelled as good.

    Positives are the ``sample`` labelled documents with the smallest hashes,
    unlabelled ones about as many of all documents that aren't held out. An id
    that labels state twice is good only if all say so; an id that several texts
    have is the one with the smallest hash. The prior is the smaller of two
    estimates, the best bin and the share of good labels: one too large hides bad
    documents, one a little too small costs less.
    """
    s = settings
    shared.small_batches(docs.sparkSession)
    lots = F.xxhash64("doc_id", F.lit(s.seed))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    stated = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    # a bounded sample of ids
    good = known.where("quality = 1").select("doc_id").orderBy(lots, "doc_id").limit(s.sample).withColumn("good", F.lit(True))
    share = min(1.0, s.sample / max(1, docs.count()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull() & ~held_out()).join(F.broadcast(good), "doc_id", "left")
    rows = rows.select("text", "doc_id", F.coalesce("good", F.lit(False)).alias("good"), (F.pmod(lots, F.lit(1 << 30)) < int(share * (1 << 30))).alias("any"), F.xxhash64("text").alias("h")).where("good or any")
    found = _measured(rows, "text", ["doc_id", "good", "any", "h"]).groupBy("doc_id").agg(F.min_by(F.struct("good", "any", "x"), "h").alias("r")).select("doc_id", "r.*")
    sample = sorted(found.toLocalIterator(), key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], "<f4") for r in sample], float).reshape(-1, WIDTH)
    is_good, is_any = (np.array([r[c] for r in sample], bool) for c in ("good", "any"))
    if not is_good.any():
        return None
    base = x[is_any] if is_any.any() else x
    model = Model(base.mean(0), np.maximum(base.std(0), 1e-3), (), 1.0)
    positive, unlabelled = model.scaled(x[is_good]), model.scaled(base)
    # half of both tells them apart, the other half estimates
    tell = _fit(positive[::2], unlabelled[::2], None, s)
    prior = estimated_prior(*(_sigmoid(_forward(tell, part[1::2])[1]) for part in (positive, unlabelled)))
    if len(stated) > 1:
        prior = min(prior, stated[1] / sum(stated.values()))
    return Model(model.mean, model.spread, _fit(positive, unlabelled, prior, s), prior)


def score(docs: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, by its whole text; a null text is empty.

    Without a model every score is 0.5. Repeated rows and ids are scored each, a
    null id stays null, other columns are left out.
    """
    spark = docs.sparkSession
    shared.small_batches(spark)
    shipped = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, raw, offs in shared.text_chunks(b.column(1)):
                z = shipped.value.scores(features(raw, offs).astype("<f4").astype(float)) if shipped.value else np.full(j - i, 0.5)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(z, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(shared.tidy(judge), "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    return score(docs, fit(docs, shared.table(spark, sf_dir, "labels")))
