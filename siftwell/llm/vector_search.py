"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are rotated at random and dealt to the lists of a coarse quantiser,
whose number grows with the square root of the rows. A query probes its nearest
lists, a share of all that falls as the table grows. Within them, candidates
are compared a block of rotated dimensions at a time: a partial distance is an
unbiased estimate of the whole one, so a hypothesis test against the query's
tenth distance so far gives most candidates up early. Scores are then computed
on the original vectors.

Nearby lists share a tile of bounded numbers of vectors and queries. A query
goes to the tile of its nearest list first; the tenth distance found there goes
along to its other tiles, and within a tile from run to run.
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
    neighbours: int = 10
    lists: float = 4.0  #: coarse lists, times the square root of the rows
    most_lists: int = 2048  #: what the sample can fit; beyond it lists grow longer
    probes: float = 1.65  #: share of the lists that a query looks into, times the eighth root of the rows
    sample: int = 20_000  #: vectors that fit the quantiser, at most
    block: int = 16  #: dimensions compared at a time
    slack: float = 2.1  #: of the test, in standard errors: larger keeps more candidates
    tile: int = 8192  #: vectors scanned by one task
    queries: int = 8192  #: queries that a tile serves at a time
    run: int = 2048  #: vectors that a query is compared with before its limit is set anew
    seed: int = 11


def usable(vector: str) -> F.Column:
    """Not null, not zero, all components finite numbers."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(good, F.lit(False)) & F.exists(v, lambda x: x != 0)


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """A few rounds of k-means over distinct sample vectors."""
    sample = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    centre = sample[rng.permutation(len(sample))[: min(lists, len(sample))]].copy()
    for _ in range(8):
        near = _nearest(sample, centre, 1)[:, 0]
        count = np.bincount(near, minlength=len(centre))
        for d in range(sample.shape[1]):
            total = np.bincount(near, sample[:, d], minlength=len(centre))
            centre[:, d] = np.where(count > 0, total / np.maximum(count, 1), centre[:, d])
    return centre


def _nearest(rows: np.ndarray, centre: np.ndarray, k: int) -> np.ndarray:
    k = min(k, len(centre))
    norm, step = (centre**2).sum(1), max(1, (1 << 22) // max(1, len(centre)))
    out = [np.zeros((0, k), np.int64)]
    for i in range(0, len(rows), step):
        d = norm - 2 * rows[i : i + step] @ centre.T
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(best, np.argsort(np.take_along_axis(d, best, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def side_by_side(centre: np.ndarray) -> list[int]:
    """The lists in an order that keeps near ones together: halves along the widest dimension."""
    done, todo = [], [np.arange(len(centre))]
    while todo:
        part = todo.pop()
        if len(part) < 2:
            done += part.tolist()
            continue
        part = part[np.argsort(centre[part, np.argmax(np.ptp(centre[part], axis=0))], kind="stable")]
        todo += [part[len(part) // 2 :], part[: len(part) // 2]]
    return done


def tiles(centre: np.ndarray, sizes: dict[int, int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first tile, number of tiles) of each list: neighbours share a tile, a list of over ``most`` rows has several."""
    first, count = np.zeros(len(centre), np.int64), np.zeros(len(centre), np.int64)
    tile = filled = 0
    for c in side_by_side(centre):
        n = sizes.get(c, 0)
        if filled and filled + n > most:
            tile, filled = tile + 1, 0
        first[c], count[c] = tile, -(-n // most)
        filled += n
        if n > most:
            tile, filled = tile + int(count[c]), 0
    return first, count


def scan(query: np.ndarray, rotated: np.ndarray, ids: np.ndarray, own: int, s: Settings, tenth: float = np.inf) -> np.ndarray:
    """Rows of ``rotated`` that may be among the query's neighbours.

    ``query`` is rotated too; ``own`` is its id, which is left out; ``tenth`` is
    the tenth distance found elsewhere.
    """
    rows = np.flatnonzero(ids != own)
    dims, k = len(query), s.neighbours
    if len(rows) <= 4 * k:
        return rows
    # what rounding in the rotation can add to a distance; beyond the query's own norm it is a share of the distance
    noise = 8 * dims**1.5 * np.finfo(float).eps * np.sqrt(query @ query)
    loose = lambda x: (np.sqrt(x) * (1 + 1e-9) + noise) ** 2
    # the tenth distance so far: from a first few rows, compared in full; the ten that set it stay
    head = ((rotated[rows[: 8 * k]] - query) ** 2).sum(1)
    best = np.argpartition(head, k - 1)[:k]
    limit = loose(min(head[best].max(), tenth**2))
    safe = np.zeros(len(rows), bool)
    safe[best] = True
    partial = np.zeros(len(rows))
    for at in range(0, dims, s.block):
        part = rotated[rows, at : at + s.block] - query[at : at + s.block]
        partial += np.einsum("ij,ij->i", part, part)
        done = min(at + s.block, dims)
        bound = limit * (1 + s.slack / np.sqrt(done)) ** 2 * done / dims + noise**2 if done < dims else limit
        stay = safe | (partial <= bound)
        rows, partial, safe = rows[stay], partial[stay], safe[stay]
    if len(rows) > 4 * k:
        cut = np.partition(partial, k - 1)[k - 1]
        rows = rows[partial <= loose(cut)]
    return rows


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    d = vectors - query
    return np.sqrt(np.add.reduce(d * d, axis=1))


def _best(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The ``k`` nearest of (ids, scores), ties to the smaller id."""
    at = np.lexsort(found)[:k]
    return [x[at] for x in found]


def search(query: np.ndarray, turned: np.ndarray, rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: int, s: Settings, tenth: float) -> list[np.ndarray]:
    """(ids, scores) of the nearest among ``rows`` no farther than ``tenth``, which each run of rows sets anew."""
    found = [np.zeros(0, np.int64), np.zeros(0)]
    for i in range(0, len(rows), s.run):
        run = rows[i : i + s.run]
        run = run[scan(turned[0], turned[1][run], ids[run], own, s, tenth)]
        score = exact(query, vectors[run])
        near = score <= tenth
        found = _best([np.append(found[0], ids[run][near]), np.append(found[1], score[near])], s.neighbours)
        if len(found[0]) == s.neighbours:
            tenth = min(tenth, found[1][-1])
    return found


def nearest(vectors: DataFrame, every: int = 100, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: neighbours of each row whose id ``every`` divides.

    Rows with a null id or an unusable vector take no part, as do vectors of
    another length than most; of rows with one id and vector one counts. Ties go
    to the smaller id. An empty table has no neighbours.
    """
    spark = vectors.sparkSession
    s = settings
    rows = vectors.where(usable(embedding) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v")
    )
    out = "query_id long, rank int, vec_id long, score double"
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], out)
    dims = dims[0]
    rows = rows.where(F.size("v") == dims).dropDuplicates(["id", "v"])
    # a bounded sample, the same each time: the smallest hashes
    fit = rows.select("v", F.xxhash64("id").alias("h")).orderBy("h").limit(s.sample).select("v")
    total = rows.count()
    turn = rotation(dims, s.seed)
    lists = min(s.most_lists, int(np.ceil(s.lists * total**0.5)))
    centre = centroids(np.array([r[0] for r in fit.toLocalIterator()]) @ turn, lists, s.seed)
    probed = min(len(centre), int(np.ceil(s.probes * total**-0.125 * len(centre))))
    state = spark.sparkContext.broadcast((turn, centre))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, centre = state.value
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column(1).flatten()).reshape(-1, dims)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_nearest(v @ turn, centre, 1)[:, 0].astype(np.int32))], names=["id", "v", "list"])

    index = shared.materialize(rows.mapInArrow(shared.tidy(coded), "id long, v array<double>, list int"), "lists")
    # as many rows as there are lists
    first, count = tiles(centre, {r["list"]: r["count"] for r in index.groupBy("list").count().toLocalIterator()}, s.tile)
    where = spark.createDataFrame([(c, int(first[c]), int(count[c])) for c in range(len(centre))], "list int, first long, tiles long")
    asked = index.where(F.col("id") % every == 0).select("id", "v")
    groups = max(1, -(-asked.count() // s.queries))
    layout = spark.sparkContext.broadcast((first, count))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, centre = state.value
        first, count = layout.value
        for b in batches:
            if not b.num_rows:
                continue
            v = np.array(b.column(1).flatten()).reshape(-1, dims)
            near = _nearest(v @ state.value[0], centre, probed)
            # a row for each query, list and tile of the list, in order of query, tile and nearness
            query, lists = np.repeat(np.arange(len(v)), near.shape[1]), near.ravel()
            many = count[lists]
            query, lists = np.repeat(query, many), np.repeat(lists, many)
            tile = first[lists] + np.arange(len(lists)) - np.repeat(np.cumsum(many) - many, many)
            rank = np.arange(len(lists))
            order = np.lexsort((rank, tile, query))
            query, tile, lists, rank = query[order], tile[order], lists[order], rank[order]
            start = np.flatnonzero(np.append(True, (query[1:] != query[:-1]) | (tile[1:] != tile[:-1]))[: len(query)])
            home = np.full(len(v), len(rank))
            np.minimum.at(home, query, rank)
            take = pa.array(query[start])
            probe = pa.ListArray.from_arrays(pa.array(np.append(start, len(query)).astype(np.int32)), pa.array(lists.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile[start]), pa.array(rank[start] == home[query[start]]), probe, b.column(0).take(take), b.column(1).take(take)], names=["tile", "home", "lists", "id", "v"]
            )

    queries = asked.mapInArrow(shared.tidy(probes), "tile long, home boolean, lists array<int>, id long, v array<double>")
    queries = queries.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    candidates = index.join(F.broadcast(where), "list").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), "tiles")).alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.lit(None).cast("double").alias("tenth"), F.array("list").alias("lists"), "id", "v",
    )

    def scanned(table: pa.Table) -> pa.Table:
        turn, _ = state.value
        table = table.combine_chunks()
        asks = ~np.isnan(np.array(table.column("tenth").fill_null(np.nan)))
        cand, q = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        ids, of = np.array(cand.column("id")), np.array(cand.column("lists").combine_chunks().flatten())
        order = np.lexsort((ids, of))
        ids, of = ids[order], of[order]
        v = np.array(cand.column("v").combine_chunks().flatten()).reshape(-1, dims)[order]
        turned = v @ turn
        found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        asked = np.array(q.column("v").combine_chunks().flatten()).reshape(-1, dims)
        for i, (own, tenth, lists) in enumerate(zip(q.column("id").to_pylist(), q.column("tenth").to_pylist(), q.column("lists").to_pylist(), strict=True)):
            rows = np.concatenate([np.arange(a, b) for a, b in zip(np.searchsorted(of, lists), np.searchsorted(of, lists, side="right"), strict=True)])
            near, score = search(asked[i], (asked[i] @ turn, turned), rows, v, ids, own, s, tenth)
            for column, part in zip(found, (np.full(len(near), own), near, score), strict=True):
                column.append(part)
        return pa.table([np.concatenate(x) for x in found], names=["query_id", "vec_id", "score"])

    def scans(queries: DataFrame) -> DataFrame:
        both = queries.select("tile", "group", "tenth", "lists", "id", "v").union(candidates.select("tile", "group", "tenth", "lists", "id", "v"))
        return both.groupBy("tile", "group").applyInArrow(scanned, "query_id long, vec_id long, score double")

    nearest_first = F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id"))), 1, s.neighbours)
    home = shared.materialize(scans(queries.where("home").withColumn("tenth", F.lit(float("inf")))), "near")
    tenth = home.groupBy(F.col("query_id").alias("id")).agg(nearest_first.alias("n")).where(F.size("n") == s.neighbours)
    tenth = tenth.select("id", F.element_at("n", -1)["score"].alias("t"))
    away = queries.where("not home").join(tenth, "id", "left").withColumn("tenth", F.coalesce("t", F.lit(float("inf"))))
    best = home.union(scans(away)).groupBy("query_id").agg(nearest_first.alias("n"))
    return best.select("query_id", F.posexplode("n").alias("at", "n")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score")
    )


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(shared.table(spark, sf_dir, "embeddings"))
