"""Centroid clustering of quantised vectors, where equal vectors are worked on once.

Components become integers, so many vectors fall together. Equal ones are
grouped with their multiplicity, Lloyd's rounds run over the distinct vectors
with weighted integer sums, and the assignments are joined back to the ids. All
arithmetic is on integers, so results don't depend on partitions or order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
#: A vector with more than one in so many rows is joined back by broadcast; there are fewer such vectors than this.
HOT = 64


@dataclass(frozen=True)
class Settings:
    clusters: int = 40
    rounds: int = 5
    dims: int = 64
    scale: int = 256  #: a component x becomes floor(scale * x)
    seed: int = 2  #: first centroids: the smallest sha256 of ``seed:vec_id``


def kept(vector: str, dims: int) -> F.Column:
    """As many components as asked for, all finite numbers."""
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.size(vector) == dims) & F.coalesce(good, F.lit(False))


def _exact(rows: np.ndarray, centre: np.ndarray) -> type:
    """A type that holds all squared distances: doubles hold whole numbers to 2**53, Python's integers all."""
    most = max((int(np.abs(x.astype(np.int64)).max(initial=0)) for x in (rows, centre)), default=0)
    return float if 4 * rows.shape[1] * most**2 < 2**53 else object


def assign(rows: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each row's nearest centroid; ties to the smaller number.

    A distance beyond 64 bits raises OverflowError.
    """
    kind = _exact(rows, centre)
    r, c = rows.astype(np.int64).astype(kind), centre.astype(np.int64).astype(kind)
    d = (r * r).sum(1)[:, None] - 2 * (r @ c.T) + (c * c).sum(1)
    near = d.argmin(1)
    found = d[np.arange(len(r)), near]
    return near, np.array(found.tolist(), np.int64) if kind is object else found.astype(np.int64)


def weighted_sums(rows: np.ndarray, weight: np.ndarray, near: np.ndarray, clusters: int) -> np.ndarray:
    """Sums of the rows by cluster, each counted as often as it occurs, as Python integers; the last column counts."""
    most = int(np.abs(rows.astype(np.int64)).max(initial=1)) * int(weight.sum())
    kind = np.int64 if most < 2**62 else object
    wide = np.column_stack([rows.astype(np.int64).astype(kind), np.ones(len(rows), kind)]) * weight.astype(kind)[:, None]
    out = np.zeros((clusters, wide.shape[1]), object)
    order = np.argsort(near, kind="stable")
    here, first = np.unique(near[order], return_index=True)
    if len(here):
        out[here] = np.add.reduceat(wide[order], first, axis=0).astype(object)
    return out


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def _moved(vectors: DataFrame, centre: np.ndarray, dims: int) -> np.ndarray:
    """The centroids after a round: floor of the mean; one without vectors stays."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), dims + 1), object)
        for b in batches:
            if b.num_rows:
                rows = _vectors(b.column(0), dims)
                total += weighted_sums(rows, np.asarray(b.column(1)), assign(rows, centre)[0], len(centre))
        cluster, at = np.nonzero(np.repeat(total[:, -1:] > 0, dims + 1, axis=1))
        columns = [pa.array(cluster, pa.int32()), pa.array(at, pa.int32()), pa.array(total[cluster, at].tolist(), pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "at", "total"])

    found = vectors.mapInArrow(shared.tidy(sums), "cluster int, at int, total decimal(38,0)").groupBy("cluster", "at").agg(F.sum("total").alias("total"))
    after = centre.astype(object)
    got = {(r["cluster"], r["at"]): int(r["total"]) for r in found.collect()}  # clusters times dims at most; toLocalIterator would run a job a partition
    for (cluster, at), total in got.items():
        if at < dims:
            after[cluster, at] = total // got[cluster, dims]
    return after.astype(np.int64)


def cluster_vectors(vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """SCHEMA: the cluster of each row whose vector is of ``dims`` finite components.

    Other rows (null vectors, other lengths, null or non-finite components) take
    no part. Repeated ids are vectors each; a null id stays null and seeds a
    centroid only after all others. Equal hashes seed in order of their vectors.
    With fewer vectors than clusters each is a centroid; an empty table gives no
    rows. A component whose integer is beyond 32 bits, or a distance or a sum of
    distances beyond 64, raises. Other columns are left out.
    """
    spark = vectors.sparkSession
    s = settings
    whole = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * s.scale).cast("int"))
    rows = vectors.where(kept(embedding, s.dims)).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("q"))
    distinct = shared.materialize(rows.groupBy("q").agg(F.count("*").alias("weight")), "distinct")
    first = rows.select(F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "q").orderBy(F.asc_nulls_last("h"), "q").limit(s.clusters)
    centre = np.array([r["q"] for r in first.collect()], np.int64)
    if not len(centre):
        return spark.createDataFrame([], SCHEMA)
    for _ in range(s.rounds):
        centre = _moved(distinct, centre, s.dims)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near, distance = assign(_vectors(b.column(0), s.dims), centre)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32)), pa.array(distance)], names=["q", "weight", "cluster", "distance"])

    assigned = shared.materialize(distinct.mapInArrow(shared.tidy(last), "q array<int>, weight long, cluster int, distance long"), "assigned")
    spread = F.sum(F.col("distance").cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")).alias("inertia")
    by_cluster = {r["cluster"]: (int(r["inertia"]), r["n"]) for r in assigned.groupBy("cluster").agg(spread, F.sum("weight").alias("n")).collect()}  # a row for each cluster
    inertia, total = (sum(x) for x in zip(*by_cluster.values(), strict=True))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre.tolist()]
    stats = spark.createDataFrame([(k, n, inertia, digest[k]) for k, (n, _) in by_cluster.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")

    # back to the ids: a vector that very many rows have goes to them, rows of the others meet theirs by key
    found = assigned.select("q", "cluster", "distance", (F.col("weight") * HOT > total).alias("hot"))
    hot = F.broadcast(found.where("hot").drop("hot"))
    back = rows.join(hot.select("q"), "q", "left_anti").join(found.where("not hot").drop("hot"), "q").union(rows.join(hot, "q"))
    return back.join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(shared.table(spark, sf_dir, "embeddings"))


def _sql(s: Settings = Settings()) -> str:
    """The same as nested steps: seeds, ``rounds`` times assignment and means, a last assignment."""
    steps = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
        WHERE len(embedding) = {s.dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {s.dims})""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('{s.seed}:' || vec_id) NULLS LAST, q) - 1 AS cluster, q FROM kept QUALIFY cluster < {s.clusters})",
    ]
    square = "list_sum(list_transform(list_zip(k.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    nearest = f"SELECT k.vec_id, k.q, min(struct_pack(d := CAST({square} AS BIGINT), c := c.cluster)) AS best FROM (SELECT *, row_number() OVER () AS row FROM kept) k, {{}} c GROUP BY k.row, k.vec_id, k.q"
    for i in range(s.rounds):
        steps.append(f"a{i} AS ({nearest.format(f'c{i}')})")
        # floor of the quotient, for negative sums too
        mean = "CAST((total - ((total % n) + n) % n) // n AS BIGINT)"
        steps.append(
            f"""m{i} AS (SELECT cluster, list({mean} ORDER BY i) AS q FROM (SELECT best.c AS cluster, i, sum(x) AS total, count(*) AS n
            FROM (SELECT best, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM a{i}) GROUP BY 1, 2) GROUP BY 1)"""
        )
        steps.append(f"c{i + 1} AS (SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{i} c LEFT JOIN m{i} m ON c.cluster = m.cluster)")
    steps.append(f"z AS ({nearest.format(f'c{s.rounds}')})")
    return f"""WITH {", ".join(steps)} SELECT z.vec_id, CAST(z.best.c AS INT) AS cluster, z.best.d AS distance, CAST(sum(z.best.d) OVER (PARTITION BY z.best.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(z.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM z JOIN c{s.rounds} c ON c.cluster = z.best.c"""


OP11_SQL = _sql()
