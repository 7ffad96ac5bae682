"""Centroid clustering by Lloyd's rounds over distinct quantised vectors.

Vectors are quantised to integers and identical ones grouped with their multiplicity, so a hot vector is one row. Each round
assigns the distinct vectors and adds them up, weighted by multiplicity, in whole numbers; tasks give one row of sums for each
cluster, and the driver holds the centroids only. Whole numbers make the result the same for any order and partitioning of the rows.
Assignments are then joined back to the ids: by a broadcast for the vectors that hold more than one in ``HEAVY`` of all rows
(fewer than ``HEAVY`` of them exist), by a shuffle for the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import HEAVY, heavy_keys, join_heavy, materialize

#: Quantised components beyond these count as these: squared distances of 64 components then fit in 64 bits.
LEAST, MOST = -(1 << 27), (1 << 27) - 1
#: Components below this in size have exact distances in double precision: 64 * (2 * 2**22)**2 < 2**53.
_EXACT = 1 << 22
LONGEST = (1 << 63) - 1


def quantised(vector: Column, dims: int, scale: int) -> tuple[Column, Column]:
    """(kept, array<int>): whether a vector has ``dims`` components, none null or non-finite, and floor(scale * x) of each."""
    kept = F.coalesce((F.size(vector) == dims) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    inside = lambda x: F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(float(MOST))), F.lit(float(LEAST)))
    return kept, F.transform(vector, lambda x: F.floor(inside(x)).cast("int"))


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of each vector, exactly; ties go to the smaller number."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) < _EXACT and vectors.shape[1] <= 64:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        d = ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    else:
        d = np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _assigned(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``distinct`` (q, n) with cluster and distance."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best, d = nearest(_matrix(b.column(0), dims), centroids)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best.astype(np.int32)), pa.array(d)], names=["q", "n", "cluster", "distance"])

    return distinct.mapInArrow(run, "q array<int>, n long, cluster int, distance long")


def _moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of each cluster's mean; empty clusters stay."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            v, n = _matrix(b.column(0), dims), b.column(1).to_numpy()
            best, _ = nearest(v, centroids)
            np.add.at(sums, best, v * n[:, None])
            np.add.at(counts, best, n)
        own = np.flatnonzero(counts)
        cols = [pa.array(own.astype(np.int32)), pa.array(counts[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(cols, names=["cluster", "n", "sums"])

    parts = distinct.mapInArrow(run, "cluster int, n long, sums array<long>")
    wide = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    rows = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(wide("n").alias("n"), wide("s").alias("s"))
    out = centroids.copy()
    for r in rows.collect():  # clusters times components
        out[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return out


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:",
    id_col: str = "vec_id", vector_col: str = "embedding", heavy: int = HEAVY,
) -> tuple[DataFrame, list[dict]]:
    """((vec_id, cluster, distance) of every kept row, centroids as dicts (cluster, centroid, size, inertia)).

    Rows are kept whose vector has ``dims`` components, none null or non-finite; quantised components are limited to ``LEAST`` and ``MOST``.
    The first centroids are the kept rows with the smallest sha256 of ``seed`` and the id (ties by id, then vector; a null id counts
    as 'null'); fewer rows make fewer centroids, and equal ones stand for themselves, the smaller number wins. Repeated rows and ids are
    rows of their own; other columns are not read; no kept rows give no rows and no centroids. The sums of a task hold 2**36 rows.
    """
    kept, q = quantised(F.col(vector_col), dims, scale)
    rows = materialize(vectors.filter(kept).select(F.col(id_col).alias("vec_id"), q.alias("q")), "centroids-rows")
    order = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = rows.orderBy(order, F.col("vec_id").asc_nulls_first(), "q").limit(k).collect()  # k rows
    if not first:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    centroids = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), dims)
    distinct = materialize(rows.groupBy("q").agg(F.count("*").alias("n")), "centroids-distinct")
    for _ in range(rounds):
        centroids = _moved(distinct, centroids)
    assigned = materialize(_assigned(distinct, centroids), "centroids-assigned")
    whole = F.sum(F.col("distance").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)"))
    sums = {r["cluster"]: r for r in assigned.groupBy("cluster").agg(F.sum("n").alias("size"), whole.alias("inertia")).collect()}  # k rows
    found = [
        {"cluster": i, "centroid": c.tolist(), "size": sums[i]["size"] if i in sums else 0, "inertia": int(sums[i]["inertia"]) if i in sums else 0}
        for i, c in enumerate(centroids)
    ]
    total = sum(c["size"] for c in found)
    out = join_heavy(rows, assigned, ["q"], heavy_keys(assigned, "n", total, heavy))
    return out.select("vec_id", "cluster", "distance"), found


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept row of ``vectors``, see ``cluster``.

    inertia is the distance summed over all rows, cluster_inertia over the row's cluster (2**63 - 1 where it is larger); the digest is
    of the centroid's components in decimal, joined by commas.
    """
    rows, centroids = cluster(vectors, **options)
    total = min(sum(c["inertia"] for c in centroids), LONGEST)
    digest = lambda c: hashlib.sha256(",".join(map(str, c["centroid"])).encode()).hexdigest()
    info = [(c["cluster"], min(c["inertia"], LONGEST), total, digest(c)) for c in centroids]
    info = rows.sparkSession.createDataFrame(info, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(info), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
