"""Clustering against a plain version in whole numbers; edge cases; the SQL on a table with hot and odd vectors."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import centroids
from corpusloom.llm.queries import ORACLES


def plain(rows, k, rounds, dims):
    """One vector after another."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [max(-(1 << 27), min((1 << 27) - 1, int(np.floor(256.0 * x)))) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), -1 if r[0] is None else r[0], r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            if part := [v for o, (_, v) in zip(own, kept, strict=True) if o == j]:
                c[j] = [sum(x) // len(part) for x in zip(*part, strict=True)]
    got = [(i, *near(v)) for i, v in kept]
    total = {j: sum(d for _, d, o in got if o == j) for j in range(len(c))}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    top = (1 << 63) - 1
    return sorted((str(i), o, d, min(total[o], top), min(sum(total.values()), top), digest[o]) for i, d, o in got)


def rows_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("q", F.lit("x")).withColumn("cluster", F.lit(9)).withColumn("n", F.lit(None))
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in centroids.cluster_report(df, **options).collect())


def vectors(n, dims, seed, hot=0.3):
    r = random.Random(seed)
    same = [float(np.float32(r.uniform(-1, 1))) for _ in range(dims)]
    return [(i, same if r.random() < hot else [float(np.float32(r.uniform(-1, 1))) for _ in range(dims)]) for i in range(n)]


def test_equals_plain(spark):
    odd = [
        (900, None), (901, []), (902, [1.0, 2.0, 3.0]), (903, [1.0, None, 2.0, 3.0]), (904, [1.0, float("nan"), 0.0, 0.0]),
        (905, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.5, -0.5, 0.25, -0.001]), (None, [0.5, 0.5, 0.5, 0.5]), (5, [0.0, 0.0, 0.0, 0.0]), (5, [-0.0, 0.0, 0.0, 1e-30]),
    ]
    rows = vectors(300, 4, 1) + odd
    for k, rounds, heavy in ((7, 5, 256), (1, 2, 2), (40, 0, 4)):
        assert rows_of(spark, rows, k=k, rounds=rounds, dims=4, heavy=heavy) == plain(rows, k, rounds, 4)


def test_large_components_and_ties(spark):
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([1e30, -1e30, 3e5, 3e5, -3e5, 0.0, 1.0, 2.0])]
    assert rows_of(spark, rows, k=3, rounds=3, dims=2) == plain(rows, 3, 3, 2)
    same = [(i, [1.0, 1.0]) for i in range(9)]  # all centroids equal: the first takes all, the others are empty and stay
    got = rows_of(spark, same, k=4, rounds=2, dims=2)
    assert got == plain(same, 4, 2, 2) and {r[1] for r in got} == {0}
    v = np.array([[5, 5], [0, 0]])
    assert centroids.nearest(v, np.array([[0, 0], [10, 10]]))[0].tolist() == [0, 0]
    big = np.random.default_rng(1).integers(-(1 << 21), 1 << 21, (50, 64))
    assert np.array_equal(centroids.nearest(big, big[:7])[1], ((big[:, None] - big[None, :7]) ** 2).sum(axis=2).min(axis=1))


def test_few_or_no_rows(spark):
    assert rows_of(spark, [], dims=4) == [] and rows_of(spark, [(1, None), (2, [1.0])], dims=4) == []
    lone = [(3, [0.1, 0.2])]
    assert rows_of(spark, lone, dims=2) == plain(lone, 40, 5, 2)


@pytest.mark.parametrize("seed", [2, 3])
def test_query_equals_sql(spark, seed, tmp_path):
    rows = vectors(260, 64, seed, hot=0.4) + [(1000, None), (1001, [0.1] * 63), (1002, [float("nan")] * 64), (1003, [None] + [0.0] * 63)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    from corpusloom.llm.queries import op13_centroids

    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        cols = "vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256"
        want = sorted(con.sql(f"SELECT {cols} FROM ({ORACLES['op13_centroids']})").fetchall())
    got = sorted(tuple(r) for r in op13_centroids(spark, str(tmp_path)).collect())
    assert got == want and len(got) == 260
    assert got == sorted((int(i), *rest) for i, *rest in plain(rows, 40, 5, 64))
