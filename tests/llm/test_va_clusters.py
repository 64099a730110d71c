"""Centroid clustering next to plain k-means in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from lakestrata.llm import va_clusters
from lakestrata.llm.va_clusters import LARGEST, Cells, clusters, exact, in_buckets, whole_vectors


def plain(rows, k, rounds, dimensions, scale=256, seed="2"):
    """[(id, cluster, distance)] and the centroids, with Python's own numbers."""
    kept = []
    for id_, v in rows:
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v):
            kept.append((id_, [math.floor(max(-LARGEST, min(LARGEST, x * scale))) for x in v]))
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(((digest(i), v) for i, v in kept))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, group in groups.items():
            centroids[n] = [sum(x) // len(group) for x in zip(*group)]
    return sorted(((i, *nearest(v)[::-1]) for i, v in kept), key=repr), centroids


def table(spark, rows, parts=3):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, `a.b` string, `key` int")
    return df.repartition(parts)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    f = lambda x: float(np.float32(x))
    made = [(i, [f(r.gauss(i % 5 / 3, 0.2)) for _ in range(6)]) for i in range(400)]
    made += [(900, [f(0.5)] * 6)] * 200  # one vector that holds much of the table, under one id
    made += [(None, [f(0.1)] * 6), (None, [f(-0.1)] * 6), (7, made[7][1]), (7, [f(0.2)] * 6)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 5, [0.0] * 7, [nan] + [0.0] * 5, [inf] + [0.0] * 5, [None] + [0.0] * 5]
    return made + [(1000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("k", [1, 8, 40])
def test_equals_plain_clustering(spark, rows, k):
    found, centroids = clusters(table(spark, rows), k=k, dimensions=6)
    wanted = plain(rows, k, 5, 6)
    assert centroids == wanted[1]
    assert sorted(map(tuple, found.collect()), key=repr) == wanted[0]


def test_far_components_and_ties(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, -1.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found, centroids = clusters(table(spark, rows), k=3, dimensions=2)
    wanted = plain(rows, 3, 5, 2)
    assert (sorted(map(tuple, found.collect()), key=repr), centroids) == wanted


def test_fewer_vectors_than_centroids_and_none(spark, rows, monkeypatch):
    found, centroids = clusters(table(spark, rows[:3]), k=40, dimensions=6)
    assert len(centroids) == 3 and sorted(r["distance"] for r in found.collect()) == [0, 0, 0]
    monkeypatch.setattr(va_clusters, "documents", lambda *_: table(spark, rows).limit(0))
    assert va_clusters.op12_centroid_clusters(spark, "").count() == 0


def test_intervals_hold_the_distances():
    r = np.random.default_rng(3)
    v = np.concatenate([r.normal(0, 50, (500, 4)), [[5000, -4000, 0, 1]], np.zeros((50, 4))]).round().astype(np.int64)
    cells = Cells(np.array(len(v)), v.sum(0), (v.astype(float) ** 2).sum(0), v.min(0), v.max(0))
    code = cells.codes(v)
    for d in range(4):
        assert (cells.least[d][code[:, d]] <= v[:, d]).all() and (v[:, d] <= cells.most[d][code[:, d]]).all()
    centroids = v[:7]
    low, high = cells.tables(centroids)
    least, most = (sum(t[d][code[:, d]] for d in range(4)) for t in (low, high))
    shared = (v * v).sum(1) - 2 * v @ np.round(centroids.mean(0)).astype(np.int64)
    true = exact(v, centroids) - shared[:, None]
    assert (least <= true).all() and (true <= most).all()


def test_full_vectors_are_fetched_without_a_shuffle_of_their_own(spark, rows):
    full = in_buckets(whole_vectors(table(spark, rows), "vec_id", "embedding", 6, 256).selectExpr("monotonically_increasing_id() AS key", "*"), "va_test")
    needed = full.select("key").filter("key % 7 = 0").repartition(3)
    plan = needed.hint("merge").join(full, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(key") == 1 and "Bucketed: true" in plan


def test_query_has_a_row_for_each_vector(spark, sf_dir):
    found = va_clusters.op12_centroid_clusters(spark, sf_dir)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found.count() == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
