import hashlib
import math

import numpy as np
import pytest

from loomset.llm import tournament


def plain(rows, k, rounds, seed, dimensions, scale=256):
    """Python numbers throughout: every distance to every centroid."""
    most = tournament.largest_component(dimensions) - 1
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != dimensions or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if all(abs(x * scale) <= most for x in vector):
            kept.append((key, [math.floor(x * scale) for x in vector]))
    first = sorted((hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest(), v) for key, v in kept)
    centroids = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for i, members in groups.items():
            centroids[i] = [sum(column) // len(members) for column in zip(*members)]
    told = [(key, *nearest(v)[::-1]) for key, v in kept]
    return sorted(told, key=repr), centroids


def compare(spark, rows, k, rounds=5, seed=2, dimensions=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors, clusters = tournament.cluster(df, dimensions=dimensions, k=k, rounds=rounds, seed=seed)
    want, centroids = plain(rows, k, rounds, seed, dimensions)
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in vectors.collect()), key=repr)
    assert got == want
    told = {r.cluster: r for r in clusters.collect()}
    assert [list(told[i].centroid) for i in range(len(centroids))] == centroids and len(told) == len(centroids)
    for i, r in told.items():
        mine = [d for _, c, d in want if c == i]
        assert (r.size, r.cluster_inertia) == (len(mine), sum(mine))


def points(n, dimensions=4, seed=0, spread=3.0):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(0, spread, dimensions)).tolist()) for i in range(n)]


@pytest.mark.parametrize(("n", "k", "rounds"), [(200, 7, 5), (200, 1, 5), (50, 50, 2), (30, 40, 5), (60, 5, 0), (1, 3, 5)])
def test_like_every_distance(spark, n, k, rounds):
    compare(spark, points(n), k, rounds)


def test_ties_and_copies(spark):
    """Whole numbers on a small grid: many equal distances, equal centroids and empty clusters."""
    rows = [(i, [float(i % 3), float(i // 3 % 3), 0.0, 0.0]) for i in range(60)]
    compare(spark, rows, 12)
    compare(spark, [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)], 5)
    compare(spark, [(7, [float(i), 0.0, 0.0, 0.0]) for i in range(20)], 4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = points(40) + [
        (100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0] * 5), (104, [1.0, None, 2.0, 3.0]), (105, [nan, 1.0, 1.0, 1.0]),
        (106, [1.0, -inf, 1.0, 1.0]), (107, [inf] * 4), (108, [1e300] * 4), (None, [0.5, 0.25, -0.001, -0.0]), (None, [9.0] * 4), (3, [0.0] * 4),
    ]
    compare(spark, rows, 6)


def test_the_largest_vectors_that_fit(spark):
    most = (tournament.largest_component(4) - 1) / 256
    rows = [(i, [most if i >> b & 1 else -most for b in range(4)]) for i in range(16)] + points(20)
    compare(spark, rows, 9)


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        vectors, clusters = tournament.cluster(df, k=3)
        assert vectors.collect() == [] and clusters.collect() == []


def test_clashing_names(spark):
    df = spark.createDataFrame(
        [(str(i), [float(i), 1.0], 5, 6, [1]) for i in range(20)], "key string, vector array<float>, cluster int, distance int, centroid array<int>"
    )
    vectors, clusters = tournament.cluster(df, key="key", vector="vector", dimensions=2, k=3)
    assert vectors.columns == ["key", "cluster", "distance"] and vectors.count() == 20 and clusters.count() == 3


def test_only_signs_are_asked_for():
    """k - 1 tests a vector: the products are of one normal each."""
    rng = np.random.default_rng(4)
    centroids = rng.integers(-50, 50, (9, 3))
    bisectors = tournament.Bisectors(centroids)
    assert [len(n) for n in bisectors.normals] == list(range(9))
    x = rng.integers(-60, 60, (500, 3))
    nearest, distance = bisectors.nearest(x)
    all_distances = ((x[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (nearest == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
