import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from switchyard.llm import centroids

points = st.integers(1, 20).flatmap(lambda d: st.lists(st.lists(st.integers(-(1 << 27) + 1, (1 << 27) - 1) | st.integers(-3, 3), min_size=d, max_size=d), min_size=2, max_size=12))


@settings(max_examples=200, deadline=None)
@given(points)
def test_bounds_never_pass_the_distance(rows):
    x = np.array(rows, dtype=np.int64)
    bounds = centroids.Sketches.of(x).bounds(x)
    for i, a in enumerate(x.tolist()):
        for j, b in enumerate(x.tolist()):
            assert bounds[i, j] <= sum((p - q) ** 2 for p, q in zip(a, b, strict=True))


def test_compressed_vectors_are_near(vectors):
    x = np.random.default_rng(1).integers(-(1 << 20), 1 << 20, (50, 64))
    codes, shift, norms = centroids.compress(x)
    left = x - codes.astype(np.int64) * (1 << shift.astype(np.int64))[:, None]
    assert codes.nbytes == 50 * 64 and (np.abs(left) <= (1 << shift.astype(np.int64))[:, None] / 2).all()
    assert np.allclose(norms**2, (left**2).reshape(50, 8, 8).sum(axis=2))


@settings(max_examples=200, deadline=None)
@given(points, st.integers(1, 6))
def test_nearest_equals_every_distance(rows, k):
    x = np.array(rows, dtype=np.int32)
    centers = x[np.arange(k) % len(x)].astype(np.int64) + np.arange(k)[:, None] % 2
    best, distance, taken = centroids.nearest(x, centroids.Sketches.of(x), centers)
    for row, b, d in zip(x.tolist(), best.tolist(), distance.tolist(), strict=True):
        assert (d, b) == min((sum((p - q) ** 2 for p, q in zip(row, c, strict=True)), i) for i, c in enumerate(centers.tolist()))
    assert len(x) <= taken <= len(x) * k


def plain(rows, k=8, rounds=10):
    """The contract in plain Python: rows of vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centers = [v for _, v in ordered[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers)) for _, v in kept]

    for _ in range(rounds):
        where = assign()
        for n in range(len(centers)):
            if mine := [v for (_, v), (_, m) in zip(kept, where, strict=True) if m == n]:
                centers[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    where = assign()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    total = sum(d for d, _ in where)
    return [(i, n, d, sum(e for e, m in where if m == n), total, digest[n]) for (i, _), (d, n) in zip(kept, where, strict=True)]


@pytest.fixture()
def vectors(spark):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 64))
    rows = [(i, (middle[i % 12] + 0.05 * rng.normal(size=64)).astype(np.float32).tolist(), i % 3, "x") for i in range(150)]
    odd = [None, [], [0.5] * 63, [0.5] * 65, [None] + [0.5] * 63, [float("nan")] + [0.5] * 63, [float("inf")] + [0.5] * 63]
    rows += [(200 + i, v, None, None) for i, v in enumerate(odd)] + [(None, rows[0][1], 0, "x"), (300, [0.0] * 64, 1, "x"), (301, [-0.0001] * 64, 1, "x")]
    rows += [rows[3]] * 4
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, point string")


def test_clusters_equal_plain_python(vectors):
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    got = centroids.report(centroids.cluster(vectors))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_far_centroids_are_pruned(vectors):
    found = centroids.cluster(vectors)
    assert len(found.exact_share) == 10 and found.exact_share[-1] < 0.14  # one of eight is the least


def test_few_and_no_vectors(spark, vectors):
    two = vectors.where("vec_id in (1, 2)")
    assert sorted(r.cluster for r in centroids.report(centroids.cluster(two)).collect()) == [0, 1]
    assert centroids.report(centroids.cluster(vectors.where("false"))).count() == 0
    large = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit a long"):
        centroids.cluster(large)
