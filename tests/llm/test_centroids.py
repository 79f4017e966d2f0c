import hashlib
import math
import random

import numpy as np
import pytest

from palimpsest.llm import centroids
from palimpsest.storage import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, id string, cluster string"


def table(spark, rows):
    return spark.createDataFrame([(i, x, 0, "id", "cluster") for i, x in rows], SCHEMA)


def brute(rows, n=40, rounds=5):
    """By (id, vector): (cluster, distance, inertia of the cluster, of all, hash of the centroid), in plain integers."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x):
            kept.append((i, tuple(math.floor(256 * float(np.float32(v))) for v in x)))
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is None, r[1]))
    points = [x for _, x in kept[:n]]

    def assign():
        best = []
        for _, x in kept:
            best.append(min((sum((a - b) ** 2 for a, b in zip(x, p, strict=True)), c) for c, p in enumerate(points)))
        return best

    for _ in range(rounds):
        found = assign()
        for c in range(len(points)):
            mine = [x for (_, x), (_, own) in zip(kept, found, strict=True) if own == c]
            if mine:
                points[c] = tuple(sum(column) // len(mine) for column in zip(*mine, strict=True))
    found = assign()
    sums = {c: sum(d for d, own in found if own == c) for c in range(len(points))}
    hashes = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return sorted(
        (str(i), c, d, sums[c], sum(sums.values()), hashes[c]) for (i, _), (d, c) in zip(kept, found, strict=True)
    )


def found(spark, rows, **options):
    result = centroids.cluster(table(spark, rows), Scratch(spark), **options).collect()
    return sorted((str(r.id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in result)


def draw(seed, n=64, low=-1.0):
    source = random.Random(seed)
    return [source.uniform(low, 1) for _ in range(n)]


def test_awkward_rows(spark):
    rows = [(k, draw(k)) for k in range(120)]
    rows += [(200, None), (201, []), (202, draw(1, 63)), (203, draw(1, 65)), (204, [None] + draw(1, 63)), (205, [float("nan")] + draw(1, 63))]
    rows += [(206, [float("inf")] + draw(1, 63)), (None, draw(7)), (None, draw(8)), (3, draw(3)), (3, draw(9)), (300, [0.0] * 64)]
    assert found(spark, rows) == brute(rows)


def test_ties_and_equal_vectors(spark):
    """Many vectors at the same places, so centroids coincide and distances tie."""
    rows = [(k, [float(k % 5)] * 64) for k in range(90)]
    assert found(spark, rows) == brute(rows)
    same = [(k, [0.5] * 64) for k in range(60)]
    assert found(spark, same) == brute(same)


def test_fewer_vectors_than_centroids(spark):
    rows = [(k, draw(k)) for k in range(7)]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert centroids.cluster(table(spark, []), Scratch(spark)).collect() == []
    assert centroids.cluster(table(spark, [(1, None)]), Scratch(spark)).collect() == []


def test_too_large_components(spark):
    with pytest.raises(Exception, match="do not fit a long"):
        found(spark, [(1, [1e9] * 64)])


@pytest.mark.parametrize("scale", [1, 1000, (1 << 26)])
def test_bounds_never_lose_the_nearest(scale):
    source = np.random.default_rng(scale)
    middle = source.integers(-scale, scale, (6, 64))
    vectors = middle[source.integers(0, 6, 3000)] + source.integers(-max(1, scale // 20), max(2, scale // 20), (3000, 64))
    points = np.concatenate([vectors[:30], vectors[:3], middle])  # Some twice, so that distances tie.
    pivots = centroids.spread(vectors[:30], 12)
    which, best, computed = centroids.nearest(vectors, centroids.to_pivots(vectors, pivots), points, pivots)
    every = np.stack([centroids.distances(vectors, p) for p in points], axis=1)
    assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert computed < every.size


def test_pivots_spare_distances_of_grouped_vectors():
    source = np.random.default_rng(5)
    middle = source.integers(-1000, 1000, (30, 64))
    vectors = middle[source.integers(0, 30, 4000)] + source.integers(-20, 20, (4000, 64))
    pivots = centroids.spread(middle, 12)
    _, _, computed = centroids.nearest(vectors, centroids.to_pivots(vectors, pivots), middle, pivots)
    assert computed < 0.2 * len(vectors) * len(middle)
