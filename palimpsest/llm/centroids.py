"""Clusters of integer vectors around centroids, with a pivot table that spares most distances.

Vectors are the rows whose list has exactly `size` components, none null and none infinite or NaN; a component x becomes
floor(256 * x). The first centroids are the vectors with the smallest SHA-256 of `<seed>:<id>`. Every round assigns each
vector to its nearest centroid, ties to the smaller number, and moves centroids to the floor of the mean of their
vectors, all in integers. After the last round vectors are assigned once more.

Pivots are fixed points, chosen among the first centroids so that they lie far from one another. The distances of a vector
to all pivots are computed once and stored with it. By the triangle inequality the difference between the distances of a
vector and of a centroid to a pivot bounds the distance between the two from below; so in each round only centroids
whose bounds, over all pivots, do not exceed the best distance found so far get an exact distance. Bounds are floats with
room for rounding, distances are integers, so the result is that of comparing all of them.

A round is one pass over the written table of vectors. A task sends one row of sums per centroid, whatever share of the
vectors a centroid has; the driver holds centroids only.

* Null lists and lists with nulls or other lengths are left out. Null ids are hashed as if empty, after all others of
  equal hash; among equal ids the smaller vector comes first. Fewer vectors than centroids make fewer centroids.
* Repeated rows and repeated ids are vectors of their own. An empty table gives an empty result. Vectors all equal
  go to centroid 0, and the others stay as they were.
* Components need |256 * x| below 2**27, as otherwise a squared distance may not fit a long; more is an error.
* Other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.storage import Scratch

SIZE = 64
CENTROIDS = 40
ROUNDS = 5
SEED = "2"
PIVOTS = 12
SCALE = 256
LIMIT = 1 << 27  # Of a component; 64 squares of differences then fit a long.


def usable(table: DataFrame, id: str, vector: str, size: int = SIZE) -> DataFrame:
    """(id, x): the rows that count, x as doubles."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return table.where((F.array_size(x) == size) & finite).select(F.col(id).cast("long").alias("id"), x.alias("x"))


def integers(column: pa.Array, size: int) -> np.ndarray:
    """A column of lists of doubles as a matrix of floor(256 * x)."""
    scaled = np.floor(SCALE * np.asarray(column.flatten(), np.float64).reshape(len(column), size))
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"components of {LIMIT // SCALE} or more make distances that do not fit a long")
    return scaled.astype(np.int64)


def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = vectors - points
    return np.einsum("ij,ij->i", apart, apart)


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to n of the points: the first, then always the one farthest from those taken."""
    taken = points[:1]
    nearest = distances(points, points[0]) if len(points) else np.zeros(0, np.int64)
    while len(taken) < min(n, len(points)) and nearest.max() > 0:
        taken = np.concatenate([taken, points[[int(nearest.argmax())]]])
        nearest = np.minimum(nearest, distances(points, taken[-1]))
    return taken


def to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (not squared) of every vector to every pivot."""
    return np.stack([np.sqrt(distances(vectors, pivot).astype(np.float64)) for pivot in pivots], axis=1)


def nearest(vectors: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each vector, its squared distance, and how many exact distances were computed.

    table: distances of the vectors to the pivots.
    """
    of_centroids = to_pivots(centroids, pivots)
    bounds = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bounds, np.abs(table[:, p, None] - of_centroids[None, :, p]), out=bounds)
    bounds -= 1e-9 * (1 + max(table.max(initial=0), of_centroids.max(initial=0)))  # More than roots are off by.
    which = bounds.argmin(axis=1)
    best = distances(vectors, centroids[which])
    root, first, computed = np.sqrt(best.astype(np.float64)), which.copy(), len(vectors)
    for c in range(len(centroids)):
        rows = np.flatnonzero((bounds[:, c] <= root) & (first != c))
        if not len(rows):
            continue
        computed += len(rows)
        found = distances(vectors[rows], centroids[c])
        closer = (found < best[rows]) | ((found == best[rows]) & (c < which[rows]))
        rows, found = rows[closer], found[closer]
        which[rows], best[rows], root[rows] = c, found, np.sqrt(found.astype(np.float64))
    return which, best, computed


def moved(centroids: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """The floor of the means where there are vectors: sums has (count, sums of components) by centroid."""
    result = centroids.copy()
    for c, (n, total) in sums.items():
        result[c] = [s // n for s in total]
    return result


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def cluster(
    table: DataFrame, scratch: Scratch, id: str = "vec_id", vector: str = "embedding", size: int = SIZE, centroids: int = CENTROIDS,
    rounds: int = ROUNDS, seed: str = SEED, pivots: int = PIVOTS,
) -> DataFrame:
    """One row per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256, centroid."""
    rows = usable(table, id, vector, size)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = rows.select(hashed.alias("h"), F.col("id").isNull().alias("no_id"), "x").orderBy("h", "no_id", "x").limit(centroids).toArrow()
    starts = integers(first.column("x").combine_chunks(), size) if len(first) else np.zeros((0, size), np.int64)
    fixed = spread(starts, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                vectors = integers(batch.column("x"), size)
                parts = [pa.array([row.tobytes() for row in part], pa.binary()) for part in (vectors, to_pivots(vectors, fixed))]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *parts], ["id", "vector", "to_pivots"])

    vectors = scratch.keep(rows.mapInArrow(measure, "id long, vector binary, to_pivots binary"), "vectors")
    points = starts
    for turn in range(rounds):
        points = moved(points, _sums(vectors, points, fixed))
    assigned = scratch.keep(_assigned(vectors, points, fixed), "assigned")
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}

    numbers = range(len(points))
    texts = [",".join(map(str, point)) for point in points.tolist()]
    of_cluster = {
        "cluster_inertia": F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in numbers]),
        "centroid_sha256": F.array(*[F.lit(hashlib.sha256(text.encode()).hexdigest()) for text in texts]),
        "centroid": F.array(*[F.split(F.lit(text), ",").cast("array<long>") for text in texts]),
    }
    if not len(points):
        of_cluster = {"cluster_inertia": F.lit(None).cast("array<long>"), "centroid_sha256": F.lit(None).cast("array<string>"), "centroid": F.lit(None).cast("array<array<long>>")}
    chosen = {name: F.get(column, F.col("cluster")).alias(name) for name, column in of_cluster.items()}
    total = F.lit(sum(inertia.values())).cast("long").alias("inertia")
    return assigned.select("id", "cluster", "distance", chosen["cluster_inertia"], total, chosen["centroid_sha256"], chosen["centroid"])


def _sums(vectors: DataFrame, points: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """(count, sums of components) of the vectors nearest to each centroid. A task adds up its own vectors."""
    names = [f"s{k}" for k in range(points.shape[1])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(points), np.int64), np.zeros(points.shape, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            some = _matrix(batch.column("vector"), np.int64)
            which, _, _ = nearest(some, _matrix(batch.column("to_pivots"), np.float64), points, pivots)
            order = np.argsort(which, kind="stable")
            found, begin, n = np.unique(which[order], return_index=True, return_counts=True)
            counts[found] += n
            sums[found] += np.add.reduceat(some[order], begin, axis=0)
        used = np.flatnonzero(counts)
        arrays = [pa.array(used.astype(np.int32)), pa.array(counts[used]), *(pa.array(sums[used, k]) for k in range(points.shape[1]))]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "n", *names])

    sent = vectors.select("vector", "to_pivots").mapInArrow(work, ", ".join(["cluster int", "n long", *(f"{s} long" for s in names)]))
    added = sent.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])
    return {r["cluster"]: (r["n"], [r[s] for s in names]) for r in added.collect()}


def _assigned(vectors: DataFrame, points: np.ndarray, pivots: np.ndarray) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                some, table = _matrix(batch.column("vector"), np.int64), _matrix(batch.column("to_pivots"), np.float64)
                which, best, _ = nearest(some, table, points, pivots)
                arrays = [batch.column("id"), pa.array(which.astype(np.int32)), pa.array(best)]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "cluster", "distance"])

    return vectors.mapInArrow(work, "id long, cluster int, distance long")
