"""Centroid clustering whose nearest-centroid search runs on Walsh-Hadamard coefficients.

Vectors are cut to integers. The Walsh-Hadamard transform of integers needs additions
only, so it is exact, and it keeps distances up to the factor of its size: the sum of
the squared differences of all coefficients is ``dimension`` times the squared
distance. Coefficients are taken from the coarsest (fewest sign changes) to the finest.
What has been summed up is a lower bound of the whole, so a centroid whose sum is
already above a whole distance of the same vector is strictly worse and is dropped.
The others are summed to the last coefficient, which makes ties exact as well.

Spark holds the vectors. Each round is one pass over them: a task adds up its vectors
by centroid, Spark adds up the tasks' sums, and only the centroids, ``clusters`` times
``dimension`` integers, come to the driver. No vector moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeep.llm.shared import free_name, stored

#: Up to this size of a component all sums of the search fit into 64 bits; beyond, Python's integers are used.
_FITS = 1 << 24
#: Vectors searched together in one task.
_TOGETHER = 4096


@lru_cache(maxsize=4)
def _by_sign_changes(dimension: int) -> np.ndarray:
    """The rows of the Hadamard matrix from the fewest sign changes to the most."""
    if dimension < 1 or dimension & (dimension - 1):
        raise ValueError(f"a Walsh-Hadamard transform needs a power of two, not {dimension}")
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < dimension:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return np.argsort((matrix[:, 1:] != matrix[:, :-1]).sum(axis=1), kind="stable")


def walsh(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, coarse coefficients first; exact for integers."""
    n, dimension = rows.shape
    order = _by_sign_changes(dimension)
    out, half = rows, 1
    while half < dimension:
        pairs = out.reshape(n, dimension // (2 * half), 2, half)
        one, two = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack((one + two, one - two), axis=2).reshape(n, dimension)
        half *= 2
    return out[:, order]


def _levels(dimension: int) -> list[tuple[int, int]]:
    """Coefficients in steps that double: the first, the second, two more, four more and so on."""
    ends = [1 << i for i in range(dimension.bit_length())]
    return list(zip([0, *ends[:-1]], ends))


def nearest_centroids(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each vector, ties to the smaller number; and how many differences were taken.

    Both are integers in rows of one length, a power of two.
    """
    largest = max((int(abs(a).max()) for a in (vectors, centroids) if a.size), default=0)
    kind = np.int64 if largest <= _FITS else object
    dimension = vectors.shape[1]
    spectrum, of_centroids = walsh(vectors.astype(kind)), walsh(centroids.astype(kind))
    n, k = len(vectors), len(centroids)
    difference = lambda v, c, lo, hi: ((spectrum[v, lo:hi] - of_centroids[c, lo:hi]) ** 2).sum(axis=1)
    levels = _levels(dimension)

    # the centroid nearest by its coarse coefficients gives a first whole distance
    coarse = min(4, len(levels))
    first = levels[coarse - 1][1]
    sums = np.zeros((n, k), kind)
    for at in range(first):
        sums += (spectrum[:, at, None] - of_centroids[None, :, at]) ** 2
    guess = np.argmin(sums, axis=1)
    everyone = np.arange(n)
    bound = sums[everyone, guess] + difference(everyone, guess, first, dimension)
    taken = n * k * first + n * (dimension - first)

    v, c = np.nonzero(sums <= bound[:, None])
    so_far = sums[v, c]
    for lo, hi in levels[coarse:]:
        so_far = so_far + difference(v, c, lo, hi)
        taken += len(v) * (hi - lo)
        alive = so_far <= bound[v]
        v, c, so_far = v[alive], c[alive], so_far[alive]
    # what is left has all its coefficients; pairs lie in the order of vectors, then centroids
    best = np.full(n, bound)
    np.minimum.at(best, v, so_far)
    least = so_far == best[v]
    v, c = v[least], c[least]
    chosen = np.empty(n, np.int64)
    chosen[v[::-1]] = c[::-1]
    return chosen, best // dimension, taken


def integer_vectors(df: DataFrame, *, vec_id: str, vector: str, dimension: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dimension`` finite components, each ``floor(scale * x)`` of its double."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(doubles, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    kept = df.filter((F.size(vector) == dimension) & finite)
    return kept.select(F.col(vec_id).alias("vec_id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, seed: Column) -> list[tuple[int, ...]]:
    """The vectors of the smallest seeds in order, equal seeds by their components, null seeds last."""
    drawn = vectors.select(seed.alias("seed"), "v").orderBy(F.col("seed").asc_nulls_last(), "v").limit(clusters).collect()
    return [tuple(r["v"]) for r in drawn]


def _rows_of(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)


def _searched(batches: Iterator[pa.RecordBatch], centroids: list[tuple[int, ...]], dimension: int):
    """(part of a batch, its vectors, centroids, distances)."""
    points = np.array(centroids, np.int64).reshape(-1, dimension)
    for batch in batches:
        for at in range(0, batch.num_rows, _TOGETHER):
            part = batch.slice(at, _TOGETHER)
            rows = _rows_of(part, dimension)
            chosen, distance, _ = nearest_centroids(rows, points)
            yield part, rows, chosen, distance


def improve(vectors: DataFrame, centroids: list[tuple[int, ...]], dimension: int) -> list[tuple[int, ...]]:
    """The floor of the mean of each centroid's vectors, component by component; one without vectors stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * dimension for _ in centroids]
        counts = [0] * len(centroids)
        for _, rows, chosen, _ in _searched(batches, centroids, dimension):
            wide = abs(rows).max(initial=0) > _FITS
            for c in np.unique(chosen).tolist():
                own = rows[chosen == c]
                counts[c] += len(own)
                added = (own.astype(object) if wide else own).sum(axis=0).tolist()
                sums[c] = [a + b for a, b in zip(sums[c], added)]
        seen = [c for c, n in enumerate(counts) if n]
        columns = [pa.array(seen, pa.int32()), pa.array([counts[c] for c in seen], pa.int64())]
        columns += [pa.array([str(sums[c][i]) for c in seen], pa.string()) for i in range(dimension)]
        yield pa.record_batch(columns, names=["cluster", "n", *(f"s{i}" for i in range(dimension))])

    schema = "cluster int, n long, " + ", ".join(f"s{i} string" for i in range(dimension))
    added = vectors.select("v").mapInArrow(run, schema).groupBy("cluster").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(dimension))
    )
    new = list(centroids)
    for r in added.collect():  # a row for each centroid at most
        new[r["cluster"]] = tuple(int(r[f"s{i}"]) // r["n"] for i in range(dimension))
    return new


def assign(vectors: DataFrame, centroids: list[tuple[int, ...]], dimension: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, chosen, distance in _searched(batches, centroids, dimension):
            columns = [part.column("vec_id"), pa.array(chosen.astype(np.int32)), pa.array(distance.tolist(), pa.int64())]
            yield pa.record_batch(columns, names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def digest(centroid: tuple[int, ...]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    df: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    dimension: int = 64,
    scale: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    seed: Column | None = None,
) -> DataFrame:
    """A row for each vector that takes part: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``.

    Vectors that are null, of another length, or with a null or non-finite component
    take no part. The first centroids are the ``clusters`` vectors of smallest ``seed``
    (by default the SHA-256 of ``1:<vec_id>``); equal seeds go by their components, and
    a null id's seed comes last. With fewer vectors there are fewer centroids. Repeated
    rows and repeated ids count as often as they occur, a null id like any other. An
    empty table, or one in which no vector takes part, gives no rows. Other columns are
    not looked at. All sums are exact; a component or a distance that no long can hold
    fails the job. ``dimension`` is a power of two.
    """
    _by_sign_changes(dimension)
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256) if seed is None else seed
    vectors = stored(integer_vectors(df, vec_id=vec_id, vector=vector, dimension=dimension, scale=scale))
    points = first_centroids(vectors, clusters, key)
    for _ in range(rounds if points else 0):
        points = improve(vectors, points, dimension)
    assigned = stored(assign(vectors, points, dimension))
    summed = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # a row a centroid
    of_cluster = {r["cluster"]: int(r["d"]) for r in summed}
    said = [(c, d, sum(of_cluster.values()), digest(points[c])) for c, d in sorted(of_cluster.items())]
    number = free_name(assigned, "_cluster")
    facts = df.sparkSession.createDataFrame(said, f"{number} int, cluster_inertia long, inertia long, centroid_sha256 string")
    # as many rows as centroids
    return assigned.join(F.broadcast(facts), F.col("cluster") == F.col(number)).drop(number)
