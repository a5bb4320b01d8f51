"""Centroid clustering of whole-number vectors; the nearest centroid by the threshold algorithm.

Every dimension has the list of its centroids sorted by their value there. For a vector the lists are
walked outward from its own value, one centroid a dimension and step, the nearer of the two ends first. A
centroid met for the first time gets its exact distance. What no list has shown yet is at least as far as
the *frontier*: the sum over the dimensions of the squared difference last met. The walk stops when that
sum strictly exceeds the best exact distance, so a centroid at the same distance with a smaller number is
still met. The vectors of a block walk together in NumPy; those that have stopped leave it.

Assigning needs no shuffle. A task sums its own vectors by centroid, so a round sends one row per task
and centroid, however many vectors are equal, and the driver gets the centroids, ``k`` rows.

Cases
-----
* Vectors that are NULL, have another number of components, or a NULL or non-finite one are left out.
* Components are clamped to +-2^27, within which the squared distance of 64 components fits a long;
  ``cluster_inertia`` and ``inertia`` end at the greatest long.
* A NULL ``vec_id`` is clustered but seeds nothing while there are others; equal seeds' hashes (repeated
  ids) are taken in the order of the components. Repeated rows count one by one.
* Fewer vectors than ``k`` give fewer centroids; no vectors give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodgegrid.session import cut_lineage

COMPONENTS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
BLOCK_ROWS = 2048
LIMIT = 1 << 27
LONG_MAX = (1 << 63) - 1


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how many distances it took."""
    n, k = len(vectors), len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T  # by dimension, numbers in order of value
    value = np.take_along_axis(centroids.T, order, axis=1)
    dims = np.arange(centroids.shape[1])
    best = np.full(n, LONG_MAX, dtype=np.int64)
    number = np.full(n, k, dtype=np.int64)
    seen = np.zeros((n, k), dtype=bool)
    # the next centroid to the right of the own value, and to its left
    right = np.empty((n, len(dims)), dtype=np.int64)
    for d in dims:
        right[:, d] = np.searchsorted(value[d], vectors[:, d])
    left = right - 1
    walking, measured = np.arange(n), 0
    for _ in range(k):
        own = vectors[walking]
        far_left = np.where(left >= 0, own - value[dims, np.maximum(left, 0)], LONG_MAX)
        far_right = np.where(right < k, value[dims, np.minimum(right, k - 1)] - own, LONG_MAX)
        to_left = far_left <= far_right
        met = order[dims, np.where(to_left, left, np.minimum(right, k - 1))]
        frontier = (np.minimum(far_left, far_right) ** 2).sum(axis=1)
        left, right = left - to_left, right + ~to_left
        now = np.zeros((len(walking), k), dtype=bool)
        now[np.arange(len(walking))[:, None], met] = True
        row, centre = np.nonzero(now & ~seen[walking])
        seen[walking[row], centre] = True
        measured += len(row)
        distance = np.full((len(walking), k), LONG_MAX, dtype=np.int64)
        distance[row, centre] = ((own[row] - centroids[centre]) ** 2).sum(axis=1)
        first = distance.argmin(axis=1)  # the smallest number among equals
        least = distance[np.arange(len(walking)), first]
        better = (least < best[walking]) | ((least == best[walking]) & (first < number[walking]))
        best[walking[better]], number[walking[better]] = least[better], first[better]
        on = frontier <= best[walking]
        walking, left, right = walking[on], left[on], right[on]
        if not len(walking):
            break
    return number, best, measured


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield part, part["vector"].flatten().to_numpy().reshape(-1, width).astype(np.int64)


def whole_vectors(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, vector``: the complete finite vectors, each component as ``floor(scale * x)``."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    kept = table.filter((F.size(x) == components) & finite)

    def whole(v: Column) -> Column:
        product = F.lit(float(scale)) * v.cast("double")
        return F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), product)))

    return kept.select("vec_id", F.transform(x, whole).alias("vector"))


def seeds(vectors: DataFrame, k: int = CENTROIDS, seed: int = 1) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``seed:vec_id``."""
    own = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r.vector for r in vectors.select(own.alias("h"), "vector").orderBy(
        F.col("h").asc_nulls_last(), "vector").limit(k).collect()]


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of its vectors' mean; those without vectors stay."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # components stay below 2^28, so a task's sums fit for 2^35 vectors
        count, total = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for _, own in _blocks(batches, width):
            number, _, _ = nearest(own, centroids)
            count += np.bincount(number, minlength=len(centroids))
            np.add.at(total, number, own)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(count[some], pa.int64()),
             pa.array(total[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    parts = vectors.select("vector").mapInArrow(run, "cluster long, n long, total array<long>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("component", "part"))
    out = centroids.copy()
    # k * width rows
    for r in each.groupBy("cluster", "component").agg(
            F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        out[r.cluster, r.component] = int(r.total) // r.n
    return out


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``: the nearest centroid of every vector."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _blocks(batches, width):
            number, best, _ = nearest(own, centroids)
            yield pa.RecordBatch.from_arrays(
                [part["vec_id"], pa.array(number, pa.int32()), pa.array(best, pa.int64())],
                ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(
    table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, components: int = COMPONENTS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every complete vector of ``table``, and the final centroids."""
    vectors = whole_vectors(table, components, scale)
    centroids = np.array(seeds(vectors, k), dtype=np.int64).reshape(-1, components)
    if not len(centroids):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return assigned(vectors, centroids), centroids


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found, centroids = cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))
    found = cut_lineage(found, "assigned")
    # a row per cluster, k at most
    own = {r.cluster: int(r.own) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    every = min(sum(own.values()), LONG_MAX)
    rows = [(i, min(own[i], LONG_MAX), every, ",".join(map(str, c)))
            for i, c in enumerate(centroids.tolist()) if i in own]
    clusters = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, components string")
    return found.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("components", 256).alias("centroid_sha256"))


# Rounds over exact whole numbers, one query each; a mean is floored by its remainder, sign and all.
_ASSIGN = """
d{n} AS (
    SELECT v.vec_id, v.row, v.q, c.cluster,
           list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM vectors v CROSS JOIN c{n} c),
a{n} AS (
    SELECT * FROM d{n} QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1)"""
_MOVE = """,
s{n} AS (
    SELECT cluster, i, sum(q[i]) AS s, count(*) AS m FROM a{n}, range(1, {stop}) AS r(i) GROUP BY cluster, i),
m{n} AS (
    SELECT cluster, list(((s - ((s % m) + m) % m) // m)::BIGINT ORDER BY i) AS q FROM s{n} GROUP BY cluster),
c{next} AS (
    SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{n} c LEFT JOIN m{n} m ON m.cluster = c.cluster),"""

OP12_SQL = f"""
WITH vectors AS (
    SELECT vec_id, row_number() OVER () AS row,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
    FROM embeddings
    WHERE len(embedding) = {COMPONENTS}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS (
    SELECT (row_number() OVER (ORDER BY h, q) - 1)::INTEGER AS cluster, q
    FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS h, q FROM vectors ORDER BY h, q LIMIT {CENTROIDS})),""" + "".join(
    _ASSIGN.format(n=n) + _MOVE.format(n=n, next=n + 1, stop=COMPONENTS + 1) for n in range(ROUNDS)
) + _ASSIGN.format(n=ROUNDS) + f"""
SELECT a.vec_id, a.cluster, a.distance,
       (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c ON c.cluster = a.cluster"""
