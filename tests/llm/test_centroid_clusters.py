import hashlib
import math

import numpy as np
import pytest

from lodgegrid.llm.centroid_clusters import LIMIT, cluster, nearest, op12_centroid_clusters, whole_vectors

from .conftest import FOLDER

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, vector string"


@pytest.mark.parametrize("reach", [1, 2, 5, 1000, 10**6])
def test_nearest_against_brute_force(reach):
    rng = np.random.default_rng(reach)
    for _ in range(40):
        width = rng.integers(1, 9)
        vectors = rng.integers(-reach, reach + 1, (rng.integers(1, 200), width))
        centroids = rng.integers(-reach, reach + 1, (rng.integers(1, 17), width))
        distance = ((vectors[:, None] - centroids[None]) ** 2).sum(-1)
        number, best, measured = nearest(vectors, centroids)
        assert number.tolist() == distance.argmin(1).tolist() and best.tolist() == distance.min(1).tolist()
        assert measured <= distance.size


def test_walk_stops_early_and_only_then():
    centroids = np.array([[1000 * i, 1000 * i] for i in range(16)])
    vectors = np.array([[1003, 998], [7001, 7000], [500, 500]])
    number, best, measured = nearest(vectors, centroids)
    assert number.tolist() == [1, 7, 0] and best.tolist() == [13, 1, 500_000]
    assert measured < 12  # of 48
    # 1 and 0 are at the same distance; the walk meets 1 first and must go on
    assert nearest(np.array([[0, 0]]), np.array([[4, 3], [0, 5], [0, 5]]))[0].tolist() == [0]
    # the longest distance there is
    far = nearest(np.full((1, 64), LIMIT), np.full((1, 64), -LIMIT))[1]
    assert far.tolist() == [64 * (2 * LIMIT) ** 2]


def python_clusters(rows, k=16, rounds=3, width=64):
    kept = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows
            if e is not None and len(e) == width and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def find(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [find(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            some = [v for (_, v), c in zip(kept, own) if c == n]
            if some:
                centroids[n] = [sum(x) // len(some) for x in zip(*some)]
    out = [(i, find(v)[1], find(v)[0]) for i, v in kept]
    every = sum(r[2] for r in out)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, sum(r[2] for r in out if r[1] == n), every, digest[n]) for i, n, d in out), key=repr)


def test_whole_table_against_python(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = sorted((tuple(r) for r in op12_centroid_clusters(spark, FOLDER).collect()), key=repr)
    assert found == python_clusters(rows)


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=64).tolist()) for i in range(40)]
    hot = [(100 + i, [0.5] * 64) for i in range(60)]
    odd = [(200, None), (201, []), (202, [0.1] * 63), (203, [0.1] * 65), (204, [None] + [0.1] * 63),
           (205, [float("nan")] * 64), (206, [float("inf")] + [0.0] * 63), (207, [float("-inf")] + [0.0] * 63)]
    kept = [*good, *hot, good[0], (None, [0.25] * 64), (7, [-0.01] * 64)]
    rows = [*kept, *odd]
    spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    table = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    as_read = [(r.vec_id, r.embedding) for r in table.collect()]
    found = sorted((tuple(r) for r in op12_centroid_clusters(spark, str(tmp_path)).collect()), key=repr)
    assert found == python_clusters(as_read) and len(found) == len(kept)
    few = table.filter("vec_id < 5")
    assert cluster(few)[0].count() == 6 and len(cluster(few)[1]) == 6
    none, centroids = cluster(table.filter("vec_id between 200 and 207"))
    assert none.count() == 0 and len(centroids) == 0 and "cluster" in none.columns


def test_clamped_components(spark):
    table = spark.createDataFrame([(1, [3e38] * 64, 1, 1, "x"), (2, [-3e38] * 64, 1, 1, "x")], SCHEMA)
    assert sorted(r.vector[0] for r in whole_vectors(table).collect()) == [-LIMIT, LIMIT]
    found, _ = cluster(table, k=1)
    assert found.count() == 2


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op12_centroid_clusters(spark, str(tmp_path)).count() == 0
