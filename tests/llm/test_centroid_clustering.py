import hashlib
import math

import pytest

from tablewise.llm import centroid_clustering as op

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, dims, scale, k, rounds, seed):
    """``(id, cluster, distance, cluster inertia, inertia, centroid)`` of the vectors kept."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    by_hash = sorted(kept, key=lambda r: (hashlib.sha256(
        f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in by_hash[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
                for _, v in kept]

    for _ in range(rounds):
        found = assigned()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assigned()
    total = sum(d for d, _ in found)
    return [(i, c, d, sum(x for x, y in found if y == c), total, centres[c])
            for (i, _), (d, c) in zip(kept, found)]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def vectors():
    def noise(i, j):
        h = hashlib.sha256(f"{i}/{j}".encode()).digest()
        return int.from_bytes(h[:4], "big") / 2 ** 31 - 1.0
    rows = [(i, [noise(i, j) + (i % 5) * (j == i % 4) for j in range(4)]) for i in range(120)]
    rows += [(200, None), (201, []), (202, [1.0] * 3), (203, [1.0, None, 0.0, 0.0]),
             (204, [float("nan")] * 4), (205, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.1] * 4),
             (None, [-0.1] * 4), (7, [0.5] * 4), (7, [0.5] * 4), (300, [-1e-9] * 4)]
    return rows + [(400 + i, [2.0] * 4) for i in range(150)]          # a hot point


@pytest.mark.parametrize("k,rounds", [(8, 10), (3, 0)])
def test_against_brute_force(spark, k, rounds):
    docs = spark.createDataFrame(vectors(), SCHEMA).repartition(5).selectExpr(
        "*", "'x' as v", "1 as cluster", "2 as __id", "3 as distance", "4 as n")
    got = op.clustered(docs, dims=4, k=k, rounds=rounds).collect()
    want = brute(vectors(), 4, op.SCALE, k, rounds, op.SEED)
    assert order((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid)
                 for r in got) == order(want)


def test_fewer_vectors_than_clusters(spark):
    rows = [(i, [0.25 * i, -0.5 * i]) for i in range(5)]
    got = op.clustered(spark.createDataFrame(rows, SCHEMA), dims=2, k=8, rounds=3).collect()
    assert order((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid)
                 for r in got) == order(brute(rows, 2, op.SCALE, 8, 3, op.SEED))


def test_ties_go_to_the_smaller_number(spark):
    rows = spark.createDataFrame([(1, [0])], "__id long, v array<long>")
    got = op.assign(rows, [[3], [-3], [3]]).first()
    assert (got.cluster, got.distance) == (0, 9)


def test_empty_cluster_keeps_its_centroid(spark):
    rows = spark.createDataFrame([(1, [0]), (2, [1])], "__id long, v array<long>")
    assert op.next_centroids(rows, [[0], [900]]) == [[0], [900]]


def test_floor_of_negative_sums(spark):
    rows = spark.createDataFrame([(1, [-1]), (2, [-2])], "__id long, v array<long>")
    assert op.next_centroids(rows, [[0]]) == [[-2]]


def test_empty_and_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert op.clustered(none).count() == 0
    with pytest.raises(ValueError):
        op.clustered(spark.createDataFrame([(1, [1e30, 0.0])], SCHEMA), dims=2)


def test_stays_in_the_jvm(spark, sf001):
    plan = op.op11_centroid_clustering(spark, sf001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
