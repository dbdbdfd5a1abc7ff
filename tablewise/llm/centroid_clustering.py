"""Centroid clustering of vectors in whole numbers, by expressions that stay in the JVM.

A vector of doubles becomes the long array ``floor(scale * x)``.  The centroids of a round are
literal long arrays; ``zip_with`` and ``aggregate`` give the squared distance of a vector to each of
them, ``array_min`` over ``struct(distance, number)`` picks the nearest (ties: the smaller number),
and one aggregate of ``dims`` column sums and a count per cluster gives the next centroids
(exact floor of sum by count; an empty cluster keeps its centroid).  Whole numbers make the result
independent of the order in which rows are added.

The whole-number vectors are written to the shared folder once and read by every round.  A round
shuffles one row per task and cluster (map-side sums, so one cluster may hold any share of the
rows); ``k * (dims + 1)`` numbers reach the driver.  Rounds end early once the centroids stay,
as every further round would repeat them.

Defined results: vectors that are null, of another length, or hold a null, NaN or infinite
component are left out.  Repeated rows count each time and get equal results.  A null id stays
null (its seed text is that of an empty id).  Equal seed hashes go by the vector.  With fewer than
``k`` vectors there are as many centroids as vectors; without any the result is empty.  Components
beyond ``LARGEST`` whole units cannot give exact long distances: such a table is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewise.llm.common import ID, column, cut, load, register

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
LARGEST = 1 << 27            # dims * (2 * LARGEST)^2 is below 2^63 for up to 64 dims


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``__id, v array<bigint>`` of the vectors kept."""
    v = column(vector_col).cast("array<double>")
    kept = vectors.select(column(id_col).cast("bigint").alias(ID), v.alias("v")).where(
        (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < F.lit(float("inf")))))
    most = F.array_max(F.transform("v", lambda x: F.abs(x * F.lit(float(scale)))))
    return kept.select(ID, F.when(most <= LARGEST, F.transform(
        "v", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))).alias("v"))


def seeds(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``seed:id``, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(ID).cast("string"), F.lit("")))
    return [r.v for r in rows.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v")
            .limit(k).select("v").collect()]


def longs(values: list[int]) -> Column:
    """A literal long array (as SQL text: one call to the JVM, not one per number)."""
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def distance(v: Column, centroid: list[int]) -> Column:
    """Squared distance to a literal centroid."""
    return F.aggregate(F.zip_with(v, longs(centroid), lambda a, b: a - b),
                       F.lit(0).cast("bigint"), lambda total, d: total + d * d)


def nearest(v: Column, centroids: list[list[int]]) -> Column:
    """``struct(distance, cluster)`` of the nearest centroid."""
    return F.array_min(F.array(*[
        F.struct(distance(v, c).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centroids)]))


def next_centroids(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: column sums of each cluster, divided with exact floor."""
    dims = len(centroids[0])
    found = (rows.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
             .groupBy("cluster")
             .agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}")
                                             for i in range(dims)]).collect())
    out = [list(c) for c in centroids]
    for r in found:
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return out


def fit(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS,
        seed: int = SEED) -> list[list[int]]:
    """Centroids after ``rounds`` rounds over ``whole_vectors`` rows."""
    centroids = seeds(rows, k, seed)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(rows, centroids)
        if moved == centroids:
            break
        centroids = moved
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``__id, cluster, distance`` of every row."""
    return (rows.select(ID, nearest(F.col("v"), centroids).alias("c"))
            .select(ID, "c.cluster", "c.distance"))


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              dims: int = DIMS, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS,
              seed: int = SEED) -> DataFrame:
    """``id_col, cluster, distance, centroid, cluster_size, cluster_inertia, inertia`` of every
    vector kept; ``centroid`` is the final centroid's array of whole numbers."""
    rows = cut(whole_vectors(vectors, id_col, vector_col, dims, scale), "whole-vectors")
    if not rows.where(F.col("v").isNull()).isEmpty():
        raise ValueError(f"a component is beyond {LARGEST / scale}: distances would not fit a long")
    centroids = fit(rows, k, rounds, seed)
    if not centroids:
        return rows.select(F.col(ID).alias(id_col), F.lit(0).alias("cluster"),
                           F.lit(0).cast("bigint").alias("distance"), F.col("v").alias("centroid"),
                           *[F.lit(0).cast("bigint").alias(c)
                             for c in ("cluster_size", "cluster_inertia", "inertia")]).limit(0)
    found = cut(assign(rows, centroids), "assigned")
    # one row per cluster: at most k rows
    per = {r.cluster: r for r in found.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("distance").alias("inertia")).collect()}
    at = F.col("cluster") + 1

    def of_cluster(name: str) -> Column:
        values = [per[i][name] if i in per else 0 for i in range(len(centroids))]
        return F.element_at(longs(values), at)

    centre = F.element_at(F.array(*[longs(c) for c in centroids]), at)
    return found.select(F.col(ID).alias(id_col), "cluster", "distance", centre.alias("centroid"),
                        of_cluster("n").alias("cluster_size"),
                        of_cluster("inertia").alias("cluster_inertia"),
                        F.lit(sum(r.inertia for r in per.values())).cast("bigint").alias("inertia"))


def _oracle() -> str:
    """One row per vector and component; every round is a chain of four tables."""
    parts = [f"""
w AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
      WHERE len(embedding) = {DIMS}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT r, vec_id, generate_subscripts(embedding, 1) AS i,
      cast(floor({SCALE} * cast(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM w),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(cast(vec_id AS VARCHAR), '')))
      - 1 AS c FROM w),
c0 AS MATERIALIZED (SELECT c, i, x FROM s JOIN v USING (r) WHERE c < {CLUSTERS})"""]
    for n in range(ROUNDS + 1):
        parts.append(f"""
d{n} AS (SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{n} c USING (i)
      GROUP BY v.r, c.c),
a{n} AS MATERIALIZED (SELECT r, min(d) AS d, arg_min(c, d * {CLUSTERS} + c) AS c FROM d{n} GROUP BY r)""")
        if n < ROUNDS:
            parts.append(f"""
m{n} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN v USING (r) GROUP BY c, i),
c{n + 1} AS MATERIALIZED (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, o.x) AS x
      FROM c{n} o LEFT JOIN m{n} USING (c, i))""")
    last = ROUNDS
    parts.append(f"""
h AS (SELECT c, sha256(string_agg(cast(x AS BIGINT), ',' ORDER BY i)) AS centroid_sha256
      FROM c{last} GROUP BY c)""")
    return "WITH" + ",".join(parts) + f"""
SELECT w.vec_id, cast(a.c AS INTEGER) AS cluster, cast(a.d AS BIGINT) AS distance,
       cast(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       cast(sum(a.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} a JOIN w USING (r) JOIN h USING (c)"""


@register("op11_centroid_clustering", _oracle())
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clustered(load(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256)
                      .alias("centroid_sha256"))


__all__ = ["whole_vectors", "fit", "assign", "clustered", "nearest", "next_centroids"]
