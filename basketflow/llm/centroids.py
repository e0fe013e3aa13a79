"""Centroid clustering of integer vectors with JVM-native expressions.

Vectors of the wanted length become integers, floor(scale * x), written once. The k start centroids are the vectors
with the smallest digest of their id. A round is one projection and one aggregate: zip_with and aggregate give the
integer squared distance to each centroid (a literal array of the plan), array_min of (distance, number) structs chooses
the cluster, and one sum per component, combined map-side, gives the new centroids. The driver holds k centroids and
k rows of sums, whatever the number of vectors; a cluster with a third of all rows is one partial row per task. Nothing
is shuffled but these rows, and a lost executor costs the tasks of the current pass.

All arithmetic is exact in longs; with components beyond 2^21 (scale 64) or sums beyond 2^63 Spark raises an overflow
rather than return a wrong result.

Results for odd input: vectors that are null, of another length or with a null or non-finite component are left out;
a null id comes last among the start vectors; rows that share an id are vectors of their own, and where they tie for
a start the smaller vector goes first; with fewer than k vectors there are fewer centroids; an empty cluster keeps its
centroid; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import Stages

DIMS = 64
SCALE = 64
K = 16
ROUNDS = 3
SALT = "1"


def integer_vectors(vectors: DataFrame, dims: int | None, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * component) of every vector without null or non-finite components.

    ``dims`` is the length to keep (None: any).
    """
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = v.isNotNull() & finite if dims is None else v.isNotNull() & (F.size(v) == dims) & finite
    return vectors.where(whole).select(F.col(vec_id).cast("long").alias("vec_id"),
                                       F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("x"))


def _literal(values) -> Column:
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")


def start_centroids(x: DataFrame, k: int = K, salt: str = SALT) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 (hex) of ``salt:vec_id``; k rows reach the driver."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.x) for r in x.orderBy(digest.asc_nulls_last(), "x").limit(k).collect()]


def nearest(centroids: list[list[int]]) -> Column:
    """The struct (distance, cluster) of the nearest centroid of column x; of equals the smaller number."""
    def distance(c):
        squares = F.zip_with("x", _literal(c), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0).cast("long"), lambda total, s: total + s)
    return F.array_min(F.array(*[F.struct(distance(c).alias("distance"), F.lit(j).alias("cluster")) for j, c in enumerate(centroids)]))


def moved(x: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; one row of sums per cluster reaches the driver."""
    dims = len(centroids[0])
    sums = (x.select(nearest(centroids)["cluster"].alias("cluster"), *[F.col("x")[i].alias(f"x{i}") for i in range(dims)])
            .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(dims)]))
    new = list(centroids)
    for r in sums.collect():
        new[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]  # Python integers: exact, rounded down
    return new


def fit(x: DataFrame, k: int = K, rounds: int = ROUNDS, salt: str = SALT) -> list[list[int]]:
    centroids = start_centroids(x, k, salt)
    for _ in range(rounds if centroids else 0):
        centroids = moved(x, centroids)
    return centroids


def cluster(vectors: DataFrame, stages: Stages, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) of every kept vector."""
    x = stages.write(integer_vectors(vectors, dims, scale, vec_id, vector), "x")
    centroids = fit(x, k, rounds, salt)
    if not centroids:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"),
                                                           ("centroid", "array<bigint>"), ("centroid_sha256", "string"))]
        return x.select("vec_id", *none)
    placed = stages.write(x.select("vec_id", nearest(centroids).alias("c")).select("vec_id", "c.cluster", "c.distance"), "placed")
    inertia = [0] * len(centroids)  # one row per cluster
    for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect():
        inertia[r.cluster] = r.s
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = lambda array: F.get(array, F.col("cluster"))
    return placed.select("vec_id", "cluster", "distance", at(_literal(inertia)).alias("cluster_inertia"), F.lit(sum(inertia)).cast("long").alias("inertia"),
                         at(F.array(*[_literal(c) for c in centroids])).alias("centroid"), at(F.array(*map(F.lit, digests))).alias("centroid_sha256"))
