"""Centroid clustering of vectors in integer column expressions.

A vector becomes whole numbers, ``floor(scale * x)``, so every sum is exact and no
result depends on the order of addition. The centroids are literal arrays of the
plan: ``zip_with`` and ``aggregate`` give the squared distance to each,
``array_min`` over (distance, number) chooses the cluster, and a round's new centroids are
one sum for each component, combined map-side. A shuffle holds one row for each
cluster and task; the driver sees ``clusters`` times ``dim`` numbers a round, whatever
the number of vectors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
#: Largest whole number of a component: squared distances of 64 of them fit 64 bits.
MOST = 1 << 27


def quantised(vectors: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding",
              dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, cells: vectors of ``dim`` sound components as whole numbers; other rows go.

    A null vector, another length, a null or non-finite component: the row goes.
    Components are cut to plus or minus MOST after scaling (524,288 before it, at a scale of 256).
    """
    x = F.col(embedding_col).cast("array<double>")
    sound = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * float(scale), F.lit(float(MOST))), F.lit(-float(MOST)))))
    return vectors.select(F.col(id_col).alias("vec_id"), F.when(sound, whole).alias("cells")).where("cells IS NOT NULL")


def first_centroids(cells: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest hash of seed and id; equal ids go by their components, null ids last."""
    spot = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return [list(r["cells"]) for r in cells.orderBy(spot.asc_nulls_last(), "cells").limit(clusters).collect()]


def nearest(cells: Column, centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid; of equal distances, the smaller number."""
    table = F.expr("array(" + ", ".join("array(" + ", ".join(f"{v}L" for v in c) + ")" for c in centroids) + ")")

    def apart(centroid: Column, number: Column) -> Column:
        gaps = F.zip_with(cells, centroid, lambda a, b: a - b)
        return F.struct(F.aggregate(gaps, F.lit(0).cast("long"), lambda s, d: s + d * d).alias("distance"),
                        number.alias("cluster"))

    return F.array_min(F.transform(table, apart))


def moved(cells: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: the floor of each cluster's mean; empty clusters stay."""
    dim = len(centroids[0])
    sums = cells.select(nearest(F.col("cells"), centroids)["cluster"].alias("cluster"), "cells").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.col("cells")[i]).alias(f"s{i}") for i in range(dim)))
    out = list(centroids)
    for r in sums.collect():
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dim)]
    return out


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = SEED, id_col: str = "vec_id", embedding_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every sound vector.

    Repeated rows count each. Fewer sound vectors than ``clusters`` give as many
    centroids, and none of them an empty table. Only the two named columns are read.
    An inertia beyond 64 bits is null.
    """
    cells = stage(quantised(vectors, id_col, embedding_col, dim, scale))
    centroids = first_centroids(cells, clusters, seed)
    if not centroids:
        return cells.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                                "'' AS centroid_sha256")
    for _ in range(rounds):
        centroids = moved(cells, centroids)
    told = stage(cells.select("vec_id", nearest(F.col("cells"), centroids).alias("to")).select(
        "vec_id", "to.cluster", "to.distance"))
    held = dict.fromkeys(range(len(centroids)), 0)
    for r in told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect():
        held[r["cluster"]] = int(r["sum"])

    def fits(n: int) -> Column:
        return F.lit(n if n < 1 << 63 else None).cast("long")

    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    at = F.col("cluster")
    return told.select(
        "vec_id", "cluster", "distance", F.array(*map(fits, held.values()))[at].alias("cluster_inertia"),
        fits(sum(held.values())).alias("inertia"), F.array(*map(F.lit, prints))[at].alias("centroid_sha256"))
