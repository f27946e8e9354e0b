"""Centroid clustering of integer vectors in JVM expressions.

Components become integers, floor(scale * x). A vector's distance to a centroid is an ``aggregate``
over a ``zip_with`` against the centroid as a literal array; ``array_min`` over structs (distance,
number) takes the nearest, ties to the smaller number. A round is one grouped aggregate: a row per
cluster with a count and a sum per component, partially summed before the shuffle, so a cluster
with most of the rows costs no more than another. Only those k rows reach the driver, which takes
exact floors of sum / count; the next round's plan holds them as literals. A round that moves no
centroid ends the rounds: all later ones would repeat it.

The integer vectors are written once to the shared folder and every round reads that table, as is
the final assignment, from which the inertias are summed.

Defined results: vectors that are null, have another number of components than ``dims``, or hold a
null or non-finite component take no part. Integer components are held to +-2**27 (x of +-131072 at
a scale of 1024), so that a distance always fits 64 bits; an inertia beyond 64 bits is their largest
number. Rows that repeat an id are vectors of their own. Start centroids with equal hashes go by
their components, a null id is last; if two start alike, the later stays empty, where it began. With
fewer vectors than k every one of them starts a centroid; no rows give no rows. Only the id and the
vector are read, other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import written

#: Components are held to this; 64 * (2 * LARGEST)**2 fits 64 bits.
LARGEST = 1 << 27


def integers(vectors: DataFrame, vec_id: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, q array<long>) of the vectors that take part."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    whole = rows.where(
        (F.size("x") == dims) & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    number = lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST))
    return whole.select("id", F.transform("x", number).alias("q"))


def nearest(centroids: list[list[int]]) -> F.Column:
    """struct(distance long, cluster int) of the nearest centroid to column ``q``."""
    options = []
    for number, centroid in enumerate(centroids):
        literal = "array(" + ", ".join(f"{c}L" for c in centroid) + ")"
        distance = f"aggregate(zip_with(q, {literal}, (x, c) -> (x - c) * (x - c)), 0L, (s, d) -> s + d)"
        options.append(f"named_struct('distance', {distance}, 'cluster', {number})")
    return F.expr(f"array_min(array({', '.join(options)}))")


def start(points: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest hash of salt and id."""
    by = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    return [list(r["q"]) for r in points.orderBy(by.asc_nulls_last(), "q").select("q").limit(k).collect()]


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round; at most one row per centroid comes to the driver."""
    sums = [F.sum(F.col("q")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    rows = points.select("q", nearest(centroids)["cluster"].alias("cluster")).groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()
    out = list(centroids)
    for r in rows:
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(len(sums))]
    return out


def cluster(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
    k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, salt: str = "3:",
) -> DataFrame:
    """(vec_id, cluster int, distance, cluster_inertia, inertia long, centroid array<long>) per vector."""
    points = written(integers(vectors, vec_id, vector, dims, scale), "integer-vectors")
    centroids = start(points, k, salt)
    if not centroids:
        empty = "cast(null as int) cluster", "0L distance", "0L cluster_inertia", "0L inertia", "q centroid"
        return points.selectExpr("id vec_id", *empty)
    for _ in range(rounds):
        before, centroids = centroids, moved(points, centroids)
        if centroids == before:
            break
    assigned = written(points.select("id", nearest(centroids).alias("best")).select("id", "best.*"), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(total).collect()}
    fits = lambda x: f"{min(x, (1 << 63) - 1)}L"
    of_cluster = F.expr("array(" + ", ".join(fits(inertia.get(i, 0)) for i in range(len(centroids))) + ")")
    places = F.expr("array(" + ", ".join("array(" + ", ".join(f"{c}L" for c in q) + ")" for q in centroids) + ")")
    return assigned.select(
        F.col("id").alias("vec_id"), "cluster", "distance", F.element_at(of_cluster, F.col("cluster") + 1).alias("cluster_inertia"),
        F.expr(fits(sum(inertia.values()))).alias("inertia"), F.element_at(places, F.col("cluster") + 1).alias("centroid"),
    )
