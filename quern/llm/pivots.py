"""Centroid clustering of integer vectors, with Ptolemaic lower bounds from pivots.

In a Euclidean space the distances of four points x, c, p, q satisfy Ptolemy's inequality, so
|d(x,p) d(c,q) - d(x,q) d(c,p)| / d(p,q) is at most d(x,c). A few vectors far apart are the pivots; every vector's
distances to them are computed once and stored beside it. A round computes the centroids' distances to the pivots, bounds
every vector's distance to every centroid by the largest value over the fixed pairs of pivots, and starts with the
centroid of the smallest bound. Other centroids are looked at in exact integers only where their bound doesn't exceed the
best distance so far. Bounds are lowered by more than rounding can have added, so equal distances are never left out.

Assignments of a round are not stored: each task gives the sums of its vectors by cluster and component, Spark adds them
up, and k times the number of components of integers come back as the next centroids.

Defined cases: vectors that are null, of another number of components, or that hold null or non-finite components take
no part; neither do those with a component whose integer has 28 bits or more, since their distances need not fit a long.
Repeated rows count each. A null id can't be hashed, so its vector comes last among the starting centroids; equal hashes
go by components. With fewer vectors than k there are as many clusters as vectors; empty clusters keep their centroid and
have no row; an empty table gives no rows; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.scratch import spread, stored

#: More than the relative rounding of the few operations behind a bound.
SLACK = 2.0**-46
#: Integers of larger components need not have distances that fit a long.
LARGEST = 1 << 27


def integers(vectors: DataFrame, id_column: str, column: str, dims: int, scale: float) -> DataFrame:
    """(vec_id, x): the vectors that take part, as floor(scale * component)."""
    v = F.col(column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(F.size("v") == dims)
    fine = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * scale) < LARGEST), F.lit(False)))
    return rows.where(fine).select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("int")).alias("x"))


def far_apart(pool: np.ndarray, count: int) -> np.ndarray:
    """Rows of pool: the first, then always the one farthest from those chosen; fewer if the others are equal to them."""
    chosen = [0]
    nearest = ((pool - pool[0]) ** 2).sum(1)
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((pool - pool[chosen[-1]]) ** 2).sum(1))
    return pool[chosen]


def roots(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances (row of x, row of points), each the rounded root of an exact integer."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in points], 1).astype(np.float64))


def lower_bounds(x_pivots: np.ndarray, c_pivots: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Bounds (row, centroid) that no distance falls below, from the distances of rows and centroids to the pivots."""
    out = np.zeros((len(x_pivots), len(c_pivots)))
    apart = roots(pivots, pivots)
    for i in range(len(pivots)):
        for j in range(i):
            one, other = np.outer(x_pivots[:, i], c_pivots[:, j]), np.outer(x_pivots[:, j], c_pivots[:, i])
            np.maximum(out, (np.abs(one - other) - SLACK * (one + other)) / (apart[i, j] * (1 + SLACK)), out=out)
    return out


def assign(x: np.ndarray, x_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cluster, squared distance, number of centroids compared exactly) of each row; ties go to the smaller number."""
    bounds = lower_bounds(x_pivots, roots(centroids, pivots), pivots)
    cluster = bounds.argmin(1)
    best, checked = ((x - centroids[cluster]) ** 2).sum(1), np.ones(len(x), np.int32)
    first, limit = cluster.copy(), np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    for c in range(len(centroids)):
        at = np.flatnonzero((bounds[:, c] <= limit) & (first != c))
        d = ((x[at] - centroids[c]) ** 2).sum(1)
        checked[at] += 1
        closer = (d < best[at]) | ((d == best[at]) & (c < cluster[at]))
        at, d = at[closer], d[closer]
        cluster[at], best[at], limit[at] = c, d, np.sqrt(d.astype(np.float64)) * (1 + SLACK)
    return cluster, best, checked


def unpacked(batch: pa.RecordBatch, dims: int, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    x, d = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("x", "pivots"))
    return x.reshape(-1, dims).astype(np.int64), d.reshape(-1, pivots)


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: str = "1", pivots: int = 6, pool: int = 64, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, n_checked) of every vector that takes part.

    The k vectors with the smallest sha256 of `seed:id` are the first centroids; of the `pool` smallest, `pivots` far
    apart ones are the pivots. n_checked counts the centroids whose distance was computed exactly in the last assignment.
    """
    spark, kept = vectors.sparkSession, integers(vectors, id_column, column, dims, scale)
    order = [F.asc_nulls_last(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)), "x"]
    first = np.array([r["x"] for r in kept.orderBy(*order).limit(max(k, pool)).collect()], np.int64).reshape(-1, dims)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, n_checked int"
    if not len(first):
        return spark.createDataFrame([], schema)
    centroids, fixed = first[:k], far_apart(first, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)
            d = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(fixed), pa.int32()), pa.array(roots(x, fixed).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), d], ["vec_id", "x", "pivots"])

    cached = stored(spread(kept).mapInArrow(measure, "vec_id long, x array<int>, pivots array<double>"))

    def sums_near(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            size, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
            for batch in batches:
                x, d = unpacked(batch, dims, len(fixed))
                cluster = assign(x, d, centroids, fixed)[0]
                size += np.bincount(cluster, minlength=len(centroids))
                np.add.at(total, cluster, x)
            c, i = np.nonzero((size > 0)[:, None] & np.ones(dims, bool))
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(i), pa.array(size[c]), pa.array(total[c, i])], ["cluster", "place", "n", "total"])

        return run

    def assigned(centroids: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cluster, best, checked = assign(*unpacked(batch, dims, len(fixed)), centroids, fixed)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(best), pa.array(checked, pa.int32())], ["vec_id", "cluster", "distance", "n_checked"])

        return run

    for _ in range(rounds):
        parts = cached.mapInArrow(sums_near(centroids), "cluster long, place long, n long, total long")
        centroids = centroids.copy()
        for r in parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total")).collect():
            centroids[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    rows = stored(cached.mapInArrow(assigned(centroids), "vec_id long, cluster int, distance long, n_checked int"))
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    own = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = own.agg(F.sum("cluster_inertia").alias("inertia"))
    # One row a cluster, k at most.
    named = own.crossJoin(F.broadcast(whole)).join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    return rows.join(F.broadcast(named), "cluster").select(*[f.split(" ")[0] for f in schema.split(", ")])


def sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1") -> str:
    """The same, without n_checked, in DuckDB's SQL over the table `embeddings`."""
    ctes = [
        f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
 WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {dims})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, x AS c FROM v QUALIFY cluster < {k})",
    ]
    square = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(rounds + 1):
        near = f"SELECT vec_id, any_value(x) AS x, min({{'d': {square}, 'cluster': cluster}}) AS best FROM v, c{r} GROUP BY vec_id"
        ctes.append(f"a{r} AS MATERIALIZED (SELECT vec_id, x, best.cluster AS cluster, CAST(best.d AS BIGINT) AS distance FROM ({near}))")
        if r < rounds:
            sums = f"SELECT cluster, i, sum(x[i]) AS total, count(*) AS n FROM a{r}, range(1, {dims + 1}) AS t(i) GROUP BY cluster, i"
            floor = "CAST((total - (total % n + n) % n) // n AS BIGINT)"
            means = f"SELECT cluster, list({floor} ORDER BY i) AS m FROM ({sums}) GROUP BY cluster"
            ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m, c) AS c FROM c{r} LEFT JOIN ({means}) USING (cluster))")
    return f"""WITH {', '.join(ctes)} SELECT vec_id, CAST(cluster AS INT) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
 CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"""
