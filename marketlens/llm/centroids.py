"""Centroid clustering by Lloyd's rounds, exact in integers, with centroids filtered by an n-simplex projection.

Some vectors are pivots. The distances of a vector to the pivots are computed once and turned into the coordinates of
the apex of a simplex over the pivots: its place in the pivots' plane, and its altitude above it. The distance of two
apexes bounds the distance of their vectors from below; with one altitude turned round, from above. Each round computes
the apexes of the centroids, and per vector, in these few numbers, the bounds to every centroid. The exact integer
distance is computed to the centroid with the least upper bound, and then only to those whose lower bound does not
exceed it. The bounds are floating point numbers; they are widened by more than their largest error (``SLACK``), so a
centroid that is nearest, or equally near, is always compared exactly.

Vectors and apexes are stored once, every round is a scan of that table that sends one row per task and cluster into an
aggregation; lost tasks are run again from the table. The driver sees ``pivots`` vectors and one row per cluster.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite. Component x becomes floor(1024 * x). The
first centroids are the vectors with the smallest sha256 of ``<seed>:<key>``; of equal keys the smaller vector comes
first, null keys come last. Each round replaces a centroid by the floor of the mean of its vectors; one without vectors
stays. Ties go to the smaller number. With fewer kept vectors than ``k`` there are fewer centroids, with none the result
is empty. Repeated rows are vectors of their own. Extra columns are not read. Components beyond ``LARGEST`` are an error,
as distances would not fit into 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import staged, table

CLUSTERS, ROUNDS, DIMS, SEED, PIVOTS = 8, 10, 64, 3, 16
LARGEST = 1 << 27
# A pivot is used only if the simplex stays so well conditioned. The apexes' relative error is then below 1e-11 in the
# plane and, as a square root, below 4e-6 in the altitude. SLACK is for squared distances, relative to the squared sizes.
CONDITION, SLACK = 100.0, 1e-5


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers."""
    apart = a.astype(np.int64) - b
    return np.einsum("...i,...i->...", apart, apart)


class Simplex:
    """Pivots in general position, and apexes over them from squared distances alone."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[:1].astype(np.int64)
        self.factor = np.empty((0, 0))
        for pivot in pivots[1:].astype(np.int64):
            tried = np.vstack([self.pivots, pivot])
            edges = (tried[1:] - tried[0]).astype(np.float64)
            try:
                factor = np.linalg.cholesky(edges @ edges.T)
            except np.linalg.LinAlgError:
                continue
            if np.linalg.cond(factor) <= CONDITION:
                self.pivots, self.factor = tried, factor
        self.edges = (self.factor**2).sum(axis=1)
        self.longest = float(self.edges.max(initial=0))

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector its coordinates in the pivots' plane, and its altitude."""
        distances = np.stack([squared(vectors, p) for p in self.pivots], axis=1).astype(np.float64)
        sides = (distances[:, :1] + self.edges - distances[:, 1:]) / 2
        plane = np.linalg.solve(self.factor, sides.T).T if len(self.edges) else sides
        altitude = np.sqrt(np.maximum(distances[:, 0] - (plane**2).sum(axis=1), 0))
        return np.column_stack([plane, altitude])


def bounds(a: np.ndarray, b: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances of all vectors of ``a`` to all of ``b``, from their apexes."""
    size_a, size_b = (a**2).sum(axis=1)[:, None], (b**2).sum(axis=1)
    plane = size_a + size_b - 2 * (a[:, :-1] @ b[:, :-1].T)
    twice = 2 * a[:, -1:] * b[:, -1]
    slack = SLACK * (size_a + size_b + longest) + 1
    return plane - twice - slack, plane + twice + slack


def assigned(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the first, of several) and squared distance of every vector, and how many exact distances it took."""
    low, high = bounds(apexes, simplex.apexes(centroids), simplex.longest)
    rows = np.arange(len(vectors))
    likely = high.argmin(axis=1)
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[rows, likely] = squared(vectors, centroids[likely])
    open_ = low <= exact[rows, likely][:, None]
    open_[rows, likely] = False
    row, centroid = np.nonzero(open_)
    exact[row, centroid] = squared(vectors[row], centroids[centroid])
    nearest = exact.argmin(axis=1)
    return nearest, exact[rows, nearest], len(rows) + len(row)


def integer_vectors(vectors: DataFrame, key: str, column: str, dims: int) -> DataFrame:
    """key, v: the kept vectors in integers."""
    whole = F.col(column).cast("array<double>")
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(whole, lambda x: F.floor(x * 1024.0))
    fits = F.forall(whole, lambda x: F.abs(x) * 1024.0 <= LARGEST)
    problem = F.raise_error(F.lit(f"a component is beyond {LARGEST} / 1024")).cast("array<int>")
    kept = vectors.filter((F.size(whole) == dims) & finite)
    return kept.select(F.col(key).alias("key"), F.when(fits, scaled.cast("array<int>")).otherwise(problem).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def with_apexes(kept: DataFrame, simplex: Simplex, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = simplex.apexes(matrix(batch.column("v"), dims))
            ends = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            apex = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, apex], ["key", "v", "apex"])

    return kept.mapInArrow(run, f"key {kept.schema['key'].dataType.simpleString()}, v array<int>, apex array<double>")


def cluster_sums(stored: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    """cluster, n, total (sums of the components): one row per task and cluster."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v = matrix(batch.column("v"), dims).astype(np.int64)
            cluster, _, _ = assigned(v, matrix(batch.column("apex"), len(simplex.pivots)), centroids, simplex)
            n += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, v)
        some = np.flatnonzero(n)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * dims, pa.int32()), pa.array(total[some].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), lists], ["cluster", "n", "total"])

    return stored.mapInArrow(run, "cluster int, n long, total array<long>")


def moved(stored: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape
    sums = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dims)]
    out = centroids.copy()
    for row in cluster_sums(stored, centroids, simplex).groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dims)]
    return out


def with_clusters(stored: DataFrame, centroids: np.ndarray, simplex: Simplex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, apex = matrix(batch.column("v"), centroids.shape[1]), matrix(batch.column("apex"), len(simplex.pivots))
            cluster, distance, _ = assigned(v, apex, centroids, simplex)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(cluster, pa.int32()), pa.array(distance)], ["key", "cluster", "distance"])

    return stored.mapInArrow(run, f"key {stored.schema['key'].dataType.simpleString()}, cluster int, distance long")


def centroid_clusters(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """Per kept vector: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, key, column, dims)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = kept.orderBy(name.asc_nulls_last(), "v").limit(max(k, pivots)).select("v").collect()
    start = np.array([row.v for row in first], np.int64).reshape(-1, dims)
    simplex, centroids = Simplex(start[:pivots]) if len(start) else None, start[:k]
    if simplex is None:
        kind = vectors.schema[key].dataType.simpleString()
        return spark.createDataFrame(
            [], f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    stored = staged(with_apexes(kept, simplex, dims), "vectors")
    for _ in range(rounds):
        centroids = moved(stored, centroids, simplex)
    found = staged(with_clusters(stored, centroids, simplex), "clusters")
    inertia = {row.cluster: row.inertia for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    figures = [(c, inertia[c], sum(inertia.values()), digests[c]) for c in inertia]
    # One row per cluster, k at most.
    figures = spark.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(figures), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _assign(n: int) -> str:
    return f"""a{n} AS MATERIALIZED (
  SELECT kept.rn, near.c, list_sum([(kept.v[i] - near.v[i]) * (kept.v[i] - near.v[i]) for i in range(1, 65)]) AS d
  FROM kept, c{n} near QUALIFY row_number() OVER (PARTITION BY kept.rn ORDER BY d, near.c) = 1
)"""


def _move(n: int) -> str:
    return f"""c{n + 1} AS MATERIALIZED (
  SELECT old.c, coalesce(new.v, old.v) AS v FROM c{n} old LEFT JOIN (
    SELECT c, list(m ORDER BY i) AS v FROM (
      SELECT c, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
      FROM a{n} JOIN kept USING (rn), range(1, 65) t(i) GROUP BY c, i
    ) GROUP BY c
  ) new USING (c)
)"""


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, v, row_number() OVER (ORDER BY sha256('3:' || vec_id), v) AS rn
  FROM (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
    FROM embeddings
    WHERE len(embedding) = {DIMS} AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
  )
),
c0 AS MATERIALIZED (SELECT CAST(rn - 1 AS INTEGER) AS c, v FROM kept WHERE rn <= {CLUSTERS}),
{", ".join(f"{_assign(n)}, {_move(n)}" for n in range(ROUNDS))},
{_assign(ROUNDS)}
SELECT vec_id, c AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(last.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN kept USING (rn) JOIN c{ROUNDS} last USING (c)
"""
