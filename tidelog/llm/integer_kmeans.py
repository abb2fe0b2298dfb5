"""Operator 12: centroid clustering with an incremental distance matrix.

Vectors become integers.  Beside each one its exact dot product with every
centroid is stored.  When a centroid moves, only its components that changed
enter: the dot product grows by the vector's entries at those places times
the changes, so a centroid that stays costs nothing, and a round in which
none moves ends the work.  With the squared norms on both sides the products
give the squared distances, whose smallest is the new assignment.

The vectors with their products are a written table; each round reads the
last one and writes the next one, after which the last is deleted.  The sums
of a cluster are formed within every task first, so that a cluster with a
third of all rows, or one vector repeated as often, is one row of each task.
The driver holds the centroids and sums alone: ``clusters`` rows.

Integer components may not exceed ``LIMIT`` in size, as squared distances
would not fit 64 bits; the operator then ends with an error.

Defined cases: vectors that are null, of another length, or hold null or
non-finite components take no part; every row counts, so repeated rows are
clustered each, and may be several (equal) first centroids; a null vec_id is
written ``-`` where centroids are chosen; of equal hashes the smaller vector
goes first; fewer vectors than clusters are each a centroid; an empty table
gives an empty result.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import discard, materialise, table, written

DIMENSIONS, SCALE = 64, 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
#: Largest size of a component: 64 squared differences of twice this fit 63 bits.
LIMIT = 2**27
STATE = "vec_id long, q array<long>, dots array<long>, cluster int, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and q, the integer vector, of the rows that take part."""
    d = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return d.where(F.col("v").isNotNull() & (F.size("v") == dimensions) & finite).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("q")
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and vec_id, in that order."""
    name = F.coalesce(F.col("vec_id").cast("string"), F.lit("-"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    rows = vectors.orderBy(key, "q").limit(clusters).select("q").collect()
    return np.array([r["q"] for r in rows], np.int64)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists(m: np.ndarray) -> pa.Array:
    ends = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(m.reshape(-1)))


def advance(centroids: np.ndarray, change: np.ndarray):
    """Batches with products brought from the former centroids to these, and
    the assignment made anew."""
    k, width = centroids.shape
    moved = [(j, at, change[j, at]) for j in range(k) if len(at := np.flatnonzero(change[j]))]
    norms = (centroids * centroids).sum(1)

    def run(batches):
        for b in batches:
            q = matrix(b.column("q"), width)
            if "dots" in b.schema.names:
                dots = matrix(b.column("dots"), k).copy()
            else:
                dots = np.zeros((len(q), k), np.int64)
            for j, at, by in moved:
                dots[:, j] += q[:, at] @ by
            far = (q * q).sum(1)[:, None] - 2 * dots + norms
            cluster = far.argmin(1)
            distance = far[np.arange(len(q)), cluster]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), lists(q), lists(dots), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "q", "dots", "cluster", "distance"],
            )

    return run


def cluster_sums(state: DataFrame, k: int, width: int) -> dict[int, tuple[int, np.ndarray]]:
    """Rows and componentwise sums of every non-empty cluster."""

    def run(batches):
        n, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for b in batches:
            cluster = b.column("cluster").to_numpy(zero_copy_only=False)
            n += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, matrix(b.column("q"), width))
        some = np.flatnonzero(n)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(n[some]), lists(sums[some])],
                names=["cluster", "n", "sums"],
            )

    parts = state.select("cluster", "q").mapInArrow(run, "cluster int, n long, sums array<long>")
    whole = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    return {r["cluster"]: (r["n"], np.array(r["sums"], np.int64)) for r in whole.collect()}


def integer_kmeans(
    rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS
) -> tuple[DataFrame, np.ndarray]:
    """The last state (vec_id, q, dots, cluster, distance) and its centroids."""
    spark = rows.sparkSession
    vectors = materialise(integer_vectors(rows, dimensions), "integer-vectors")
    size = vectors.agg(F.max(F.array_max(F.transform("q", lambda x: F.greatest(x, -1 - x))))).first()[0]
    if size is None:
        return spark.createDataFrame([], STATE), np.zeros((0, dimensions), np.int64)
    if size > LIMIT:
        raise ValueError(f"an integer component exceeds {LIMIT} in size")
    centroids = first_centroids(vectors, clusters, seed)
    state, last, change = vectors, None, centroids
    for turn in range(rounds + 1):
        state, path = written(state.mapInArrow(advance(centroids, change), STATE), f"products-{turn}")
        if last:
            discard(spark, last)
        last = path
        if turn == rounds:
            break
        new = centroids.copy()
        for j, (n, sums) in cluster_sums(state, len(centroids), dimensions).items():
            new[j] = sums // n
        change = new - centroids
        if not change.any():
            break
        centroids = new
    return state, centroids


def query(spark, sf_dir):
    state, centroids = integer_kmeans(table(spark, sf_dir, "embeddings"))
    inertia = {r[0]: r[1] for r in state.groupBy("cluster").agg(F.sum("distance")).collect()}
    if not inertia:
        return spark.createDataFrame([], RESULT)
    named = [
        (j, of, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for j, of in inertia.items()
    ]
    # one row for each cluster
    known = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(known), "cluster").select(*[c.split()[0] for c in RESULT.split(", ")])


def oracle_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    parts = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q AS c
  FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '-')) AS h, q FROM v)
  QUALIFY k < {clusters})""",
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""a{t} AS MATERIALIZED (
  SELECT r, k, d FROM (
    SELECT r, k, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
    FROM v, c{t})
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""
        )
        if t < rounds:
            parts.append(
                f"""c{t + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{t} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
      SELECT k, i, sum(x) AS s, count(*) AS n FROM (
        SELECT k, unnest(q) AS x, unnest(range({DIMENSIONS})) AS i FROM a{t} JOIN v USING (r))
      GROUP BY k, i)
    GROUP BY k) USING (k))"""
            )
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} USING (k)
"""
