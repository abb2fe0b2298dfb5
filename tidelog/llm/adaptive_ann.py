"""Operator 4: nearest neighbours by adaptive dimension scan.

Vectors are assigned to the lists of an inverted file, whose centroids are
fitted to at most ``SAMPLE`` rows; every row is indexed.  Each query probes
its ``PROBES`` nearest lists.  A list is cut into blocks of about ``BLOCK``
rows, so that a list with a third of all rows is many tasks, and a task scans
one block for up to ``QUERY_BLOCK`` queries.

The scan works on randomly rotated vectors, column block by column block.
After the first d of D rotated dimensions, sqrt(D/d) times the partial
distance estimates the distance; a candidate is abandoned as soon as the test
rejects, at an error rate set by ``EPSILON``, that it can be closer than the
query's tenth best so far.  Those that reach the last column are measured on
the original vectors in double precision.

Defined cases: vectors that are null, all zero, or hold null or non-finite
components take no part, neither do those whose length isn't the most common
one (the longest of equally common ones); rows with a null vec_id take no part; repeated rows count once;
of different vectors with one vec_id each is a candidate, and none is found
by a query of that vec_id; ties go to the smaller vec_id; an empty table
gives an empty result.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialise, table

K, QUERY_STEP = 10, 100
#: Rows that the centroids are fitted to, iterations, and rows for each list.
SAMPLE, ITERATIONS, LIST_ROWS, MAX_LISTS = 20_000, 8, 400, 1024
#: Share of the lists that a query probes (at least MIN_PROBES of them): the given
#: vectors have hardly any clusters, so that a small share would miss neighbours.
PROBE_SHARE, MIN_PROBES = 0.7, 16
BLOCK, QUERY_BLOCK = 2048, 1024
#: Rotated dimensions in a column block, and the width of the test.
COLUMNS, EPSILON = 16, 2.1
SEED = 20260101


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    d = rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    )
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    d = d.where(finite & F.exists("v", lambda x: x != 0)).dropDuplicates(["vec_id", "v"])
    return d


def common_length(d: DataFrame) -> int:
    best = d.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return best["n"] if best else 0


def rotation(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, d)))[0]


def fit_centroids(d: DataFrame, n: int) -> np.ndarray:
    """Centroids of about n / LIST_ROWS lists (MAX_LISTS at most), by k-means
    on the SAMPLE rows with the smallest hash of their vec_id."""
    rows = d.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    x = np.array([r["v"] for r in rows])
    k = int(min(max(1, n // LIST_ROWS), MAX_LISTS, len(x)))
    c = x[np.random.default_rng(SEED).permutation(len(x))[:k]]
    for _ in range(ITERATIONS):
        near = nearest(x, c, 1)[:, 0]
        for j in range(k):
            if (mine := x[near == j]).size:
                c[j] = mine.mean(axis=0)
    return c


def nearest(x: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest centroids of each row, 4096 rows at a time."""
    out = []
    for i in range(0, len(x), 4096):
        far = (c * c).sum(1) - 2 * x[i : i + 4096] @ c.T
        out.append(np.argsort(far, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def scan_block(q_ids, q, c_ids, c, turn, k=K) -> list[tuple[int, int, float]]:
    """The k nearest in one block of candidates for each query."""
    dims = c.shape[1]
    rc, rq = c @ turn, q @ turn
    found = []
    first = min(len(c), max(4 * k, 64))
    for i in range(len(q)):
        others = np.flatnonzero(c_ids != q_ids[i])
        head, rest = others[:first], others[first:]
        far = ((rc[head] - rq[i]) ** 2).sum(1)
        limit = np.partition(far, k - 1)[k - 1] if len(far) >= k else np.inf
        part = np.zeros(len(rest))
        for at in range(0, dims, COLUMNS):
            if not len(rest):
                break
            cols = slice(at, min(at + COLUMNS, dims))
            part = part + ((rc[rest, cols] - rq[i, cols]) ** 2).sum(1)
            d = cols.stop
            bound = limit if d == dims else limit * d / dims * (1 + EPSILON / np.sqrt(d)) ** 2
            stays = part <= bound * (1 + 1e-9)
            rest, part = rest[stays], part[stays]
        keep = np.concatenate([head, rest])
        exact = np.sqrt(((c[keep] - q[i]) ** 2).sum(1))
        best = np.lexsort((c_ids[keep], exact))[:k]
        found += [(int(q_ids[i]), int(c_ids[keep[j]]), float(exact[j])) for j in best]
    return found


def search(rows: DataFrame, k: int = K, probe_share: float = PROBE_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest found to every row whose
    vec_id is divisible by QUERY_STEP."""
    d = materialise(usable(rows), "vectors")
    dims = common_length(d)
    d = d.where(F.size("v") == dims)
    n = d.count()
    out = "query_id long, vec_id long, score double"
    if not n:
        spark = rows.sparkSession
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centroids, turn = fit_centroids(d, n), rotation(dims)
    probes = min(len(centroids), max(MIN_PROBES, int(np.ceil(probe_share * len(centroids)))))

    def assign(how_many):
        def run(frames):
            for f in frames:
                near = nearest(np.stack(f["v"].to_numpy()) if len(f) else np.zeros((0, dims)), centroids, how_many)
                yield pd.DataFrame({"vec_id": f["vec_id"], "v": f["v"], "lists": list(near)})

        return run

    schema = "vec_id long, v array<double>, lists array<long>"
    listed = materialise(
        d.mapInPandas(assign(1), schema).select("vec_id", "v", F.get("lists", F.lit(0)).alias("list")),
        "vector-lists",
    )
    # blocks of a list, and of the queries that probe it
    sizes = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    queries = d.where(F.col("vec_id") % QUERY_STEP == 0).mapInPandas(assign(probes), schema)
    probing = queries.select("vec_id", "v", F.explode("lists").alias("list"))
    asked = materialise(probing, "probes")
    askers = asked.groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("long").alias("query_blocks")
    )
    shape = materialise(sizes.join(askers, "list"), "list-shapes")
    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    cand = listed.join(shape, "list").select(
        "list", dealt("blocks").alias("b"), every("query_blocks").alias("qb"), "vec_id", "v"
    )
    ask = asked.join(shape, "list").select(
        "list", every("blocks").alias("b"), dealt("query_blocks").alias("qb"), "vec_id", "v"
    )

    def scan(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64"}
            )
        found = scan_block(
            q["vec_id"].to_numpy(), np.stack(q["v"]), c["vec_id"].to_numpy(), np.stack(c["v"]), turn, k
        )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["list", "b", "qb"]
    found = ask.groupBy(*keys).cogroup(cand.groupBy(*keys)).applyInPandas(scan, out)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"))
