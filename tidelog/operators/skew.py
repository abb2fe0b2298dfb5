"""Data-skew reports: per physical partition and per logical key.

Physical counts use ``spark_partition_id()`` in a grouped count (partial
aggregation in every task, one row per partition leaves it).  Partitions
with no rows are restored from ``spark.range(n)`` so the minimum is honest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKEW_THRESHOLD = 3.0


def partition_counts(df: DataFrame) -> DataFrame:
    """``(partition_id INT, count BIGINT)`` for every partition, empty ones
    included.

    The partition count comes from the physical plan: free for a scan, but
    for an input ending in an adaptive shuffle, Spark runs the shuffle
    stages to learn it (as any physical-partition report must).
    """
    spark = df.sparkSession
    n = df.rdd.getNumPartitions()
    counted = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("count")
    )
    ids = spark.range(n).select(F.col("id").cast("int").alias("partition_id"))
    return ids.join(counted, "partition_id", "left").select(
        "partition_id", F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")
    )


def _stats(counts: DataFrame, count_col: str, n_name: str, threshold: float) -> DataFrame:
    c = F.col(count_col)
    stats = counts.agg(
        F.count(F.lit(1)).alias(n_name),
        F.max(c).alias("max_rows"),
        F.min(c).alias("min_rows"),
        F.avg(c).alias("_avg"),
    )
    ratio = F.when(F.col("_avg") > 0, F.col("max_rows") / F.col("_avg"))
    return stats.select(
        n_name,
        "max_rows",
        "min_rows",
        F.round("_avg", 6).alias("avg_rows"),
        F.round(ratio, 6).alias("skew_ratio"),
        F.coalesce(ratio > F.lit(threshold), F.lit(False)).alias("is_skewed"),
    )


def partition_skew(df: DataFrame, threshold: float = SKEW_THRESHOLD) -> DataFrame:
    """One row: partition count, max / min / mean rows, max/mean ratio (NULL
    when the mean is 0) and ``is_skewed`` (ratio above ``threshold``)."""
    return _stats(partition_counts(df), "count", "n_partitions", threshold)


def partition_extremes(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most and ``n`` least loaded partitions with their ratio to
    the mean: ``(side, partition_id, count, ratio_to_avg)``."""
    counts = partition_counts(df)
    # the mean as a scalar subquery: one value, computed once
    avg = counts.agg(F.avg("count")).scalar()
    with_ratio = counts.select(
        "partition_id",
        "count",
        F.round(F.when(avg > 0, F.col("count") / avg), 6).alias("ratio_to_avg"),
    )
    top = with_ratio.orderBy(F.desc("count"), F.asc("partition_id")).limit(n)
    bottom = with_ratio.orderBy(F.asc("count"), F.asc("partition_id")).limit(n)
    return top.select(F.lit("most").alias("side"), "*").unionByName(
        bottom.select(F.lit("least").alias("side"), "*")
    )


def key_skew(
    df: DataFrame, keys: str | Sequence[str], threshold: float = SKEW_THRESHOLD
) -> DataFrame:
    """Rows per distinct key, summarised like ``partition_skew``:
    ``(n_keys, max_rows, min_rows, avg_rows, skew_ratio, is_skewed)``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return _stats(counts, "rows", "n_keys", threshold)
