"""Row estimates and physical layout before a write.

The default layout is ``rebalance``: a REBALANCE hint on the partition
columns, which AQE sizes at run time (``advisoryPartitionSizeInBytes``),
splitting a hot partition and merging small ones.  ``dynamic`` reproduces
volume-based hash repartitioning (``n = max(base, min(max, rows / target))``)
but salts each key over ``salt_buckets`` tasks so one hot (day, hour) never
lands in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAYOUTS = ("rebalance", "dynamic", "off")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spreads a source with fewer splits than the cluster has cores (one
    large row group, a single small file) over ``min_partitions`` tasks
    (default: the default parallelism) so per-row work uses every core.

    Meant for a freshly read source, whose split count is known from
    planning alone.  A source with enough splits is returned unchanged; only
    a small input pays the round-robin shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    """One row with the exact row count (a global aggregate: each task
    counts its rows, one number per task is combined)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def estimate_rows(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """One row ``estimated_rows``: count of a Bernoulli sample / fraction.

    The sample is taken inside each task; only one number leaves the
    executors.  ``fraction=1.0`` is the exact count.
    """
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    sampled = df if fraction >= 1.0 else df.sample(fraction=fraction, seed=seed)
    return sampled.agg(
        F.round(F.count(F.lit(1)) / F.lit(fraction)).cast("bigint").alias("estimated_rows")
    )


def estimate_row_count(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> int:
    return int(estimate_rows(df, fraction, seed).first()["estimated_rows"])


def volume_partitions(
    rows: int, base: int = 2, maximum: int = 50, target_rows: int = 1_000_000
) -> int:
    return max(base, min(maximum, int(rows / target_rows)))


def apply_layout(
    df: DataFrame,
    partition_cols: Sequence[str],
    layout: str = "rebalance",
    row_estimate: int | None = None,
    base: int = 2,
    maximum: int = 50,
    target_rows: int = 1_000_000,
    salt_buckets: int = 8,
) -> DataFrame:
    """Lays rows out for a write partitioned by ``partition_cols``.

    Never adds, drops or changes a column or a row.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, got {layout!r}")
    if layout == "off":
        return df
    if layout == "rebalance":
        return df.hint("rebalance", *partition_cols)
    rows = row_estimate if row_estimate is not None else estimate_row_count(df)
    n = volume_partitions(rows, base, maximum, target_rows)
    # a deterministic salt (hash of the row) so a retried task reproduces
    # the same shuffle output
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(max(1, salt_buckets)))
    return df.repartition(n, *[F.col(c) for c in partition_cols], salt)
