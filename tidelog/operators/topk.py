"""Counting, ranking and top-k per period.

``top_k_per_group`` is the one generic report operator.  Its plan is

    partial count -> Exchange(period, key) -> final count
    -> WindowGroupLimit(partial, k) -> Exchange(period)
    -> WindowGroupLimit(final, k) -> Window -> Filter

so a period holding a third of all rows still only sends ``k`` rows per
upstream task to its single window task.

A *full* ranking (every key of a period numbered) cannot be cut that way, so
``rank_per_group`` numbers rows without ever gathering one period in one
task: it range-partitions the counts on (period, count desc, key) - which
splits a large period over many tasks - numbers rows inside each task, and
adds per-task offsets computed from a small (task, period) summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COUNT_COL = "request_count"
RANK_COL = "rn"
# Catalyst pushes a rank filter below the shuffle only up to this k
# (spark.sql.optimizer.windowGroupLimitThreshold).
WINDOW_GROUP_LIMIT_THRESHOLD = 1000


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def count_by(
    df: DataFrame, group: str | Sequence[str], key: str | Sequence[str], name: str = COUNT_COL
) -> DataFrame:
    """``COUNT(*)`` per (group, key); combined map-side before the shuffle."""
    return df.groupBy(*_names(group), *_names(key)).agg(F.count(F.lit(1)).alias(name))


def _order(count_col: str, key: Sequence[str]) -> list[Column]:
    # count descending; the key breaks ties so the ranking is deterministic
    return [F.col(count_col).desc()] + [F.col(k).asc_nulls_first() for k in key]


def top_k_of_counts(
    counts: DataFrame,
    group: str | Sequence[str],
    key: str | Sequence[str],
    k: int = 5,
    count_col: str = COUNT_COL,
    with_rank: bool = False,
) -> DataFrame:
    """The ``k`` highest counts per group (ties broken by key)."""
    group, key = _names(group), _names(key)
    if k < 1:
        raise ValueError("k must be >= 1")
    if k > WINDOW_GROUP_LIMIT_THRESHOLD:
        ranked = rank_per_group(counts, group, key, count_col)
    else:
        window = Window.partitionBy(*group).orderBy(*_order(count_col, key))
        ranked = counts.withColumn(RANK_COL, F.row_number().over(window))
    out = ranked.filter(F.col(RANK_COL) <= F.lit(k))
    cols = [*group, *key, count_col] + ([RANK_COL] if with_rank else [])
    return out.select(*cols)


def top_k_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    key: str | Sequence[str],
    k: int = 5,
    count_col: str = COUNT_COL,
) -> DataFrame:
    """Rows of ``df`` counted per (group, key); the top ``k`` keys per group.

    Output columns: group..., key..., ``request_count``.  NULL groups form
    their own group.  Unordered: sort on read (``sort_report``).
    """
    return top_k_of_counts(count_by(df, group, key, count_col), group, key, k, count_col)


def sort_report(report: DataFrame, group: str, key: str, count_col: str = COUNT_COL) -> DataFrame:
    """Report order: period, count descending, key."""
    return report.orderBy(F.col(group).asc_nulls_first(), *_order(count_col, [key]))


def rank_per_group(
    counts: DataFrame,
    group: str | Sequence[str],
    key: str | Sequence[str],
    count_col: str = COUNT_COL,
    num_partitions: int | None = None,
) -> DataFrame:
    """Adds ``rn`` = ROW_NUMBER() OVER (PARTITION BY group ORDER BY count
    DESC, key) without placing a whole group in one task.

    ``(group, key)`` must be unique in ``counts`` (it is after ``count_by``).
    """
    group, key = _names(group), _names(key)
    spark = counts.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(g).asc_nulls_first() for g in group] + _order(count_col, key)
    # A fixed partition count keeps AQE from coalescing the range partitions,
    # so partition ids agree between the two uses of ``tagged`` below.
    ranged = counts.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # monotonically_increasing_id = (task index << 33) + position in task;
    # positions follow the sort, so rows of a group inside one task are
    # numbered consecutively.
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id()).withColumn(
        "_pid", F.shiftright(F.col("_mid"), 33)
    )
    gkeys = [f"_g{i}" for i in range(len(group))]
    per_task = tagged.groupBy(
        F.col("_pid").alias("_opid"), *[F.col(g).alias(a) for g, a in zip(group, gkeys)]
    ).agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*gkeys).orderBy("_opid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_task.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    ).drop("_n")
    # (task, group) pairs number at most tasks + groups: a small side.
    cond = [F.col("_pid") == F.col("_opid")] + [
        F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group, gkeys)
    ]
    joined = tagged.join(offsets, cond, "inner")
    rn = (F.col("_mid") - F.col("_first") + F.col("_before") + 1).cast("int")
    return joined.select(*counts.columns, rn.alias(RANK_COL))


def rank_counts(
    df: DataFrame,
    group: str | Sequence[str],
    key: str | Sequence[str],
    count_col: str = COUNT_COL,
) -> DataFrame:
    """Counts per (group, key) with their full rank inside the group."""
    return rank_per_group(count_by(df, group, key, count_col), group, key, count_col)
