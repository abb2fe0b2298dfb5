"""Direct placement: rows shuffled to a given partition number.

``repartition`` hashes its keys, so nothing says beforehand which rows meet.
``place`` sends every row to the partition that an expression names; the
rows of each partition are then a grouped count, known before the shuffle
(``placement_counts``) and checkable after it (``partition_counts``).

``place_balanced`` keeps the rows of a key together except where that is the
problem: keys with more rows than a partition's share are found with a
bounded summary and spread over as many partitions as they need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.hitters import heavy_hitters


def _target(n: int, partition: Column | str) -> Column:
    if n < 1:
        raise ValueError("n must be >= 1")
    column = F.col(partition) if isinstance(partition, str) else partition
    return F.coalesce(F.pmod(column.cast("bigint"), F.lit(n)), F.lit(0)).cast("int")


def place(df: DataFrame, n: int, partition: Column | str) -> DataFrame:
    """``df`` in ``n`` partitions, each row in number ``partition`` modulo
    ``n`` (NULL: 0).  One shuffle; adaptive execution keeps the numbers."""
    return df.repartitionById(n, _target(n, partition))


def placement_counts(df: DataFrame, n: int, partition: Column | str) -> DataFrame:
    """``(partition_id INT, count BIGINT)`` that ``place`` will give, empty
    partitions included: a grouped count, no row is moved."""
    spark = df.sparkSession
    counted = df.groupBy(_target(n, partition).alias("partition_id")).agg(
        F.count(F.lit(1)).alias("count")
    )
    ids = spark.range(n).select(F.col("id").cast("int").alias("partition_id"))
    return ids.join(counted, "partition_id", "left").select(
        "partition_id", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )


def balanced_partition(df: DataFrame, key: str, n: int) -> Column:
    """Partition number for ``place`` that splits hot keys.

    A key with more than 1/n of the rows has at most ``n`` of its kind, so
    the map of them (key -> first partition, width) is bounded by ``n``.
    Other keys go where their hash says.
    """
    total = df.count()
    hot = heavy_hitters(df, key, 1.0 / n).orderBy(F.desc("rows"), F.asc_nulls_first(key)).collect()
    hashed = F.pmod(F.xxhash64(key), F.lit(n))
    out, first = hashed, 0
    # position in the input: equal rows are spread too
    position = F.monotonically_increasing_id()
    for row in reversed(hot):
        width = min(n, math.ceil(row["rows"] * n / total))
        at = F.lit(first) + F.pmod(position, F.lit(width))
        out = F.when(F.col(key).eqNullSafe(F.lit(row[key])), at).otherwise(out)
        first = (first + width) % n
    return out


def place_balanced(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` in ``n`` partitions by ``key``, hot keys spread evenly."""
    numbered = df.withColumn("_partition", balanced_partition(df, key, n))
    return place(numbered, n, "_partition").drop("_partition")
