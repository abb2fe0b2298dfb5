"""Partition filters by day and by week."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.periods import year_week_of_day


def day_filter(days: list[str] | None, include_null: bool = True) -> Column | None:
    """Partition filter selecting ``days`` (and the NULL day of malformed
    lines); None selects everything."""
    if days is None:
        return None
    cond = F.col("process_date").isin(list(days)) if days else F.lit(False)
    if include_null:
        cond = cond | F.col("process_date").isNull()
    return cond


def week_filter(
    spark: SparkSession, days: list[str] | None, mode: str, include_null: bool = True
) -> Column | None:
    """Partition filter selecting every day of the year-weeks containing
    ``days`` (a weekly count needs all of its days)."""
    if days is None:
        return None
    labels = []
    if days:
        probe = spark.createDataFrame([(d,) for d in days], "d string")
        week = year_week_of_day("d", mode)
        labels = [r[0] for r in probe.select(week).distinct().collect() if r[0] is not None]
    cond = year_week_of_day("process_date", mode).isin(labels) if labels else F.lit(False)
    if include_null:
        cond = cond | F.col("process_date").isNull()
    return cond
