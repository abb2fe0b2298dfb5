"""Operation metrics as a table: records, JSON sink and summaries.

A metric record is ``(name, timestamp, duration_ms, type, details)``.  Jobs
record one per stage on the driver (a handful of rows, never data); the
records become a DataFrame, are appended to a JSON-lines folder and are
summarised with ordinary aggregations, so summaries scale to any number of
runs stored in that folder.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("duration_ms", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)


class MetricsRecorder:
    """Collects stage timings on the driver (one record per stage)."""

    def __init__(self) -> None:
        self.records: list[tuple] = []

    @contextmanager
    def timed(self, name: str, kind: str = "spark_operation", **details: str) -> Iterator[None]:
        start = time.perf_counter()
        stamp = datetime.now(timezone.utc).isoformat()
        try:
            yield
        finally:
            ms = (time.perf_counter() - start) * 1000.0
            self.records.append(
                (name, stamp, ms, kind, {k: str(v) for k, v in details.items()} or None)
            )

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.records, METRICS_SCHEMA)


def write_metrics_json(metrics: DataFrame, path: str, mode: str = "append") -> str:
    """Appends metric records as JSON lines (one file per task)."""
    metrics.write.mode(mode).json(path)
    return path


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def metrics_totals(metrics: DataFrame) -> DataFrame:
    """``(total_operations, total_duration_ms, avg_duration_ms)``; one row,
    zero operations and NULL durations for an empty table."""
    return metrics.agg(
        F.count(F.lit(1)).alias("total_operations"),
        F.round(F.sum("duration_ms"), 6).alias("total_duration_ms"),
        F.round(F.avg("duration_ms"), 6).alias("avg_duration_ms"),
    )


def metrics_by_type(metrics: DataFrame) -> DataFrame:
    """Per ``type``: count, mean, min and max duration."""
    return metrics.groupBy("type").agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg("duration_ms"), 6).alias("avg_duration_ms"),
        F.min("duration_ms").alias("min_duration_ms"),
        F.max("duration_ms").alias("max_duration_ms"),
    )


def events_as_metrics(events: DataFrame) -> DataFrame:
    """The ``events`` table viewed as metric records (test input)."""
    return events.select(
        F.concat(F.col("event_type"), F.col("user_id").cast("string")).alias("name"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("value").alias("duration_ms"),
        F.col("event_type").alias("type"),
        F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("details"),
    )
