"""The four top-k-per-period reports.

Daily reports count (process_date, key); weekly reports count (year_week,
key).  A day belongs to exactly one year-week, so ``build_reports`` counts
(day, ip, device) in one scan of the logs, sums those into the two daily
counts and rolls the daily counts up to weeks: the weekly shuffles move
daily counts instead of log rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.config import LogConfig
from tidelog.functions.periods import year_week, year_week_of_day
from tidelog.operators.topk import (
    COUNT_COL,
    count_by,
    sort_report,
    top_k_of_counts,
    top_k_per_group,
)
from tidelog.sources.tables import read_table, write_partitioned

# report name -> (period column, key column)
REPORTS = {
    "daily_top_ips": ("process_date", "ip"),
    "daily_top_devices": ("process_date", "device_type"),
    "weekly_top_ips": ("year_week", "ip"),
    "weekly_top_devices": ("year_week", "device_type"),
}


def with_year_week(logs: DataFrame, mode: str = "calendar") -> DataFrame:
    return logs.withColumn("year_week", year_week("timestamp", mode))


def daily_report(logs: DataFrame, key: str, k: int = 5) -> DataFrame:
    return top_k_per_group(logs, "process_date", key, k)


def weekly_report(logs: DataFrame, key: str, k: int = 5, mode: str = "calendar") -> DataFrame:
    return top_k_per_group(with_year_week(logs, mode), "year_week", key, k)


def weekly_counts_from_daily(daily: DataFrame, key: str, mode: str = "calendar") -> DataFrame:
    """(process_date, key, request_count) -> (year_week, key, request_count)."""
    return (
        daily.withColumn("year_week", year_week_of_day("process_date", mode))
        .groupBy("year_week", key)
        .agg(F.sum(COUNT_COL).alias(COUNT_COL))
    )


def build_reports(
    logs: DataFrame, k: int = 5, mode: str = "calendar"
) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """All four reports from one scan of the logs.

    One aggregation counts rows per (day, ip, device); the daily ip and
    device counts are sums over it, and the weekly counts sums over those.
    Returns the reports and the persisted intermediate counts; unpersist
    those once the reports are written.
    """
    base = count_by(logs.select("process_date", "ip", "device_type"), "process_date",
                    ["ip", "device_type"]).persist()
    cached = [base]
    reports: dict[str, DataFrame] = {}
    for key, daily_name, weekly_name in (
        ("ip", "daily_top_ips", "weekly_top_ips"),
        ("device_type", "daily_top_devices", "weekly_top_devices"),
    ):
        daily = (
            base.groupBy("process_date", key).agg(F.sum(COUNT_COL).alias(COUNT_COL)).persist()
        )
        cached.append(daily)
        reports[daily_name] = top_k_of_counts(daily, "process_date", key, k)
        weekly = weekly_counts_from_daily(daily, key, mode)
        reports[weekly_name] = top_k_of_counts(weekly, "year_week", key, k)
    return reports, cached


def write_reports(
    spark: SparkSession, reports: dict[str, DataFrame], cfg: LogConfig
) -> dict[str, str]:
    written = {}
    for name, df in reports.items():
        period = REPORTS[name][0]
        written[name] = write_partitioned(
            df,
            cfg.report_table_name(name),
            [period],
            cfg.table_format,
            options=cfg.table_options,
        )
    return written


def read_reports(spark: SparkSession, cfg: LogConfig) -> dict[str, DataFrame]:
    """The written reports, each in report order (period, count desc, key)."""
    out = {}
    for name, (period, key) in REPORTS.items():
        table = read_table(spark, cfg.report_table_name(name))
        out[name] = sort_report(table.select(period, key, COUNT_COL), period, key)
    return out


def preview_tables(spark: SparkSession, cfg: LogConfig, n: int = 5) -> dict[str, DataFrame]:
    """The first ``n`` rows of the raw and processed tables, in time order
    (ties by address and request text), for a quick look."""
    from tidelog.operators.render import preview

    order = ["timestamp", "ip", "timestamp_str", "endpoint", "status", "bytes"]
    return {
        "raw_logs": preview(read_table(spark, cfg.raw_table_name), n, order),
        "processed_logs": preview(read_table(spark, cfg.processed_table_name), n, order),
    }


def union_reports(reports: dict[str, DataFrame]) -> DataFrame:
    """The reports stacked as ``(report, period, key, request_count)``."""
    parts = []
    for name, (period, key) in REPORTS.items():
        parts.append(
            reports[name].select(
                F.lit(name).alias("report"),
                F.col(period).alias("period"),
                F.col(key).alias("key"),
                F.col(COUNT_COL),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
