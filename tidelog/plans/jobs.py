"""Ingest -> transform -> report jobs.

Each job reads its input lazily, writes a partitioned table with dynamic
partition overwrite (re-running the same input is idempotent) and returns
row counts gathered with ``observe`` during the write - no extra scan.
Lineage is cut at every table, so a lost executor only re-runs tasks of the
current job.

Runs are incremental: ingest also observes which days it wrote, transform
then re-processes only those day partitions and the reports recompute only
those days and the weeks that contain them.  The day filters are partition
filters, so untouched history is never listed or read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.config import LogConfig
from tidelog.functions.device import register_device_function
from tidelog.functions.parse import parse_logs
from tidelog.operators.enrich import enrich_logs
from tidelog.operators.layout import apply_layout
from tidelog.operators.metrics import MetricsRecorder, write_metrics_json
from tidelog.plans.days import day_filter, week_filter
from tidelog.plans.rejects import attach_accepted, ingest_split
from tidelog.plans.reports import build_reports, write_reports
from tidelog.plans.state import refresh_state, state_reports
from tidelog.session import configure_session
from tidelog.sources.tables import create_database, read_table, write_partitioned
from tidelog.sources.text import read_log_lines

LOG_PARTITIONS = ("process_date", "hour")


@dataclass
class JobResult:
    rows: int = 0
    malformed: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    # days (process_date values) written by an ingest; None when not tracked
    days: list[str] | None = None
    # with a dead-letter side: lines per failed field, (day, hour) pairs written
    rejected: dict[str, int] = field(default_factory=dict)
    hours: list[tuple[str, str]] = field(default_factory=list)


def _observed(
    df: DataFrame, name: str, track_days: bool = False
) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("timestamp").isNull()).alias("malformed"),
    ]
    if track_days:
        # one value per distinct day in the batch: bounded by its time span
        metrics.append(F.collect_set("process_date").alias("days"))
    return df.observe(obs, *metrics), obs


def _layout(df: DataFrame, cfg: LogConfig) -> DataFrame:
    return apply_layout(
        df,
        LOG_PARTITIONS,
        cfg.layout,
        base=cfg.base_partitions,
        maximum=cfg.max_partitions,
        target_rows=cfg.target_rows_per_partition,
        salt_buckets=cfg.salt_buckets,
    )


def _sorted_files(df: DataFrame, cfg: LogConfig) -> DataFrame:
    """Orders rows inside each task by partition columns, then
    ``cfg.sort_within``.  The writer needs the partition-column order
    anyway, so the extra keys add comparisons, not a sort or a shuffle."""
    if not cfg.sort_within:
        return df
    return df.sortWithinPartitions(*LOG_PARTITIONS, *cfg.sort_within)


def parsed_lines(spark: SparkSession, cfg: LogConfig) -> DataFrame:
    if not cfg.input_paths:
        raise ValueError("LogConfig.input_paths is empty")
    lines = read_log_lines(
        spark, cfg.input_paths, recursive=cfg.recursive, file_filter=cfg.file_filter
    )
    return parse_logs(
        lines,
        bytes_mode=cfg.bytes_mode,
        bytes_type=cfg.bytes_type,
        strict=cfg.strict,
        drop_malformed=cfg.drop_malformed,
    )


def ingest(spark: SparkSession, cfg: LogConfig) -> JobResult:
    """Text files -> parsed ``raw_logs`` table partitioned by (day, hour).

    With ``cfg.split_root``, rejected lines go to its dead-letter side in the
    same pass and the raw table lies over its accepted rows.
    """
    if not cfg.input_paths:
        raise ValueError("LogConfig.input_paths is empty")
    configure_session(spark, cfg.time_zone)
    if cfg.split_root:
        result = ingest_split(spark, cfg, cfg.split_root, cfg.batch)
        result.tables["raw"] = attach_accepted(spark, cfg, cfg.split_root, result.hours)
        return result
    create_database(spark, cfg.database, cfg.database_location)
    # observed above the layout shuffle, in the write stage: a shuffle stage
    # recomputed after a lost executor would count its rows again
    laid, obs = _observed(_layout(parsed_lines(spark, cfg), cfg), "ingest", track_days=True)
    # the layout decides clustering; the writer adds no second shuffle
    write_partitioned(
        _sorted_files(laid, cfg),
        cfg.raw_table_name,
        LOG_PARTITIONS,
        cfg.table_format,
        cluster=False,
        options=cfg.log_table_options,
    )
    m = obs.get
    return JobResult(
        m["rows"], m["malformed"], {"raw": cfg.raw_table_name}, sorted(m["days"] or [])
    )


def transform(
    spark: SparkSession,
    cfg: LogConfig,
    days: list[str] | None = None,
    include_null: bool = True,
) -> JobResult:
    """``raw_logs`` -> ``processed_logs`` (+ device_type, week), for all days
    or only ``days`` (plus the NULL day when ``include_null``).

    The input table is already partitioned by (day, hour) and every file
    holds one partition, so the rows go straight to the writer: no shuffle.
    """
    configure_session(spark, cfg.time_zone)
    register_device_function(spark)
    raw = read_table(spark, cfg.raw_table_name)
    selected = day_filter(days, include_null)
    if selected is not None:
        raw = raw.filter(selected)
    enriched, obs = _observed(enrich_logs(raw), "transform")
    write_partitioned(
        _sorted_files(enriched, cfg),
        cfg.processed_table_name,
        LOG_PARTITIONS,
        cfg.table_format,
        cluster=False,
        options=cfg.log_table_options,
    )
    m = obs.get
    return JobResult(m["rows"], m["malformed"], {"processed": cfg.processed_table_name})


def report(
    spark: SparkSession,
    cfg: LogConfig,
    days: list[str] | None = None,
    include_null: bool = True,
) -> JobResult:
    """``processed_logs`` -> the four top-k report tables.

    With ``days``, only the daily reports of those days and the weekly
    reports of the weeks containing them are recomputed and overwritten.
    Reports come from the stored counts (``plans.state``): the processed rows
    of ``days`` are counted, the other days of their weeks are not read.
    """
    configure_session(spark, cfg.time_zone)
    if cfg.report_state:
        state = refresh_state(spark, cfg, days, include_null)
        tables = write_reports(spark, state_reports(spark, cfg, days, include_null), cfg)
        return JobResult(tables=tables | {"state": state})
    logs = read_table(spark, cfg.processed_table_name).select(
        "process_date", "ip", "device_type"
    )
    weeks = week_filter(spark, days, cfg.year_week, include_null)
    if weeks is not None:
        logs = logs.filter(weeks)
    reports, cached = build_reports(logs, cfg.top_k, cfg.year_week)
    selected = day_filter(days, include_null)
    if selected is not None:
        for name in ("daily_top_ips", "daily_top_devices"):
            reports[name] = reports[name].filter(selected)
    try:
        tables = write_reports(spark, reports, cfg)
    finally:
        for df in cached:
            df.unpersist()
    return JobResult(tables=tables)


def run_all(
    spark: SparkSession,
    cfg: LogConfig,
    recorder: MetricsRecorder | None = None,
    metrics_path: str | None = None,
    incremental: bool = True,
) -> dict[str, JobResult]:
    """The full run: ingest, transform, reports.

    ``incremental`` (default) limits transform and reports to the days the
    ingest wrote; otherwise both re-process the whole tables.  Each job is
    timed into ``recorder``; with ``metrics_path`` the records of this run
    are appended there as JSON lines (``read_metrics_json``).
    """
    recorder = recorder or MetricsRecorder()
    first = len(recorder.records)
    out = {}
    with recorder.timed("ingestion", "job"):
        out["ingest"] = ingest(spark, cfg)
    days = out["ingest"].days if incremental else None
    # rejected lines aren't in the raw table, so there is no NULL day
    include_null = (out["ingest"].malformed > 0 and not cfg.split_root) if incremental else True
    with recorder.timed("transformation", "job"):
        out["transform"] = transform(spark, cfg, days, include_null)
    with recorder.timed("analytics", "job"):
        out["report"] = report(spark, cfg, days, include_null)
    if metrics_path:
        run = MetricsRecorder()
        run.records = recorder.records[first:]
        write_metrics_json(run.to_df(spark), metrics_path)
    return out


def backfill(
    spark: SparkSession, cfg: LogConfig, days: list[str], include_null: bool = False
) -> dict[str, JobResult]:
    """Re-derives ``processed_logs`` and the reports for ``days`` from the raw
    table, without re-ingesting (e.g. after a change of device rules).  Only
    those days' partitions and their weeks are read and overwritten."""
    return {
        "transform": transform(spark, cfg, days, include_null),
        "report": report(spark, cfg, days, include_null),
    }
