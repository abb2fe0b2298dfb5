"""Mergeable report state: stored counts per (day, key).

``daily_counts`` holds, for each report key (``ip``, ``device_type``), how
often each value occurs on each day, partitioned by (report key, day).
Counts of disjoint rows add up, so every longer period is a sum over days:
weeks, date ranges and trailing windows never go back to the log rows.  An
increment reads the processed rows of its own days only, replaces those
days' counts and takes everything else from the state.

A day's counts are replaced as a whole (dynamic partition overwrite), so a
re-run changes nothing and a day that lost rows is corrected.  Requested days
without rows get a zero row in place of stale counts; ``read_state`` hides
zero rows.  NULL days (malformed lines) are a partition of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.config import LogConfig
from tidelog.functions.periods import DAY_FORMAT, year_week_of_day
from tidelog.operators.topk import COUNT_COL, count_by, top_k_of_counts
from tidelog.plans.days import day_filter, week_filter
from tidelog.sources.tables import (
    create_table,
    overwrite_partitions,
    read_table,
    replace_table,
    table_exists,
)

STATE_KEYS = ("ip", "device_type")
STATE_PARTITIONS = ("report_key", "process_date")
STATE_COLUMNS = ("key", COUNT_COL, *STATE_PARTITIONS)


def count_state(logs: DataFrame) -> DataFrame:
    """State rows of ``logs`` (process_date and the report keys).

    One scan: rows are counted per (day, all keys), map-side first, and each
    key's counts are sums over that one shuffle.
    """
    base = count_by(logs.select("process_date", *STATE_KEYS), "process_date", STATE_KEYS)
    parts = [
        base.groupBy("process_date", F.col(key).alias("key"))
        .agg(F.sum(COUNT_COL).alias(COUNT_COL))
        .withColumn("report_key", F.lit(key))
        for key in STATE_KEYS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*STATE_COLUMNS)


def merge_state(*states: DataFrame) -> DataFrame:
    """The state of the union of disjoint rows."""
    out = states[0]
    for state in states[1:]:
        out = out.unionByName(state)
    return (
        out.groupBy(*STATE_PARTITIONS, "key")
        .agg(F.sum(COUNT_COL).alias(COUNT_COL))
        .select(*STATE_COLUMNS)
    )


def zero_state(spark: SparkSession, days: list[str | None]) -> DataFrame:
    """A zero row for every (report key, day): merging it changes no count."""
    rows = [(None, 0, key, day) for key in STATE_KEYS for day in days]
    schema = f"key string, {COUNT_COL} bigint, report_key string, process_date string"
    return spark.createDataFrame(rows, schema)


def refresh_state(
    spark: SparkSession, cfg: LogConfig, days: list[str] | None = None, include_null: bool = True
) -> str:
    """Recounts ``days`` (all with None, or before the first state) from the
    processed table and replaces their counts; other days are neither read
    nor written."""
    name = cfg.state_table_name
    logs = read_table(spark, cfg.processed_table_name)
    exists = table_exists(spark, name)
    if days is None or not exists:
        fresh = count_state(logs)
        if exists:
            return replace_table(
                fresh, name, STATE_PARTITIONS, cfg.table_format, options=cfg.table_options
            )
        return create_table(
            fresh, name, STATE_PARTITIONS, cfg.table_format, options=cfg.table_options
        )
    if not days and not include_null:
        return name
    counted = count_state(logs.filter(day_filter(days, include_null)))
    touched = [*days, None] if include_null else list(days)
    return overwrite_partitions(
        merge_state(counted, zero_state(spark, touched)), name, STATE_PARTITIONS, cfg.table_format
    )


def read_state(spark: SparkSession, cfg: LogConfig, key: str) -> DataFrame:
    """(process_date, <key>, request_count) of one report key."""
    if key not in STATE_KEYS:
        raise ValueError(f"key must be one of {STATE_KEYS}, got {key!r}")
    return (
        read_table(spark, cfg.state_table_name)
        .filter((F.col("report_key") == key) & (F.col(COUNT_COL) > 0))
        .select("process_date", F.col("key").alias(key), COUNT_COL)
    )


def state_reports(
    spark: SparkSession,
    cfg: LogConfig,
    days: list[str] | None = None,
    include_null: bool = True,
) -> dict[str, DataFrame]:
    """The four reports from the state: the daily ones of ``days``, the
    weekly ones of the weeks that contain them (all with None)."""
    of_days = day_filter(days, include_null)
    of_weeks = week_filter(spark, days, cfg.year_week, include_null)
    out = {}
    for key, daily, weekly in (
        ("ip", "daily_top_ips", "weekly_top_ips"),
        ("device_type", "daily_top_devices", "weekly_top_devices"),
    ):
        counts = read_state(spark, cfg, key)
        in_days = counts if of_days is None else counts.filter(of_days)
        in_weeks = counts if of_weeks is None else counts.filter(of_weeks)
        out[daily] = top_k_of_counts(in_days, "process_date", key, cfg.top_k)
        out[weekly] = period_top_k(
            in_weeks, key, year_week_of_day("process_date", cfg.year_week), "year_week", cfg.top_k
        )
    return out


def period_top_k(
    counts: DataFrame, key: str, period: Column, name: str, k: int = 5
) -> DataFrame:
    """The top ``k`` per period, any function of ``process_date``."""
    summed = counts.groupBy(period.alias(name), key).agg(F.sum(COUNT_COL).alias(COUNT_COL))
    return top_k_of_counts(summed, name, key, k)


def top_k_between(
    spark: SparkSession, cfg: LogConfig, key: str, first_day: str, last_day: str, k: int = 5
) -> DataFrame:
    """The top ``k`` of a range of days (both ends included), ranked with
    ``rn``; a partition filter, so only those days' counts are read."""
    in_range = read_state(spark, cfg, key).filter(
        F.col("process_date").between(F.lit(first_day), F.lit(last_day))
    )
    summed = in_range.groupBy(key).agg(F.sum(COUNT_COL).alias(COUNT_COL))
    order = [F.col(COUNT_COL).desc(), F.col(key).asc_nulls_first()]
    # k rows of each task meet in the one that numbers them
    top = summed.orderBy(*order).limit(k)
    return top.select(key, COUNT_COL, F.row_number().over(Window.orderBy(*order)).alias("rn"))


def trailing_top_k(counts: DataFrame, key: str, days: int = 7, k: int = 5) -> DataFrame:
    """For every day that has counts, the top ``k`` of the ``days`` days that
    end with it: (process_date, <key>, request_count).

    Each count is sent to the windows it belongs to (map-side summed), which
    are then kept where their last day exists; no row is joined with rows of
    its key.
    """
    if days < 1:
        raise ValueError("days must be >= 1")
    day = F.try_to_date("process_date", DAY_FORMAT)
    known = counts.filter(day.isNotNull())
    ends = F.explode(F.sequence(day, F.date_add(day, days - 1))).alias("_end")
    summed = (
        known.select(ends, key, COUNT_COL)
        .groupBy(F.date_format("_end", DAY_FORMAT).alias("process_date"), key)
        .agg(F.sum(COUNT_COL).alias(COUNT_COL))
    )
    present = known.select("process_date").distinct()
    windows = summed.join(present, "process_date", "left_semi")
    return top_k_of_counts(windows, "process_date", key, k)


def state_drift(spark: SparkSession, cfg: LogConfig) -> DataFrame:
    """Days whose counts don't add up to the processed rows:
    (process_date, report_key, rows, counted); empty when the state is right."""
    rows = (
        read_table(spark, cfg.processed_table_name)
        .groupBy("process_date")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("report_key", F.explode(F.array(*[F.lit(k) for k in STATE_KEYS])))
    )
    counted = (
        read_table(spark, cfg.state_table_name)
        .groupBy("process_date", "report_key")
        .agg(F.sum(COUNT_COL).alias("counted"))
        .withColumnsRenamed({"process_date": "_day", "report_key": "_key"})
    )
    same = F.col("process_date").eqNullSafe(F.col("_day")) & (F.col("report_key") == F.col("_key"))
    zero = F.lit(0).cast("bigint")
    return (
        # days and keys, not rows: as many as the table has partitions
        rows.join(counted, same, "full_outer")
        .select(
            F.coalesce("process_date", "_day").alias("process_date"),
            F.coalesce("report_key", "_key").alias("report_key"),
            F.coalesce("rows", zero).alias("rows"),
            F.coalesce("counted", zero).alias("counted"),
        )
        .filter(F.col("rows") != F.col("counted"))
    )
