"""

``entry(spark)`` runs the flagship report (daily top-5 client addresses) on
``oracle_sql()`` the DuckDB SQL that computes the same result directly from
the driver's tables (log fields are derived from ``events`` by the test-data
rules, never by re-parsing text), so parser and reports are checked
independently.

Log lines are rendered from ``events`` by Spark (``lines_from_events``) and
parsed back; a few keys also round-trip them through real files under the
session's shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

# importable from any working directory (the package sits next to this file;
# only the driver imports it - no Python runs inside tasks)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.device import device_type, register_device_function
from tidelog.functions.parse import (
    extract_bytes,
    extract_endpoint,
    extract_ip,
    extract_method,
    extract_protocol,
    extract_status,
    extract_timestamp_str,
    extract_user_agent,
    parse_clf_timestamp,
    parse_fields,
    parse_logs,
    safe_int,
)
from tidelog.functions.periods import (
    day_bucket,
    hour_bucket,
    week_bucket,
    year_week,
    year_week_of_day,
)
from tidelog.operators.enrich import enrich_logs
from tidelog.operators.hitters import (
    TRACKED,
    error_share,
    frequent_keys,
    heavy_hitters,
    key_sketch,
    merge_sketches,
)
from tidelog.operators.layout import apply_layout, count_rows, estimate_rows
from tidelog.operators.metrics import (
    events_as_metrics,
    metrics_by_type,
    metrics_totals,
    read_metrics_json,
    write_metrics_json,
)
from tidelog.operators.placement import place, place_balanced, placement_counts
from tidelog.operators.render import preview, read_csv, read_json, write_csv, write_json
from tidelog.operators.skew import key_skew, partition_counts, partition_extremes, partition_skew
from tidelog.operators.topk import count_by, rank_counts, sort_report, top_k_per_group
from tidelog.config import LogConfig
from tidelog.plans.adhoc import adhoc
from tidelog.plans.jobs import ingest, transform
from tidelog.plans.reports import (
    REPORTS,
    daily_report,
    read_reports,
    union_reports,
    weekly_report,
    with_year_week,
    write_reports,
)
from tidelog.plans.state import count_state, trailing_top_k
from tidelog.session import configure_session, scratch_path
from tidelog.sources.event_logs import lines_from_events, read_events, write_lines
from tidelog.sources.footers import footer_range, table_row_counts
from tidelog.sources.tables import (
    create_database,
    create_table,
    describe_table,
    list_databases,
    list_tables,
    overwrite_partitions,
    read_table,
    replace_table,
)

FLAGSHIP_SF = "/root/testdata/sf0.001"
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
K = 5
TRAILING_DAYS = 7
PLACES = 16
HOT_SHARE = 0.0065
LOOKED_UP = "10.0.0.7"

# ---------------------------------------------------------------- helpers


def _setup(spark: SparkSession) -> SparkSession:
    return configure_session(spark, "UTC")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    _setup(spark)
    return read_events(spark, sf)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_from_events(_events(spark, sf))


def _logs(spark: SparkSession, sf: str, **opts) -> DataFrame:
    """Parsed log rows (raw_logs schema) keyed by ``event_id``."""
    return parse_logs(_lines(spark, sf), keep=("event_id",), **opts)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich_logs(_logs(spark, sf))


def _ts_text(col: str = "timestamp") -> F.Column:
    return F.date_format(col, TS_TEXT).alias(col)


RAW_COLS = [
    "ip",
    "timestamp_str",
    "method",
    "endpoint",
    "protocol",
    "status",
    "bytes",
    "user_agent",
]


def _raw_out(df: DataFrame, with_id: bool = True, enriched: bool = False) -> DataFrame:
    cols = (["event_id"] if with_id else []) + RAW_COLS
    tail = [_ts_text(), "process_date", "hour"]
    if enriched:
        tail += ["device_type", "week"]
    return df.select(*cols, *tail)


def _scratch_db(spark: SparkSession, label: str) -> str:
    name = f"tidelog_{label}_{uuid.uuid4().hex[:10]}"
    create_database(spark, name, scratch_path(spark, f"db-{label}"))
    return name


def _report_cfg(db: str) -> LogConfig:
    return LogConfig(database=db)


def _written_lines(spark: SparkSession, sf: str, label: str) -> str:
    path = scratch_path(spark, label)
    write_lines(lines_from_events(_events(spark, sf), keep_id=False), path)
    return path


# ---------------------------------------------------------------- queries


def q_text_scan(spark, sf):
    from tidelog.sources.text import read_log_lines

    path = _written_lines(spark, sf, "text-scan")
    lines = read_log_lines(spark, path)
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).cast("bigint").alias("n_chars")
    )


def q_table_scan(spark, sf):
    db = _scratch_db(spark, "scan")
    name = f"{db}.raw_logs"
    create_table(_logs(spark, sf), name, ["process_date", "hour"])
    return _raw_out(read_table(spark, name))


def _field_query(name: str, fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        return _lines(spark, sf).select("event_id", fn(F.col("value")).alias(name))

    return run


def q_extract_bytes_compat(spark, sf):
    return _lines(spark, sf).select(
        "event_id", extract_bytes("value", mode="first_int").alias("bytes")
    )


def q_safe_int_cast(spark, sf):
    # last whitespace-delimited token of the line as INT: NULL for the
    # agent tokens, the id for malformed lines
    last = F.regexp_extract("value", r"(\S+)$", 1)
    return _lines(spark, sf).select("event_id", safe_int(last).alias("last_int"))


def q_parse_fields(spark, sf):
    return parse_fields(_lines(spark, sf), keep=("event_id",))


def q_parse_logs(spark, sf):
    return _raw_out(_logs(spark, sf))


def q_enrich_logs(spark, sf):
    return _raw_out(_enriched(spark, sf), enriched=True)


def q_parse_clf_timestamp(spark, sf):
    ts = parse_clf_timestamp(extract_timestamp_str("value"))
    return _lines(spark, sf).select("event_id", F.date_format(ts, TS_TEXT).alias("timestamp"))


def q_day_bucket(spark, sf):
    return _logs(spark, sf).select("event_id", day_bucket("timestamp").alias("process_date"))


def q_hour_bucket(spark, sf):
    return _logs(spark, sf).select("event_id", hour_bucket("timestamp").alias("hour"))


def q_week_bucket(spark, sf):
    return _logs(spark, sf).select("event_id", week_bucket("timestamp").alias("week"))


def _orders(spark, sf):
    _setup(spark)
    return spark.read.parquet(f"{sf}/orders.parquet")


def q_year_week_calendar(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", year_week("o_orderdate", "calendar").alias("year_week"))


def q_year_week_iso(spark, sf):
    o = _orders(spark, sf)
    return o.select("o_orderkey", year_week("o_orderdate", "iso").alias("year_week"))


def q_device_type(spark, sf):
    return _logs(spark, sf).select("event_id", device_type("user_agent").alias("device_type"))


def q_device_type_sql_fn(spark, sf):
    fn = register_device_function(spark)
    view = f"tidelog_logs_{uuid.uuid4().hex[:8]}"
    return adhoc(
        spark,
        f"SELECT event_id, {fn}(user_agent) AS device_type FROM {view}",
        views={view: _logs(spark, sf)},
    )


def q_daily_ip_counts(spark, sf):
    return count_by(_enriched(spark, sf), "process_date", "ip")


def q_daily_device_counts(spark, sf):
    return count_by(_enriched(spark, sf), "process_date", "device_type")


def q_weekly_ip_counts(spark, sf):
    return count_by(with_year_week(_enriched(spark, sf)), "year_week", "ip")


def q_weekly_device_counts(spark, sf):
    return count_by(with_year_week(_enriched(spark, sf)), "year_week", "device_type")


def q_rank_daily(spark, sf):
    return rank_counts(_enriched(spark, sf), "process_date", "ip")


def q_rank_weekly(spark, sf):
    return rank_counts(with_year_week(_enriched(spark, sf)), "year_week", "ip")


def q_daily_top_ips(spark, sf):
    return sort_report(daily_report(_enriched(spark, sf), "ip", K), "process_date", "ip")


def q_daily_top_devices(spark, sf):
    return sort_report(
        daily_report(_enriched(spark, sf), "device_type", K), "process_date", "device_type"
    )


def q_weekly_top_ips(spark, sf):
    return sort_report(weekly_report(_enriched(spark, sf), "ip", K), "year_week", "ip")


def q_weekly_top_devices(spark, sf):
    return sort_report(
        weekly_report(_enriched(spark, sf), "device_type", K), "year_week", "device_type"
    )


def q_top_customers_per_week(spark, sf):
    o = _orders(spark, sf).withColumn("year_week", year_week("o_orderdate", "iso"))
    return top_k_per_group(o, "year_week", "o_custkey", K)


def q_top_suppliers_per_month(spark, sf):
    _setup(spark)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    li = li.withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    return top_k_per_group(li, "ship_month", "l_suppkey", K)


def q_count_logs(spark, sf):
    return count_rows(_logs(spark, sf))


def q_count_records(spark, sf):
    return count_rows(_enriched(spark, sf))


def q_estimate_rows(spark, sf):
    return estimate_rows(_logs(spark, sf), fraction=1.0)


def q_limit_preview(spark, sf):
    cols = ["event_id", "ip", "method", "endpoint", "status", "device_type"]
    return preview(_enriched(spark, sf).select(*cols), 20, order_by=["event_id"])


ADHOC_SQL = (
    "SELECT event_type, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users, "
    "ROUND(SUM(value), 2) AS total_value, MIN(event_id) AS first_event "
    "FROM events GROUP BY event_type"
)


def q_adhoc_sql(spark, sf):
    return adhoc(spark, ADHOC_SQL, views={"events": _events(spark, sf)})


def q_adhoc_params(spark, sf):
    sql = (
        "SELECT event_id, user_id, :label AS label FROM events "
        "WHERE event_type = :kind AND value >= :least"
    )
    args = {"kind": "purchase", "least": 10.5, "label": "it's"}
    return adhoc(spark, sql, views={"events": _events(spark, sf)}, args=args)


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("process_date", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("request_count", T.LongType()),
    ]
)


def q_rows_to_json(spark, sf):
    path = scratch_path(spark, "report-json")
    write_json(daily_report(_enriched(spark, sf), "ip", K), path)
    return read_json(spark, path, REPORT_SCHEMA)


def q_rows_to_csv(spark, sf):
    path = scratch_path(spark, "report-csv")
    write_csv(daily_report(_enriched(spark, sf), "ip", K), path)
    return read_csv(spark, path, REPORT_SCHEMA)


def q_key_skew(spark, sf):
    _setup(spark)
    return key_skew(spark.read.parquet(f"{sf}/lineitem.parquet"), "l_suppkey")


def q_metrics_totals(spark, sf):
    return metrics_totals(events_as_metrics(_events(spark, sf)))


def q_metrics_by_type(spark, sf):
    return metrics_by_type(events_as_metrics(_events(spark, sf)))


def q_metrics_json_roundtrip(spark, sf):
    path = scratch_path(spark, "metrics-json")
    write_metrics_json(events_as_metrics(_events(spark, sf)), path)
    back = read_metrics_json(spark, path)
    return back.select(
        "name", "timestamp", "duration_ms", "type", F.to_json("details").alias("details")
    )


def _placed_by_hour(spark, sf):
    """Logs in PLACES partitions by hour of day: physical counts are known."""
    return place(_logs(spark, sf), PLACES, F.col("hour").cast("int"))


def q_partition_counts(spark, sf):
    return partition_counts(_placed_by_hour(spark, sf))


def q_partition_skew(spark, sf):
    return partition_skew(_placed_by_hour(spark, sf))


def q_partition_extremes(spark, sf):
    return partition_extremes(_placed_by_hour(spark, sf))


def q_placement_counts(spark, sf):
    return placement_counts(_logs(spark, sf), PLACES, F.col("hour").cast("int"))


def q_balanced_placement(spark, sf):
    """Two methods hold nearly all rows; split over 8 partitions they don't skew."""
    placed = place_balanced(_logs(spark, sf), "method", 8)
    return partition_skew(placed).select("n_partitions", "is_skewed")


def q_heavy_hitters(spark, sf):
    return heavy_hitters(_logs(spark, sf), "ip", HOT_SHARE)


def q_weekly_key_sketch(spark, sf):
    """Sketches of each day, merged to weeks."""
    daily = key_sketch(_enriched(spark, sf), "device_type", "process_date")
    weekly = merge_sketches(
        daily.withColumn("year_week", year_week_of_day("process_date")), "year_week"
    )
    return frequent_keys(weekly, "device_type", "year_week")


def q_footer_counts(spark, sf):
    db = _scratch_db(spark, "footers")
    name = f"{db}.raw_logs"
    create_table(_logs(spark, sf), name, ["process_date", "hour"])
    return table_row_counts(spark, name, ["process_date"])


def q_footer_range(spark, sf):
    _setup(spark)
    return footer_range(spark, f"{sf}/orders.parquet", "o_orderkey")


def q_bloom_lookup(spark, sf):
    db = _scratch_db(spark, "bloom")
    cfg = LogConfig(database=db, bloom_columns=("ip",))
    name = cfg.raw_table_name
    create_table(_logs(spark, sf), name, ["process_date"], options=cfg.log_table_options)
    return _raw_out(read_table(spark, name).filter(F.col("ip") == LOOKED_UP))


def q_layout_preserves_rows(spark, sf):
    laid = apply_layout(_logs(spark, sf), ["process_date", "hour"], "dynamic", row_estimate=None)
    return laid.groupBy("process_date").agg(F.count(F.lit(1)).alias("n"))


def q_write_then_read(spark, sf):
    db = _scratch_db(spark, "write")
    name = f"{db}.raw_logs"
    create_table(_logs(spark, sf), name, ["process_date", "hour"])
    return _raw_out(read_table(spark, name))


def q_replace_table(spark, sf):
    db = _scratch_db(spark, "replace")
    name = f"{db}.raw_logs"
    logs = _logs(spark, sf)
    create_table(logs, name, ["process_date", "hour"])
    replace_table(logs.filter(F.col("method") == "POST"), name, ["process_date", "hour"])
    return _raw_out(read_table(spark, name))


def q_overwrite_partitions(spark, sf):
    db = _scratch_db(spark, "overwrite")
    name = f"{db}.raw_logs"
    logs = _logs(spark, sf)
    create_table(logs, name, ["process_date", "hour"])
    # a correction batch: partitions holding POST rows now hold only those
    overwrite_partitions(logs.filter(F.col("method") == "POST"), name, ["process_date", "hour"])
    return _raw_out(read_table(spark, name))


def q_report_tables(spark, sf):
    from tidelog.plans.reports import build_reports

    db = _scratch_db(spark, "reports")
    cfg = _report_cfg(db)
    reports, cached = build_reports(_enriched(spark, sf), K, "calendar")
    try:
        write_reports(spark, reports, cfg)
    finally:
        for df in cached:
            df.unpersist()
    return union_reports(read_reports(spark, cfg))


def _job_cfg(spark, sf, label) -> LogConfig:
    db = _scratch_db(spark, label)
    return LogConfig(input_paths=[_written_lines(spark, sf, f"{label}-lines")], database=db)


def q_ingest_job(spark, sf):
    cfg = _job_cfg(spark, sf, "ingest")
    ingest(spark, cfg)
    return _raw_out(read_table(spark, cfg.raw_table_name), with_id=False)


def q_transform_job(spark, sf):
    cfg = _job_cfg(spark, sf, "transform")
    ingest(spark, cfg)
    transform(spark, cfg)
    return _raw_out(read_table(spark, cfg.processed_table_name), with_id=False, enriched=True)


def q_full_run(spark, sf):
    from tidelog.plans.jobs import run_all

    cfg = _job_cfg(spark, sf, "full")
    run_all(spark, cfg)  # incremental: transform / reports follow the ingested days
    return union_reports(read_reports(spark, cfg))


def _day_lines(spark, sf, label, last_day_only: bool) -> str:
    """Log files of the events' last day, or of all days before it and the
    malformed lines."""
    events = _events(spark, sf)
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    late = (F.to_date("ts") == F.lit(last)) & (F.col("event_id") % 97 != 0)
    path = scratch_path(spark, label)
    write_lines(lines_from_events(events.filter(late if last_day_only else ~late), keep_id=False), path)
    return path


def q_report_state(spark, sf):
    return count_state(_enriched(spark, sf))


def q_incremental_reports(spark, sf):
    """All days but the last, then the last one: its rows and stored counts
    give the reports of its week."""
    from tidelog.plans.jobs import run_all

    db = _scratch_db(spark, "increment")
    for last_day_only in (False, True):
        lines = _day_lines(spark, sf, f"increment-{last_day_only}", last_day_only)
        cfg = LogConfig(input_paths=[lines], database=db)
        run_all(spark, cfg)
    return union_reports(read_reports(spark, cfg))


def q_trailing_top_ips(spark, sf):
    state = count_state(_enriched(spark, sf)).filter(F.col("report_key") == "ip")
    counts = state.select("process_date", F.col("key").alias("ip"), "request_count")
    return trailing_top_k(counts, "ip", TRAILING_DAYS, K)


def q_ingest_stream(spark, sf):
    from tidelog.streaming.ingest import read_ingested, run_ingest_stream

    inbox = _written_lines(spark, sf, "stream-lines")
    root = scratch_path(spark, "stream")
    cfg = LogConfig(input_paths=[inbox])
    run_ingest_stream(spark, cfg, f"{root}/out", f"{root}/checkpoint")
    return _raw_out(read_ingested(spark, f"{root}/out", cfg), with_id=False)


def _split_ingest(spark, sf, label):
    from tidelog.plans.rejects import ingest_split

    cfg = LogConfig(input_paths=[_written_lines(spark, sf, f"{label}-lines")])
    root = scratch_path(spark, label)
    _setup(spark)
    ingest_split(spark, cfg, root, "b1")
    return cfg, root


def q_dead_letters(spark, sf):
    from tidelog.plans.rejects import read_rejected

    rejected = read_rejected(spark, *_split_ingest(spark, sf, "dead"))
    return rejected.select("batch", "line", F.array_join("reasons", ",").alias("reasons"))


def q_accepted_logs(spark, sf):
    from tidelog.plans.rejects import read_accepted

    return _raw_out(read_accepted(spark, *_split_ingest(spark, sf, "accepted")), with_id=False)


def q_list_tables(spark, sf):
    db = _scratch_db(spark, "list")
    create_table(_logs(spark, sf), f"{db}.raw_logs", ["process_date", "hour"])
    # temporary views are listed with every database
    return list_tables(spark, db).filter(~F.col("isTemporary")).select("tableName", "isTemporary")


def q_list_databases(spark, sf):
    db = _scratch_db(spark, "dbs")
    create_table(_logs(spark, sf).select("event_id", "process_date"), f"{db}.ids", ["process_date"])
    # the other databases are those of whoever runs the query
    return (
        list_databases(spark, current=db)
        .filter(F.col("database") == db)
        .select(F.regexp_extract("database", "^tidelog_([a-z]+)_", 1).alias("kind"), "is_current")
    )


def q_describe_table(spark, sf):
    db = _scratch_db(spark, "describe")
    name = f"{db}.raw_logs"
    create_table(_logs(spark, sf), name, ["process_date", "hour"])
    # columns and table kind; paths, times and versions vary
    columns = [f.name for f in _logs(spark, sf).schema]
    stable = F.col("col_name").isin(*columns, "Type", "Provider")
    return describe_table(spark, name).filter(stable).select("col_name", "data_type").distinct()


_FIELD_FNS = {
    "extract_ip": ("ip", extract_ip),
    "extract_timestamp_str": ("timestamp_str", extract_timestamp_str),
    "extract_method": ("method", extract_method),
    "extract_endpoint": ("endpoint", extract_endpoint),
    "extract_protocol": ("protocol", extract_protocol),
    "extract_status": ("status", extract_status),
    "extract_bytes": ("bytes", extract_bytes),
    "extract_user_agent": ("user_agent", extract_user_agent),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily top-5 client addresses on sf0.001."""
    return q_daily_top_ips(spark, FLAGSHIP_SF)


def _llm():
    """The queries of the ``llm`` subpackage, or None where it is not there."""
    try:
        from tidelog.llm import queries as llm
    except ImportError as e:
        if e.name not in ("tidelog.llm", "tidelog.llm.queries"):
            raise
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "text_scan": q_text_scan,
        "table_scan": q_table_scan,
    }
    for key, (name, fn) in _FIELD_FNS.items():
        out[key] = _field_query(name, fn)
    out.update(
        {
            "extract_bytes_compat": q_extract_bytes_compat,
            "safe_int_cast": q_safe_int_cast,
            "parse_fields": q_parse_fields,
            "parse_logs": q_parse_logs,
            "enrich_logs": q_enrich_logs,
            "parse_clf_timestamp": q_parse_clf_timestamp,
            "day_bucket": q_day_bucket,
            "hour_bucket": q_hour_bucket,
            "week_bucket": q_week_bucket,
            "year_week_calendar": q_year_week_calendar,
            "year_week_iso": q_year_week_iso,
            "device_type": q_device_type,
            "device_type_sql_fn": q_device_type_sql_fn,
            "daily_ip_counts": q_daily_ip_counts,
            "daily_device_counts": q_daily_device_counts,
            "weekly_ip_counts": q_weekly_ip_counts,
            "weekly_device_counts": q_weekly_device_counts,
            "rank_daily": q_rank_daily,
            "rank_weekly": q_rank_weekly,
            "daily_top_ips": q_daily_top_ips,
            "daily_top_devices": q_daily_top_devices,
            "weekly_top_ips": q_weekly_top_ips,
            "weekly_top_devices": q_weekly_top_devices,
            "top_customers_per_week": q_top_customers_per_week,
            "top_suppliers_per_month": q_top_suppliers_per_month,
            "count_logs": q_count_logs,
            "count_records": q_count_records,
            "estimate_rows": q_estimate_rows,
            "limit_preview": q_limit_preview,
            "adhoc_sql": q_adhoc_sql,
            "rows_to_json": q_rows_to_json,
            "rows_to_csv": q_rows_to_csv,
            "key_skew": q_key_skew,
            "metrics_totals": q_metrics_totals,
            "metrics_by_type": q_metrics_by_type,
            "metrics_json_roundtrip": q_metrics_json_roundtrip,
            "layout_preserves_rows": q_layout_preserves_rows,
            "write_then_read": q_write_then_read,
            "replace_table": q_replace_table,
            "overwrite_partitions": q_overwrite_partitions,
            "report_tables": q_report_tables,
            "ingest_job": q_ingest_job,
            "transform_job": q_transform_job,
            "full_run": q_full_run,
            "report_state": q_report_state,
            "incremental_reports": q_incremental_reports,
            "trailing_top_ips": q_trailing_top_ips,
            "dead_letters": q_dead_letters,
            "accepted_logs": q_accepted_logs,
            "placement_counts": q_placement_counts,
            "balanced_placement": q_balanced_placement,
            "heavy_hitters": q_heavy_hitters,
            "weekly_key_sketch": q_weekly_key_sketch,
            "footer_counts": q_footer_counts,
            "footer_range": q_footer_range,
            "bloom_lookup": q_bloom_lookup,
            "adhoc_params": q_adhoc_params,
            "ingest_stream": q_ingest_stream,
            # layout- or catalog-dependent: rows-only checks
            "partition_counts": q_partition_counts,
            "partition_skew": q_partition_skew,
            "partition_extremes": q_partition_extremes,
            "list_tables": q_list_tables,
            "list_databases": q_list_databases,
            "describe_table": q_describe_table,
        }
    )
    if llm := _llm():
        out.update(llm.queries())
    return out


# ---------------------------------------------------------------- oracles
#
# ``E``: the expected parse of every line, computed from ``events`` by the
# rendering rules (see tidelog.sources.event_logs).

_E = """
src AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         event_id % 97 = 0 AS corrupt,
         event_id % 10 = 0 AS shifted,
         '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS r_ip,
         strftime(CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 330 MINUTE ELSE ts END,
                  '%d/%b/%Y:%H:%M:%S')
           || CASE WHEN event_id % 10 = 0 THEN ' +0530' ELSE ' +0000' END AS r_time,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS r_method,
         '/' || event_type || '?k=' || json_extract_string(props, '$.k') AS r_endpoint,
         CAST(CASE WHEN event_type = 'error' THEN 500 WHEN event_type = 'signup' THEN 201
                   ELSE 200 END AS INTEGER) AS r_status,
         CAST(floor(value * 100) AS BIGINT) AS r_bytes,
         CASE user_id % 6
           WHEN 0 THEN 'Mozilla/5.0 (iPhone) Mobile/15E148'
           WHEN 1 THEN 'Mozilla/5.0 (X11; Linux x86_64)'
           WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 13; SM-X700)'
           WHEN 3 THEN 'Mozilla/5.0 (iPad; CPU OS 12_0)'
           WHEN 4 THEN 'Mozilla/5.0 (Windows Phone 8.0)'
           ELSE '' END AS r_agent,
         CASE user_id % 6 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Desktop' WHEN 2 THEN 'Tablet'
           WHEN 3 THEN 'Tablet' WHEN 4 THEN 'Mobile' ELSE 'Desktop' END AS r_device
  FROM events
),
lines AS (
  SELECT event_id,
         CASE WHEN corrupt THEN 'corrupt line ' || CAST(event_id AS VARCHAR)
              ELSE r_ip || ' - - [' || r_time || '] "' || r_method || ' ' || r_endpoint
                   || ' HTTP/1.1" ' || CAST(r_status AS VARCHAR) || ' ' || CAST(r_bytes AS VARCHAR)
                   || ' "-" "' || r_agent || '"' END AS line
  FROM src
),
e AS (
  SELECT event_id,
         CASE WHEN corrupt THEN 'corrupt' ELSE r_ip END AS ip,
         CASE WHEN corrupt THEN '' ELSE r_time END AS timestamp_str,
         CASE WHEN corrupt THEN '' ELSE r_method END AS method,
         CASE WHEN corrupt THEN '' ELSE r_endpoint END AS endpoint,
         CASE WHEN corrupt THEN '' ELSE 'HTTP/1.1' END AS protocol,
         CASE WHEN corrupt THEN NULL ELSE r_status END AS status,
         CAST(CASE WHEN corrupt THEN NULL ELSE r_bytes END AS INTEGER) AS bytes,
         CASE WHEN corrupt THEN '' ELSE r_agent END AS user_agent,
         CASE WHEN corrupt THEN NULL
              ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS "timestamp",
         CASE WHEN corrupt THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS process_date,
         CASE WHEN corrupt THEN NULL ELSE strftime(ts, '%H') END AS hour,
         CASE WHEN corrupt THEN 'Desktop' ELSE r_device END AS device_type,
         CASE WHEN corrupt THEN NULL ELSE CAST(weekofyear(ts) AS INTEGER) END AS week,
         CASE WHEN corrupt THEN NULL
              ELSE CAST(year(ts) AS VARCHAR) || '-' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0')
              END AS year_week
  FROM src
)"""


def _with_e(body: str) -> str:
    return "WITH " + _E.strip() + "\n" + body


_RAW_SELECT = (
    "ip, timestamp_str, method, endpoint, protocol, status, bytes, user_agent, "
    '"timestamp", process_date, hour'
)


def _counts_sql(period: str, key: str) -> str:
    return f"SELECT {period}, {key}, COUNT(*) AS request_count FROM e GROUP BY {period}, {key}"


def _ranked_sql(period: str, key: str, source: str) -> str:
    return (
        f"SELECT {period}, {key}, request_count, CAST(ROW_NUMBER() OVER (PARTITION BY {period} "
        f"ORDER BY request_count DESC, {key} ASC NULLS FIRST) AS INTEGER) AS rn FROM ({source}) c"
    )


def _top_sql(period: str, key: str, source: str, k: int = K) -> str:
    return (
        f"SELECT {period}, {key}, request_count FROM ({_ranked_sql(period, key, source)}) r "
        f"WHERE rn <= {k}"
    )


def _year_week_sql(col: str, iso: bool) -> str:
    year = f"isoyear({col})" if iso else f"year({col})"
    return (
        f"CAST({year} AS VARCHAR) || '-' || lpad(CAST(weekofyear({col}) AS VARCHAR), 2, '0')"
    )


def _metrics_src() -> str:
    return (
        "metrics AS (SELECT event_type || CAST(user_id AS VARCHAR) AS name, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS \"timestamp\", value AS duration_ms, "
        "event_type AS type FROM events)"
    )


# rows per partition of logs placed by hour of day
_PLACED_SQL = (
    "SELECT CAST(i AS INTEGER) AS partition_id, CAST(COUNT(p) AS BIGINT) AS count "
    f"FROM range({PLACES}) r(i) LEFT JOIN "
    f"(SELECT COALESCE(CAST(hour AS INTEGER), 0) % {PLACES} AS p FROM e) x ON p = i GROUP BY i"
)


def _union_reports_sql() -> str:
    parts = []
    for name, (period, key) in REPORTS.items():
        parts.append(
            f"SELECT '{name}' AS report, {period} AS period, {key} AS key, request_count "
            f"FROM ({_top_sql(period, key, _counts_sql(period, key))}) t_{name}"
        )
    return _with_e(" UNION ALL ".join(parts))


def oracle_sql() -> dict[str, str]:
    fields = {
        "extract_ip": "ip",
        "extract_timestamp_str": "timestamp_str",
        "extract_method": "method",
        "extract_endpoint": "endpoint",
        "extract_protocol": "protocol",
        "extract_status": "status",
        "extract_bytes": "bytes",
        "extract_user_agent": "user_agent",
    }
    out = {k: _with_e(f"SELECT event_id, {c} FROM e") for k, c in fields.items()}
    raw_with_id = _with_e(f"SELECT event_id, {_RAW_SELECT} FROM e")
    raw_no_id = _with_e(f"SELECT {_RAW_SELECT} FROM e")
    enriched_no_id = _with_e(f"SELECT {_RAW_SELECT}, device_type, week FROM e")
    count_sql = "SELECT COUNT(*) AS count FROM events"
    post_only = _with_e(f"SELECT event_id, {_RAW_SELECT} FROM e WHERE method = 'POST'")
    overwritten = _with_e(
        f"SELECT event_id, {_RAW_SELECT} FROM e WHERE method = 'POST' OR NOT EXISTS ("
        "SELECT 1 FROM e p WHERE p.method = 'POST' "
        "AND p.process_date IS NOT DISTINCT FROM e.process_date "
        "AND p.hour IS NOT DISTINCT FROM e.hour)"
    )
    weekly = "SELECT year_week, {key}, COUNT(*) AS request_count FROM e GROUP BY year_week, {key}"
    out.update(
        {
            "text_scan": _with_e(
                "SELECT COUNT(*) AS n_lines, CAST(SUM(length(line)) AS BIGINT) AS n_chars "
                "FROM lines"
            ),
            "table_scan": raw_with_id,
            "extract_bytes_compat": _with_e("SELECT event_id, status AS bytes FROM e"),
            "safe_int_cast": (
                "SELECT event_id, CASE WHEN event_id % 97 = 0 THEN CAST(event_id AS INTEGER) "
                "END AS last_int FROM events"
            ),
            "parse_fields": _with_e(
                "SELECT event_id, ip, timestamp_str, method, endpoint, protocol, status, "
                "bytes, user_agent FROM e"
            ),
            "parse_logs": raw_with_id,
            "enrich_logs": _with_e(f"SELECT event_id, {_RAW_SELECT}, device_type, week FROM e"),
            "parse_clf_timestamp": _with_e('SELECT event_id, "timestamp" FROM e'),
            "day_bucket": _with_e("SELECT event_id, process_date FROM e"),
            "hour_bucket": _with_e("SELECT event_id, hour FROM e"),
            "week_bucket": _with_e("SELECT event_id, week FROM e"),
            "year_week_calendar": (
                f"SELECT o_orderkey, {_year_week_sql('o_orderdate', False)} AS year_week "
                "FROM orders"
            ),
            "year_week_iso": (
                f"SELECT o_orderkey, {_year_week_sql('o_orderdate', True)} AS year_week "
                "FROM orders"
            ),
            "device_type": _with_e("SELECT event_id, device_type FROM e"),
            "device_type_sql_fn": _with_e("SELECT event_id, device_type FROM e"),
            "daily_ip_counts": _with_e(_counts_sql("process_date", "ip")),
            "daily_device_counts": _with_e(_counts_sql("process_date", "device_type")),
            "weekly_ip_counts": _with_e(weekly.format(key="ip")),
            "weekly_device_counts": _with_e(weekly.format(key="device_type")),
            "rank_daily": _with_e(
                _ranked_sql("process_date", "ip", _counts_sql("process_date", "ip"))
            ),
            "rank_weekly": _with_e(_ranked_sql("year_week", "ip", weekly.format(key="ip"))),
            "daily_top_ips": _with_e(
                _top_sql("process_date", "ip", _counts_sql("process_date", "ip"))
            ),
            "daily_top_devices": _with_e(
                _top_sql("process_date", "device_type", _counts_sql("process_date", "device_type"))
            ),
            "weekly_top_ips": _with_e(_top_sql("year_week", "ip", weekly.format(key="ip"))),
            "weekly_top_devices": _with_e(
                _top_sql("year_week", "device_type", weekly.format(key="device_type"))
            ),
            "top_customers_per_week": _top_sql(
                "year_week",
                "o_custkey",
                f"SELECT {_year_week_sql('o_orderdate', True)} AS year_week, o_custkey, "
                "COUNT(*) AS request_count FROM orders GROUP BY 1, 2",
            ),
            "top_suppliers_per_month": _top_sql(
                "ship_month",
                "l_suppkey",
                "SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, l_suppkey, "
                "COUNT(*) AS request_count FROM lineitem GROUP BY 1, 2",
            ),
            "count_logs": count_sql,
            "count_records": count_sql,
            "estimate_rows": "SELECT COUNT(*) AS estimated_rows FROM events",
            "report_state": _with_e(
                "SELECT 'ip' AS report_key, process_date, ip AS key, COUNT(*) AS request_count "
                "FROM e GROUP BY ALL UNION ALL "
                "SELECT 'device_type', process_date, device_type, COUNT(*) FROM e GROUP BY ALL"
            ),
            "incremental_reports": _union_reports_sql(),
            "dead_letters": _with_e(
                "SELECT 'b1' AS batch, line, 'timestamp,method,endpoint,protocol,status' AS reasons "
                "FROM lines WHERE line LIKE 'corrupt%'"
            ),
            "accepted_logs": _with_e(f"SELECT {_RAW_SELECT} FROM e WHERE process_date IS NOT NULL"),
            "partition_counts": _with_e(_PLACED_SQL),
            "placement_counts": _with_e(_PLACED_SQL),
            "partition_skew": _with_e(
                "SELECT * EXCLUDE (a), ROUND(max_rows / a, 6) AS skew_ratio, "
                "max_rows / a > 3 AS is_skewed "
                "FROM (SELECT COUNT(*) AS n_partitions, MAX(count) AS max_rows, "
                "MIN(count) AS min_rows, ROUND(AVG(count), 6) AS avg_rows, AVG(count) AS a "
                f"FROM ({_PLACED_SQL}) p) s"
            ),
            "partition_extremes": _with_e(
                "SELECT side, partition_id, count, ROUND(count / a, 6) AS ratio_to_avg FROM ("
                "SELECT *, AVG(count) OVER () AS a, "
                "ROW_NUMBER() OVER (ORDER BY count DESC, partition_id) AS most, "
                "ROW_NUMBER() OVER (ORDER BY count, partition_id) AS least "
                f"FROM ({_PLACED_SQL}) p) s JOIN (VALUES ('most'), ('least')) v(side) "
                "ON CASE side WHEN 'most' THEN most ELSE least END <= 5"
            ),
            "balanced_placement": (
                "SELECT CAST(8 AS BIGINT) AS n_partitions, COUNT(*) < 0 AS is_skewed FROM events"
            ),
            "heavy_hitters": _with_e(
                'SELECT ip, n AS "rows", ROUND(n / t, 6) AS share FROM ('
                "SELECT ip, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS t FROM e GROUP BY ip) c "
                f"WHERE n / t > {HOT_SHARE}"
            ),
            "weekly_key_sketch": _with_e(
                "SELECT year_week, device_type, "
                f"GREATEST(n - CAST(FLOOR(t * {error_share(TRACKED)}) AS BIGINT), 1) AS at_least, "
                'n AS at_most, CAST(t AS BIGINT) AS "rows" FROM (SELECT year_week, device_type, '
                "COUNT(*) AS n, SUM(COUNT(*)) OVER (PARTITION BY year_week) AS t "
                "FROM e GROUP BY year_week, device_type) c"
            ),
            "footer_counts": _with_e(
                'SELECT process_date, COUNT(*) AS "rows" FROM e GROUP BY process_date'
            ),
            "footer_range": (
                'SELECT COUNT(*) AS "rows", COUNT(o_orderkey) AS n_values, '
                "MIN(o_orderkey) AS least, MAX(o_orderkey) AS greatest FROM orders"
            ),
            "bloom_lookup": _with_e(
                f"SELECT event_id, {_RAW_SELECT} FROM e WHERE ip = '{LOOKED_UP}'"
            ),
            "adhoc_params": (
                "SELECT event_id, user_id, 'it''s' AS label FROM events "
                "WHERE event_type = 'purchase' AND value >= 10.5"
            ),
            "list_tables": (
                "SELECT 'raw_logs' AS \"tableName\", COUNT(*) < 0 AS \"isTemporary\" FROM events"
            ),
            "list_databases": "SELECT 'dbs' AS kind, COUNT(*) >= 0 AS is_current FROM events",
            "describe_table": (
                "SELECT * FROM (VALUES ('event_id', 'bigint'), ('ip', 'string'), "
                "('timestamp_str', 'string'), ('method', 'string'), ('endpoint', 'string'), "
                "('protocol', 'string'), ('status', 'int'), ('bytes', 'int'), "
                "('user_agent', 'string'), ('timestamp', 'timestamp'), ('process_date', 'string'), "
                "('hour', 'string'), ('Type', 'MANAGED'), ('Provider', 'parquet')) "
                "t(col_name, data_type)"
            ),
            "trailing_top_ips": _with_e(
                _top_sql(
                    "process_date",
                    "ip",
                    "SELECT d.process_date, e.ip, COUNT(*) AS request_count FROM "
                    "(SELECT DISTINCT process_date FROM e WHERE process_date IS NOT NULL) d "
                    "JOIN e ON CAST(e.process_date AS DATE) BETWEEN CAST(d.process_date AS DATE) - "
                    f"{TRAILING_DAYS - 1} AND CAST(d.process_date AS DATE) GROUP BY 1, 2",
                )
            ),
            "limit_preview": _with_e(
                "SELECT event_id, ip, method, endpoint, status, device_type FROM e "
                "ORDER BY event_id LIMIT 20"
            ),
            "adhoc_sql": ADHOC_SQL,
            "rows_to_json": _with_e(
                _top_sql("process_date", "ip", _counts_sql("process_date", "ip"))
            ),
            "rows_to_csv": _with_e(
                _top_sql("process_date", "ip", _counts_sql("process_date", "ip"))
            ),
            "key_skew": (
                "SELECT COUNT(*) AS n_keys, MAX(rows) AS max_rows, MIN(rows) AS min_rows, "
                "ROUND(AVG(rows), 6) AS avg_rows, "
                "ROUND(CASE WHEN AVG(rows) > 0 THEN MAX(rows) / AVG(rows) END, 6) AS skew_ratio, "
                "COALESCE(CASE WHEN AVG(rows) > 0 THEN MAX(rows) / AVG(rows) END > 3, false) "
                "AS is_skewed "
                "FROM (SELECT l_suppkey, COUNT(*) AS rows FROM lineitem GROUP BY l_suppkey) k"
            ),
            "metrics_totals": (
                f"WITH {_metrics_src()} SELECT COUNT(*) AS total_operations, "
                "ROUND(SUM(duration_ms), 6) AS total_duration_ms, "
                "ROUND(AVG(duration_ms), 6) AS avg_duration_ms FROM metrics"
            ),
            "metrics_by_type": (
                f"WITH {_metrics_src()} SELECT type, COUNT(*) AS count, "
                "ROUND(AVG(duration_ms), 6) AS avg_duration_ms, "
                "MIN(duration_ms) AS min_duration_ms, MAX(duration_ms) AS max_duration_ms "
                "FROM metrics GROUP BY type"
            ),
            "metrics_json_roundtrip": (
                f"WITH {_metrics_src()} SELECT name, \"timestamp\", duration_ms, type, "
                "CAST(NULL AS VARCHAR) AS details FROM metrics"
            ),
            "layout_preserves_rows": _with_e(
                "SELECT process_date, COUNT(*) AS n FROM e GROUP BY process_date"
            ),
            "write_then_read": raw_with_id,
            "replace_table": post_only,
            "overwrite_partitions": overwritten,
            "report_tables": _union_reports_sql(),
            "ingest_job": raw_no_id,
            "transform_job": enriched_no_id,
            "full_run": _union_reports_sql(),
            "ingest_stream": raw_no_id,
        }
    )
    if llm := _llm():
        out.update(llm.oracle_sql())
    return out
