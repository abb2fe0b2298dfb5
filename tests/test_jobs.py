"""Ingest -> transform -> report jobs on real files."""

import uuid

from pyspark.sql import functions as F

from tests.conftest import SF001, plan_text, sorted_rows
from tidelog.config import LogConfig
from tidelog.operators.metrics import MetricsRecorder
from tidelog.plans.jobs import ingest, report, run_all, transform
from tidelog.plans.reports import REPORTS, build_reports, daily_report, read_reports, weekly_report
from tidelog.session import scratch_path
from tidelog.sources.event_logs import lines_from_events, read_events, write_lines
from tidelog.sources.tables import read_table


def _cfg(spark, **kw):
    path = scratch_path(spark, "tests-lines")
    events = read_events(spark, SF001)
    write_lines(lines_from_events(events, keep_id=False), path)
    return LogConfig(input_paths=[path], database=f"jobs_{uuid.uuid4().hex[:8]}", **kw)


_rows = sorted_rows


def test_full_run_and_idempotent_rerun(spark):
    cfg = _cfg(spark)
    rec = MetricsRecorder()
    out = run_all(spark, cfg, rec)
    n = read_events(spark, SF001).count()
    assert out["ingest"].rows == n and out["transform"].rows == n
    assert out["ingest"].malformed == len(range(0, n, 97))
    raw = _rows(read_table(spark, cfg.raw_table_name))
    reports = {k: _rows(v) for k, v in read_reports(spark, cfg).items()}
    # reports equal the direct (unrolled) computation from the processed table
    logs = read_table(spark, cfg.processed_table_name)
    for name, (period, key) in REPORTS.items():
        direct = (daily_report if period == "process_date" else weekly_report)(logs, key, 5)
        assert reports[name] == _rows(direct), name
    # second run over the same input changes nothing
    run_all(spark, cfg, rec)
    assert _rows(read_table(spark, cfg.raw_table_name)) == raw
    assert {k: _rows(v) for k, v in read_reports(spark, cfg).items()} == reports
    assert [r[0] for r in rec.records] == ["ingestion", "transformation", "analytics"] * 2


def test_ingest_options(spark):
    cfg = _cfg(spark, drop_malformed=True, bytes_mode="first_int")
    res = ingest(spark, cfg)
    raw = read_table(spark, cfg.raw_table_name)
    assert raw.filter(F.col("timestamp").isNull()).count() == 0
    assert raw.filter(F.col("bytes") != F.col("status")).count() == 0
    assert res.rows == raw.count() + res.malformed or res.malformed == 0


def test_transform_adds_columns_without_shuffle(spark):
    cfg = _cfg(spark)
    ingest(spark, cfg)
    transform(spark, cfg)
    processed = read_table(spark, cfg.processed_table_name)
    assert {"device_type", "week"} <= set(processed.columns)
    assert processed.filter(F.col("device_type").isNull()).count() == 0
    from tidelog.operators.enrich import enrich_logs

    plan = plan_text(enrich_logs(read_table(spark, cfg.raw_table_name)))
    assert "Exchange" not in plan


def test_report_partitions_and_counts(spark):
    cfg = _cfg(spark)
    ingest(spark, cfg)
    transform(spark, cfg)
    report(spark, cfg)
    daily = read_table(spark, cfg.report_table_name("daily_top_ips"))
    per_day = daily.groupBy("process_date").count().collect()
    assert all(r["count"] <= 5 for r in per_day)
    assert any(r.process_date is None for r in per_day)  # the malformed-line group


def test_empty_input_gives_empty_reports(spark):
    empty = spark.createDataFrame([], "process_date string, ip string, device_type string")
    reports, cached = build_reports(empty)
    try:
        assert all(df.count() == 0 for df in reports.values())
    finally:
        for df in cached:
            df.unpersist()


def test_metrics_path_and_previews(spark):
    from tidelog.operators.metrics import metrics_by_type, read_metrics_json
    from tidelog.plans.reports import preview_tables

    cfg = _cfg(spark)
    path = scratch_path(spark, "tests-run-metrics")
    run_all(spark, cfg, metrics_path=path)
    back = read_metrics_json(spark, path)
    assert sorted(r.name for r in back.collect()) == ["analytics", "ingestion", "transformation"]
    assert metrics_by_type(back).first()["count"] == 3
    previews = preview_tables(spark, cfg, 5)
    assert all(df.count() == 5 for df in previews.values())
    first = previews["raw_logs"].first()
    assert first.timestamp is None  # malformed lines (NULL time) sort first


def test_incremental_runs_equal_full_recompute(spark):
    """Two batches split by day (the split day's week spans both): the
    incremental reports equal reports recomputed from the final tables."""
    root = scratch_path(spark, "tests-incr")
    events = read_events(spark, SF001)
    early = events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    late = events.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    write_lines(lines_from_events(early, keep_id=False), f"{root}/a")
    write_lines(lines_from_events(late, keep_id=False), f"{root}/b")
    db = f"incr_{uuid.uuid4().hex[:8]}"
    cfg = LogConfig(input_paths=[f"{root}/a"], database=db)
    first = run_all(spark, cfg)
    assert first["ingest"].days[-1] == "2024-01-15"
    cfg.input_paths = [f"{root}/b"]
    second = run_all(spark, cfg)
    assert second["ingest"].days[0] == "2024-01-16"
    # the processed table holds both batches' days
    processed = read_table(spark, cfg.processed_table_name)
    assert processed.filter(F.col("process_date").isNotNull()).count() == (
        events.count() - events.filter(F.col("event_id") % 97 == 0).count()
    )
    stored = {k: _rows(v) for k, v in read_reports(spark, cfg).items()}
    for name, (period, key) in REPORTS.items():
        direct = (daily_report if period == "process_date" else weekly_report)(processed, key, 5)
        assert stored[name] == _rows(direct), name


def test_adhoc_over_job_tables_prunes_partitions(spark):
    from tidelog.plans.adhoc import adhoc, job_views

    cfg = _cfg(spark)
    run_all(spark, cfg)
    views = job_views(spark, cfg)
    assert set(views) == {"raw_logs", "processed_logs", *REPORTS}
    df = adhoc(
        spark,
        "SELECT device_type, COUNT(*) AS n FROM processed_logs "
        "WHERE process_date = '2024-01-05' GROUP BY device_type",
        views=views,
    )
    assert sum(r.n for r in df.collect()) > 0
    scan = [l for l in plan_text(df).split("\n") if "FileScan" in l][0]
    assert "PartitionFilters" in scan and "2024-01-05" in scan


def test_config_errors(spark):
    import pytest

    from tidelog.streaming.ingest import start_ingest_stream

    with pytest.raises(ValueError):
        ingest(spark, LogConfig(input_paths=[], database="unused_db"))
    with pytest.raises(ValueError):
        start_ingest_stream(spark, LogConfig(input_paths=["a", "b"]), "out", "ckpt")


def test_backfill_is_stable(spark):
    from tidelog.plans.jobs import backfill

    cfg = _cfg(spark)
    run_all(spark, cfg)
    before = {k: _rows(v) for k, v in read_reports(spark, cfg).items()}
    processed = _rows(read_table(spark, cfg.processed_table_name))
    out = backfill(spark, cfg, ["2024-01-03", "2024-01-17"])
    assert out["transform"].rows > 0 and out["transform"].malformed == 0
    assert _rows(read_table(spark, cfg.processed_table_name)) == processed
    assert {k: _rows(v) for k, v in read_reports(spark, cfg).items()} == before


def test_ingest_nested_input(spark):
    root = scratch_path(spark, "tests-nested-in")
    events = read_events(spark, SF001)
    write_lines(lines_from_events(events.filter(F.col("event_id") < 500), keep_id=False), f"{root}/a/1")
    write_lines(lines_from_events(events.filter(F.col("event_id") >= 500), keep_id=False), f"{root}/b/2")
    cfg = LogConfig(
        input_paths=[root],
        database=f"nested_{uuid.uuid4().hex[:8]}",
        recursive=True,
        file_filter="part-*",
    )
    assert ingest(spark, cfg).rows == events.count()
