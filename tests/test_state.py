"""Stored counts: merging, increments that read their own days only, periods."""

import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, plan_text, sorted_rows
from tidelog.config import LogConfig
from tidelog.operators.topk import top_k_per_group
from tidelog.plans.days import day_filter
from tidelog.plans.jobs import backfill, ingest, report, run_all, transform
from tidelog.plans.reports import REPORTS, daily_report, read_reports, weekly_report
from tidelog.plans.state import (
    STATE_KEYS,
    count_state,
    merge_state,
    read_state,
    refresh_state,
    state_drift,
    state_reports,
    top_k_between,
    trailing_top_k,
)
from tidelog.session import scratch_path
from tidelog.sources.event_logs import lines_from_events, read_events, write_lines
from tidelog.sources.tables import read_table

SPLIT = "2024-01-16"  # a Tuesday: its week has a day on the other side
LOGS = "process_date string, ip string, device_type string"


def _lines(spark, where):
    path = scratch_path(spark, "state-lines")
    # the days around the split
    days = F.date_format("ts", "yyyy-MM-dd").between("2024-01-09", SPLIT)
    events = read_events(spark, SF001).filter(days & (F.hour("ts") % 8 == 0)).filter(where)
    write_lines(lines_from_events(events, keep_id=False), path)
    return path


def _cfg(path, **kw):
    return LogConfig(input_paths=[path], database=f"state_{uuid.uuid4().hex[:8]}", **kw)


def _drop_days(spark, cfg, days):
    name = cfg.processed_table_name
    for r in read_table(spark, name).select("process_date", "hour").distinct().collect():
        if r["process_date"] in days:
            spec = f"process_date='{r['process_date']}', hour='{r['hour']}'"
            spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")


def _state(spark, cfg):
    return sorted_rows(read_table(spark, cfg.state_table_name).filter("request_count > 0"))


@pytest.fixture(scope="module")
def early_late(spark):
    day = F.date_format("ts", "yyyy-MM-dd")
    good = F.col("event_id") % 97 != 0
    return _lines(spark, (day < SPLIT) | ~good), _lines(spark, (day == SPLIT) & good)


def _all_reports(spark, cfg):
    return {k: sorted_rows(v) for k, v in read_reports(spark, cfg).items()}


def test_merge_is_the_state_of_the_union(spark):
    rows = [("2024-01-01", f"a{i % 3}", "Mobile") for i in range(9)]
    rows += [("2024-01-02", None, "Tablet"), (None, "a0", None), (None, "a0", None)]
    whole = sorted_rows(count_state(spark.createDataFrame(rows, LOGS)))
    for at in (0, 4, len(rows)):
        parts = [count_state(spark.createDataFrame(p, LOGS)) for p in (rows[:at], rows[at:])]
        assert sorted_rows(merge_state(*parts)) == whole


def test_counts_come_from_one_scan(spark):
    rows = spark.createDataFrame([("2024-01-01", "a", "Mobile")] * 3, LOGS)
    path = scratch_path(spark, "state-scan")
    rows.write.parquet(path)
    df = count_state(spark.read.parquet(path))
    df.collect()
    plan = plan_text(df)
    assert "ReusedExchange" in plan


def test_increment_reads_its_days_rows_and_counts_only(spark, early_late):
    early, late = early_late
    cfg = _cfg(early)
    run_all(spark, cfg)
    cfg.input_paths = [late]
    ingest(spark, cfg)
    transform(spark, cfg, [SPLIT], include_null=False)
    processed = read_table(spark, cfg.processed_table_name)
    expected = {
        name: sorted_rows(
            (daily_report if period == "process_date" else weekly_report)(processed, key, 5)
        )
        for name, (period, key) in REPORTS.items()
    }
    # without the rows of every other day, the week's included
    days = [r[0] for r in processed.select("process_date").distinct().collect()]
    _drop_days(spark, cfg, {d for d in days if d not in (None, SPLIT)})
    assert read_table(spark, cfg.processed_table_name).filter(
        F.col("process_date").isNotNull() & (F.col("process_date") != SPLIT)
    ).isEmpty()
    report(spark, cfg, [SPLIT], include_null=False)
    assert _all_reports(spark, cfg) == expected


def test_plans_of_an_increment(spark, early_late):
    cfg = _cfg(early_late[0])
    run_all(spark, cfg)
    for name, df in state_reports(spark, cfg, ["2024-01-15"], include_null=False).items():
        files = df.inputFiles()
        assert files and all("/daily_counts/" in f for f in files), name
        plan = plan_text(df)
        assert cfg.processed_table not in plan and "PartitionFilters" in plan
    logs = read_table(spark, cfg.processed_table_name).filter(day_filter(["2024-01-15"], False))
    assert all("process_date=2024-01-15" in f for f in count_state(logs).inputFiles())


def test_incremental_state_equals_full_recount(spark, early_late):
    early, late = early_late
    cfg = _cfg(early)
    run_all(spark, cfg)
    cfg.input_paths = [late]
    run_all(spark, cfg)
    stored, reports = _state(spark, cfg), _all_reports(spark, cfg)
    assert state_drift(spark, cfg).isEmpty()
    refresh_state(spark, cfg)
    assert _state(spark, cfg) == stored
    run_all(spark, cfg)  # the same batch again changes nothing
    assert _state(spark, cfg) == stored and _all_reports(spark, cfg) == reports
    backfill(spark, cfg, ["2024-01-10", SPLIT])
    assert _state(spark, cfg) == stored and _all_reports(spark, cfg) == reports
    # and what the reports are without a state
    plain = LogConfig(**{**cfg.__dict__, "report_state": False})
    report(spark, plain)
    assert _all_reports(spark, cfg) == reports


def test_first_increment_over_tables_without_state(spark, early_late):
    early, late = early_late
    cfg = _cfg(early, report_state=False)
    run_all(spark, cfg)
    cfg.report_state, cfg.input_paths = True, [late]
    run_all(spark, cfg)  # counts the whole history once
    assert state_drift(spark, cfg).isEmpty()
    with_state = _all_reports(spark, cfg)
    cfg.report_state = False
    report(spark, cfg)
    assert _all_reports(spark, cfg) == with_state


def test_days_without_rows_lose_their_counts(spark, early_late):
    cfg = _cfg(early_late[0])
    run_all(spark, cfg)
    _drop_days(spark, cfg, {"2024-01-10"})
    assert {r["process_date"] for r in state_drift(spark, cfg).collect()} == {"2024-01-10"}
    refresh_state(spark, cfg, ["2024-01-10"], include_null=False)
    assert state_drift(spark, cfg).isEmpty()
    assert read_state(spark, cfg, "ip").filter("process_date = '2024-01-10'").isEmpty()


def test_ranges_and_windows(spark, early_late):
    cfg = _cfg(early_late[0])
    run_all(spark, cfg)
    logs = read_table(spark, cfg.processed_table_name)
    counts = {}
    for r in logs.groupBy("process_date", "ip").count().collect():
        counts[r["process_date"], r["ip"]] = r["count"]
    days = sorted({d for d, _ in counts if d})

    def top(first, last):
        sums = {}
        for (d, ip), n in counts.items():
            if d and first <= d <= last:
                sums[ip] = sums.get(ip, 0) + n
        return sorted(sums.items(), key=lambda x: (-x[1], x[0]))[:5]

    got = top_k_between(spark, cfg, "ip", "2024-01-10", "2024-01-13").orderBy("rn").collect()
    assert [(r["ip"], r["request_count"]) for r in got] == top("2024-01-10", "2024-01-13")
    assert [r["rn"] for r in got] == list(range(1, len(got) + 1))
    df = top_k_between(spark, cfg, "ip", "2024-01-10", "2024-01-11")
    assert all("process_date=2024-01-1" in f for f in df.inputFiles())
    windows = trailing_top_k(read_state(spark, cfg, "ip"), "ip", 3).collect()
    expected = []
    for d in days:
        first = (date.fromisoformat(d) - timedelta(days=2)).isoformat()
        expected += [(d, ip, n) for ip, n in top(first, d)]
    assert sorted((r["process_date"], r["ip"], r["request_count"]) for r in windows) == sorted(expected)


def test_one_day_window_is_the_daily_report(spark):
    rows = [("2024-02-28", "a", "x"), ("2024-02-28", "a", "x"), ("2024-03-01", "b", "x"), (None, "c", "x")]
    logs = spark.createDataFrame(rows, LOGS)
    counts = logs.groupBy("process_date", "ip").agg(F.count("*").alias("request_count"))
    daily = top_k_per_group(logs.filter("process_date IS NOT NULL"), "process_date", "ip")
    assert sorted_rows(trailing_top_k(counts, "ip", 1)) == sorted_rows(daily)
    with pytest.raises(ValueError):
        trailing_top_k(counts, "ip", 0)


def test_unknown_key_and_empty_input(spark):
    cfg = _cfg(_lines(spark, F.lit(False)))
    run_all(spark, cfg)
    assert _state(spark, cfg) == [] and state_drift(spark, cfg).isEmpty()
    with pytest.raises(ValueError):
        read_state(spark, cfg, "status")
    assert set(STATE_KEYS) == {"ip", "device_type"}
