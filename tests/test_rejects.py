"""Accepted and rejected lines from one pass."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text, sorted_rows
from tidelog.config import LogConfig
from tidelog.plans.jobs import ingest, run_all
from tidelog.plans.rejects import (
    REQUIRED,
    ingest_split,
    read_accepted,
    read_rejected,
    split_lines,
)
from tidelog.plans.reports import read_reports
from tidelog.session import configure_session, scratch_path
from tidelog.sources.tables import read_table

GOOD = '10.0.0.{i} - - [{d:02d}/Jan/2024:{h:02d}:10:00 +0000] "GET /x HTTP/1.1" 200 {i} "-" "Mobile"'
BAD = {
    "": list(REQUIRED),
    "corrupt": list(REQUIRED),
    '10.0.0.1 - - [99/Jan/2024:00:00:00 +0000] "GET /x HTTP/1.1" 200 5 "-" "a"': ["timestamp"],
    '10.0.0.1 - - [01/Jan/2024:00:00:00 +0000] "GET /x HTTP/1.1" - 5 "-" "a"': ["status"],
    '10.0.0.1 - - [01/Jan/2024:00:00:00 +0000] "-" 400 5 "-" "it\'s"': ["protocol"],
}


def _good(days, n=12):
    return [GOOD.format(i=i % 5, d=d, h=i % 3) for d in days for i in range(n)]


def _write(spark, lines):
    path = scratch_path(spark, "reject-lines")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    return path


@pytest.fixture(autouse=True)
def utc(spark):
    configure_session(spark, "UTC")


def test_reasons_name_every_failed_field(spark):
    df = split_lines(spark.createDataFrame([(x,) for x in [*BAD, *_good([1])]], "value string"), "b")
    got = {r["line"]: r["reasons"] for r in df.filter("kind = 'rejected'").collect()}
    assert got == BAD
    accepted = df.filter("kind = 'parsed'").collect()
    assert len(accepted) == 12 and all(r["line"] is None and r["reasons"] is None for r in accepted)


def test_accepted_and_rejected_make_all_lines(spark):
    lines = _good([1, 2]) + list(BAD) * 7
    cfg = LogConfig(input_paths=[_write(spark, lines)])
    root = scratch_path(spark, "split")
    res = ingest_split(spark, cfg, root, "b1")
    assert (res.rows, res.malformed) == (24, 35) and res.rows + res.malformed == len(lines)
    assert res.days == ["2024-01-01", "2024-01-02"] and len(res.hours) == 6
    assert res.rejected == {f: 7 * sum(f in r for r in BAD.values()) for f in REQUIRED}
    rejected = read_rejected(spark, cfg, root)
    assert sorted(r["line"] for r in rejected.collect()) == sorted(list(BAD) * 7)
    assert {r["batch"] for r in rejected.collect()} == {"b1"}
    accepted = read_accepted(spark, cfg, root)
    assert accepted.count() == 24 and "line" not in accepted.columns
    assert "PartitionFilters: [isnotnull(kind" in plan_text(accepted)


def test_the_text_is_scanned_once(spark):
    lines = spark.read.text(_write(spark, _good([1]) + list(BAD)))
    plan = plan_text(split_lines(lines, "b").hint("rebalance", "kind"))
    assert plan.count("FileScan text") == 1 and "InMemory" not in plan.replace("InMemoryFileIndex", "")


def test_batches_keep_their_rejects_and_replace_their_own(spark):
    root = scratch_path(spark, "split")
    first = LogConfig(input_paths=[_write(spark, _good([1]) + list(BAD))])
    second = LogConfig(input_paths=[_write(spark, _good([2]) + ["corrupt"] * 3)])
    for _ in range(2):  # a second run of both changes nothing
        ingest_split(spark, first, root, "b1")
        ingest_split(spark, second, root, "b2")
        by_batch = {r["batch"]: r["count"] for r in read_rejected(spark, first, root).groupBy("batch").count().collect()}
        assert by_batch == {"b1": len(BAD), "b2": 3}
        assert read_accepted(spark, first, root).count() == 24
    repaired = LogConfig(input_paths=[_write(spark, _good([2]))])
    assert ingest_split(spark, repaired, root, "b2").malformed == 0
    assert {r["batch"] for r in read_rejected(spark, first, root).collect()} == {"b1"}


def test_jobs_run_on_the_accepted_rows(spark):
    path = _write(spark, _good([1, 2, 3], 4) + list(BAD))
    db = f"split_{uuid.uuid4().hex[:8]}"
    cfg = LogConfig(input_paths=[path], database=db, split_root=scratch_path(spark, "split"), batch="b1")
    out = run_all(spark, cfg)
    assert out["ingest"].rows == 12 and out["ingest"].malformed == len(BAD)
    plain = LogConfig(input_paths=[path], database=f"{db}_p", drop_malformed=True)
    run_all(spark, plain)
    # one line has a time but no status: dropped with a side, kept without
    kept = read_table(spark, plain.raw_table_name).filter("status IS NOT NULL AND protocol != ''")
    raw = read_table(spark, cfg.raw_table_name)
    assert sorted_rows(raw.select(kept.columns)) == sorted_rows(kept)
    # a second batch of another day, incrementally
    cfg.input_paths, cfg.batch = [_write(spark, _good([4], 4))], "b2"
    run_all(spark, cfg)
    daily = read_reports(spark, cfg)["daily_top_ips"]
    assert {r["process_date"] for r in daily.collect()} == {f"2024-01-0{d}" for d in range(1, 5)}
    assert daily.agg(F.sum("request_count")).first()[0] == 16


def test_edge_cases(spark):
    root = scratch_path(spark, "split")
    cfg = LogConfig(input_paths=[_write(spark, ["corrupt"])], database=f"e_{uuid.uuid4().hex[:8]}")
    res = ingest_split(spark, cfg, root, "only-rejects")
    assert (res.rows, res.malformed, res.days, res.hours) == (0, 1, [], [])
    assert read_accepted(spark, cfg, root).count() == 0
    cfg.split_root, cfg.batch = root, "again"
    assert ingest(spark, cfg).rows == 0 and read_table(spark, cfg.raw_table_name).count() == 0
    for batch in ("", "a/b", "a b"):
        with pytest.raises(ValueError):
            ingest_split(spark, cfg, root, batch)
    with pytest.raises(ValueError):
        split_lines(spark.createDataFrame([], "value string"), "b", required=("status",))
