"""Incremental ingest: only new files are parsed; re-runs add nothing."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from tidelog.config import LogConfig
from tidelog.functions.parse import parse_logs
from tidelog.session import scratch_path
from tidelog.sources.event_logs import lines_from_events, read_events
from tidelog.streaming.ingest import read_ingested, run_ingest_stream


def test_incremental_runs(spark):
    root = scratch_path(spark, "tests-stream")
    inbox, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    lines = lines_from_events(read_events(spark, SF001), keep_id=False)
    first = lines.filter(F.col("value") < "10.0.0.5")
    second = lines.filter(F.col("value") >= "10.0.0.5")
    first.write.mode("append").text(inbox)
    cfg = LogConfig(input_paths=[inbox])
    run_ingest_stream(spark, cfg, out, ckpt)
    assert read_ingested(spark, out).count() == first.count()
    second.write.mode("append").text(inbox)
    run_ingest_stream(spark, cfg, out, ckpt)
    run_ingest_stream(spark, cfg, out, ckpt)  # nothing new
    got = read_ingested(spark, out)
    assert got.count() == lines.count()
    expected = parse_logs(lines)
    assert got.exceptAll(expected.select(*got.columns)).count() == 0
    assert dict(got.dtypes)["process_date"] == "string"


def test_continuous_trigger(spark):
    from tidelog.streaming.ingest import start_ingest_stream

    root = scratch_path(spark, "tests-stream-cont")
    inbox, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    lines = lines_from_events(read_events(spark, SF001), keep_id=False)
    lines.write.text(inbox)
    cfg = LogConfig(input_paths=[inbox])
    query = start_ingest_stream(
        spark, cfg, out, ckpt, max_files_per_trigger=1, processing_time="1 second"
    )
    try:
        query.processAllAvailable()
        assert read_ingested(spark, out).count() == lines.count()
    finally:
        query.stop()
