"""Metrics records, JSON sink, summaries; JSON / CSV rendering; previews."""

import json

from pyspark.sql import functions as F

from tidelog.operators.metrics import (
    MetricsRecorder,
    metrics_by_type,
    metrics_totals,
    read_metrics_json,
    write_metrics_json,
)
from tidelog.operators.render import preview, rows_as_csv, rows_as_json
from tidelog.plans.adhoc import adhoc
from tidelog.session import scratch_path


def test_recorder_json_roundtrip_and_summaries(spark):
    rec = MetricsRecorder()
    for i in range(3):
        with rec.timed(f"step{i}", "job" if i else "query", rows=i):
            pass
    path = scratch_path(spark, "tests-metrics")
    write_metrics_json(rec.to_df(spark), path)
    write_metrics_json(rec.to_df(spark), path)  # append
    back = read_metrics_json(spark, path)
    assert back.count() == 6
    tot = metrics_totals(back).first()
    assert tot.total_operations == 6
    by = {r.type: r["count"] for r in metrics_by_type(back).collect()}
    assert by == {"job": 4, "query": 2}
    details = back.filter(F.col("name") == "step2").first().details
    assert details == {"rows": "2"}


def test_empty_metrics(spark):
    empty = MetricsRecorder().to_df(spark)
    tot = metrics_totals(empty).first()
    assert tot.total_operations == 0 and tot.avg_duration_ms is None
    assert metrics_by_type(empty).count() == 0


def test_rendering(spark):
    df = spark.createDataFrame([(1, "a,b", None)], "id int, s string, n double")
    j = json.loads(rows_as_json(df).first().json)
    assert j == {"id": 1, "s": "a,b"}
    assert rows_as_csv(df).first().csv == '1,"a,b",'


def test_preview_is_ordered_and_bounded(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 7) % 1000)
    got = [r.k for r in preview(df, 5, order_by=["k"]).collect()]
    assert got == [0, 1, 2, 3, 4]


def test_adhoc_sql_is_lazy_and_raises(spark):
    df = adhoc(spark, "SELECT x * 2 AS y FROM v", views={"v": spark.range(3).toDF("x")})
    assert sorted(r.y for r in df.collect()) == [0, 2, 4]
    assert adhoc(spark, "SELECT * FROM v", limit=2).count() == 2
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        adhoc(spark, "SELECT nope FROM v")
