"""Log-line parsing: the eight extractors, modes and edge rows."""

from datetime import datetime

import pytest
from pyspark.sql import Row

from tidelog.functions.parse import parse_logs

T = "[01/Jan/2024:05:36:29 +0530]"
GOOD = f'10.0.0.8 - - {T} "GET /view?k=29 HTTP/1.1" 200 163 "-" "Mozilla/5.0 (iPhone) Mobile/15E148"'


def _parse(spark, lines, **opts):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "id int, value string")
    return [r.asDict() for r in parse_logs(df, keep=("id",), **opts).orderBy("id").collect()]


def test_good_line_all_fields(spark):
    (r,) = _parse(spark, [GOOD])
    assert r["ip"] == "10.0.0.8"
    assert r["timestamp_str"] == "01/Jan/2024:05:36:29 +0530"
    assert (r["method"], r["endpoint"], r["protocol"]) == ("GET", "/view?k=29", "HTTP/1.1")
    assert (r["status"], r["bytes"]) == (200, 163)
    assert r["user_agent"] == "Mozilla/5.0 (iPhone) Mobile/15E148"
    # +0530 is honoured; buckets are UTC
    assert r["timestamp"] == datetime(2024, 1, 1, 0, 6, 29)
    assert (r["process_date"], r["hour"]) == ("2024-01-01", "00")


def test_first_int_mode_reads_status(spark):
    (r,) = _parse(spark, [GOOD], bytes_mode="first_int")
    assert r["bytes"] == 200


def test_malformed_line(spark):
    (r,) = _parse(spark, ["corrupt line 194"])
    assert r["ip"] == "corrupt"
    assert all(r[c] == "" for c in ("timestamp_str", "method", "endpoint", "protocol", "user_agent"))
    assert all(r[c] is None for c in ("status", "bytes", "timestamp", "process_date", "hour"))


def test_drop_malformed(spark):
    rows = _parse(spark, [GOOD, "corrupt line 194"], drop_malformed=True)
    assert [r["id"] for r in rows] == [0]


def test_missing_size(spark):
    line = f'1.2.3.4 - - {T} "GET /a HTTP/1.1" 304 - "-" "X"'
    (r,) = _parse(spark, [line])
    assert r["status"] == 304 and r["bytes"] is None
    (c,) = _parse(spark, [line], bytes_mode="first_int")
    assert c["bytes"] == 304


def test_no_protocol_default_and_strict(spark):
    line = f'1.2.3.4 - - {T} "GET /a" 200 12 "-" "X"'
    (r,) = _parse(spark, [line])
    # independent patterns: the endpoint keeps the closing quote and the
    # protocol finds no third token before a quote
    assert r["endpoint"] == '/a"' and r["protocol"] == ""
    assert r["status"] == 200 and r["bytes"] == 12
    (s,) = _parse(spark, [line], strict=True)
    assert s["ip"] == "" and s["status"] is None and s["timestamp"] is None


def test_numeric_user(spark):
    line = f'1.2.3.4 - 123 {T} "GET /a HTTP/1.1" 200 12 "-" "X"'
    (r,) = _parse(spark, [line])
    assert r["status"] == 123  # the first three-digit token wins
    (s,) = _parse(spark, [line], strict=True)
    assert (s["status"], s["bytes"], s["endpoint"], s["user_agent"]) == (200, 12, "/a", "X")


def test_text_after_agent(spark):
    (r,) = _parse(spark, [f'1.2.3.4 - - {T} "GET /a HTTP/1.1" 200 12 "-" "X" extra'])
    assert r["user_agent"] == ""


def test_oversize_bytes(spark):
    line = f'1.2.3.4 - - {T} "GET /a HTTP/1.1" 200 3000000000 "-" "X"'
    (r,) = _parse(spark, [line])
    assert r["bytes"] is None
    (b,) = _parse(spark, [line], bytes_type="bigint")
    assert b["bytes"] == 3_000_000_000


def test_strict_common_log_format(spark):
    (s,) = _parse(spark, [f'1.2.3.4 - frank {T} "GET /a HTTP/1.0" 200 2326'], strict=True)
    assert (s["ip"], s["status"], s["bytes"], s["user_agent"]) == ("1.2.3.4", 200, 2326, "")


def test_bad_mode_raises(spark):
    with pytest.raises(ValueError):
        _parse(spark, [GOOD], bytes_mode="last")


def test_null_line(spark):
    df = spark.createDataFrame([Row(id=0, value=None)], "id int, value string")
    (r,) = parse_logs(df, keep=("id",)).collect()
    assert r["ip"] is None and r["timestamp"] is None


def test_no_python_in_plan(spark):
    from tests.conftest import plan_text

    df = spark.createDataFrame([(GOOD,)], "value string")
    plan = plan_text(parse_logs(df))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
