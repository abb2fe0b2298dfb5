"""Device class, time buckets and year-week labels."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog.functions.device import device_type, register_device_function
from tidelog.functions.periods import week_bucket, year_week, year_week_of_day

AGENTS = [
    ("Mozilla/5.0 (iPhone) Mobile/15E148", "Mobile"),
    ("Mozilla/5.0 (X11; Linux x86_64)", "Desktop"),
    ("Mozilla/5.0 (Linux; Android 13; SM-X700)", "Tablet"),
    ("Mozilla/5.0 (iPad; CPU OS 12_0)", "Tablet"),
    ("Mozilla/5.0 (Windows Phone 8.0)", "Mobile"),
    ("", "Desktop"),
    (None, "Unknown"),
    ("Mozilla/5.0 (iPad; CPU OS 12_0) Mobile/15E148", "Mobile"),  # mobile wins
    ("Some TABLET browser", "Tablet"),
    ("Android 4; Mobile", "Mobile"),
]


def test_device_arms(spark):
    df = spark.createDataFrame(AGENTS, "ua string, expected string")
    got = df.select("expected", device_type("ua").alias("d")).collect()
    assert all(r.expected == r.d for r in got)


def test_device_sql_function_matches_column(spark):
    name = register_device_function(spark)
    df = spark.createDataFrame(AGENTS, "ua string, expected string")
    df.createOrReplaceTempView("agents_t")
    got = spark.sql(f"SELECT expected, {name}(ua) AS d FROM agents_t").collect()
    assert all(r.expected == r.d for r in got)
    plan = spark.sql(f"SELECT {name}(ua) FROM agents_t")._jdf.queryExecution().executedPlan()
    assert "BatchEvalPython" not in plan.toString()


@pytest.mark.parametrize(
    "day, calendar, iso, week",
    [
        ("2024-12-30", "2024-01", "2025-01", 1),
        ("2021-01-01", "2021-53", "2020-53", 53),
        ("2024-01-01", "2024-01", "2024-01", 1),
        ("2024-06-15", "2024-24", "2024-24", 24),
    ],
)
def test_year_week(spark, day, calendar, iso, week):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(day), day)], "ts timestamp, d string")
    r = df.select(
        year_week("ts", "calendar").alias("c"),
        year_week("ts", "iso").alias("i"),
        week_bucket("ts").alias("w"),
        year_week_of_day("d", "calendar").alias("dc"),
        year_week_of_day("d", "iso").alias("di"),
    ).first()
    assert (r.c, r.i, r.w) == (calendar, iso, week)
    assert (r.dc, r.di) == (calendar, iso)


def test_year_week_null(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp")
    assert df.select(year_week("ts").alias("y")).first().y is None


def test_year_week_of_malformed_day_is_null(spark):
    df = spark.createDataFrame([("2024-13-45",), ("garbage",), (None,)], "d string")
    assert [r.y for r in df.select(year_week_of_day("d").alias("y")).collect()] == [None] * 3


def test_year_week_bad_mode(spark):
    with pytest.raises(ValueError):
        year_week(F.col("ts"), "fiscal")
