"""Footer counts, bound parameters, Bloom filters and quoted names."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001, plan_text, sorted_rows
from tidelog.config import LogConfig
from tidelog.plans.adhoc import adhoc
from tidelog.session import scratch_path
from tidelog.sources.footers import footer_counts, footer_range, table_location, table_row_counts
from tidelog.sources.tables import (
    create_database,
    create_table,
    describe_table,
    overwrite_partitions,
    quoted_name,
    read_table,
    table_exists,
)


def _db(spark):
    name = f"foot_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, scratch_path(spark, name))
    return name


def _logs(spark, n=600):
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 != 0, F.col("id") * 2).alias("size"),
        F.concat(F.lit("10.0.0."), F.col("id") % 5).alias("ip"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("0"), (F.col("id") % 4))).alias("day"),
        F.concat(F.lit("h"), F.col("id") % 2).alias("hour"),
    )


# ------------------------------------------------------------ footers


def test_counts_per_partition_equal_the_rows(spark):
    name = f"{_db(spark)}.logs"
    logs = _logs(spark)
    create_table(logs, name, ["day", "hour"])
    for by in ([], ["day"], ["hour"], ["day", "hour"], ["hour", "day"]):
        got = table_row_counts(spark, name, by)
        assert got.columns == [*by, "rows"]
        assert sorted_rows(got) == sorted_rows(logs.groupBy(*by).agg(F.count("*").alias("rows")))
    # values like 01 stay text
    assert {r["day"] for r in table_row_counts(spark, name, ["day"]).collect()} >= {"01", None}


def test_counts_read_footers_only(spark):
    path = scratch_path(spark, "footers")
    _logs(spark).write.partitionBy("day").parquet(path)
    df = footer_counts(spark, path, ["day"], where=F.col("day") > "01")
    plan = plan_text(df)
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [day]" in plan
    assert "PartitionFilters: [isnotnull(day" in plan
    expected = _logs(spark).filter(F.col("day") > "01").groupBy("day").count()
    assert sorted_rows(df) == sorted_rows(expected)
    # with every data page overwritten the counts are still there
    for folder, _, files in os.walk(path.removeprefix("file:")):
        for f in files:
            if f.endswith(".parquet"):
                os.remove(f"{folder}/.{f}.crc")
                with open(f"{folder}/{f}", "r+b") as out:
                    out.seek(4)
                    out.write(b"\0" * 64)
    assert sorted_rows(footer_counts(spark, path, ["day"])) == sorted_rows(
        _logs(spark).groupBy("day").count()
    )


def test_what_footers_cannot_answer_raises(spark):
    path = scratch_path(spark, "footers")
    _logs(spark).write.partitionBy("day").parquet(path)
    with pytest.raises(ValueError, match="not partition columns"):
        footer_counts(spark, path, ["ip"])
    with pytest.raises(ValueError, match="footers"):
        footer_counts(spark, path, where=F.col("size") > 5)
    with pytest.raises(ValueError, match="footers"):
        footer_range(spark, path, "ip")


def test_ranges(spark):
    path = scratch_path(spark, "footers")
    _logs(spark).write.parquet(path)
    assert tuple(footer_range(spark, path, "size").first()) == (600, 400, 2, 1198)
    empty = scratch_path(spark, "footers")
    _logs(spark).limit(0).write.parquet(empty)
    assert tuple(footer_range(spark, empty, "size").first()) == (0, 0, None, None)
    assert footer_counts(spark, empty).first()["rows"] == 0


def test_the_callers_session_stays_as_it_is(spark):
    keys = ("spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown")
    before = [spark.conf.get(k) for k in keys]
    footer_range(spark, f"{SF001}/orders.parquet", "o_orderkey").collect()
    assert [spark.conf.get(k) for k in keys] == before


def test_counts_follow_an_overwrite(spark):
    name = f"{_db(spark)}.logs"
    create_table(_logs(spark), name, ["day"])
    overwrite_partitions(_logs(spark).filter("day = '01' AND size > 100"), name, ["day"])
    spark.catalog.refreshTable(name)
    assert sorted_rows(table_row_counts(spark, name, ["day"])) == sorted_rows(
        read_table(spark, name).groupBy("day").agg(F.count("*").alias("rows"))
    )


# ------------------------------------------------------------ parameter markers


def test_named_and_positional_values(spark):
    views = {"logs": _logs(spark)}
    named = adhoc(
        spark, "SELECT event_id FROM logs WHERE ip = :ip AND size >= :least", views,
        args={"ip": "10.0.0.2", "least": 100},
    )
    placed = adhoc(
        spark, "SELECT event_id FROM logs WHERE ip = ? AND size >= ?", views, args=["10.0.0.2", 100]
    )
    expected = _logs(spark).filter("ip = '10.0.0.2' AND size >= 100").select("event_id")
    assert sorted_rows(named) == sorted_rows(placed) == sorted_rows(expected)


@pytest.mark.parametrize("value", ["it's", "' OR '1'='1", "a\\'b", "x; DROP TABLE t", "`q`", ":ip", "?", ""])
def test_values_are_never_sql(spark, value):
    df = spark.createDataFrame([(value, 1), ("other", 2)], "name string, n int")
    for args, marker in (({"v": value}, ":v"), ([value], "?")):
        got = adhoc(spark, f"SELECT n, {marker} AS v FROM t WHERE name = {marker}", {"t": df},
                    args=args if isinstance(args, dict) else args * 2).collect()
        assert [tuple(r) for r in got] == [(1, value)]


def test_typed_values_and_null(spark):
    import datetime

    day = datetime.date(2024, 1, 2)
    row = adhoc(spark, "SELECT :d AS d, :n AS n, :x AS x, array_contains(:l, 3) AS has",
                args={"d": day, "n": None, "x": 1.5, "l": F.array(F.lit(1), F.lit(3))}).first()
    assert tuple(row) == (day, None, 1.5, True)


def test_missing_values_and_text_as_args_raise(spark):
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        adhoc(spark, "SELECT :a AS a", args={"b": 1}).collect()
    with pytest.raises(TypeError):
        adhoc(spark, "SELECT ?", args="abc")


def test_bound_values_still_prune_partitions(spark):
    name = f"{_db(spark)}.logs"
    create_table(_logs(spark), name, ["day", "hour"])
    df = adhoc(spark, f"SELECT event_id FROM {name} WHERE day = :day", args={"day": "02"})
    assert df.inputFiles() and "PartitionFilters: [isnotnull(day" in plan_text(df)
    assert "day#" in plan_text(df) and "= 02" in plan_text(df)


# ------------------------------------------------------------ Bloom filters


def _scanned_rows(df) -> int:
    """Rows that the file scan passed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    while leaves.head().getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        leaves = leaves.head().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_look_ups_skip_row_groups_by_bloom_filter(spark):
    db = _db(spark)
    # addresses of many values, each file's range holds the looked-up ones
    n = 150_000
    logs = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("10."), F.substring(F.md5(F.col("id").cast("string")), 1, 20)).alias("ip"),
        F.lit("d").alias("day"),
    )
    present = logs.filter("event_id = 77").first()["ip"]
    absent = "10.7fffffffffffffffffff"
    scanned = {}
    for columns in ((), ("ip",)):
        cfg = LogConfig(database=db, bloom_columns=columns, bloom_values=n)
        name = f"{db}.logs{len(columns)}"
        create_table(logs.coalesce(1), name, ["day"], options=cfg.log_table_options)
        table = read_table(spark, name)
        assert table.filter(F.col("ip") == present).select("event_id").collect() == [(77,)]
        scanned[len(columns)] = _scanned_rows(table.filter(F.col("ip") == absent))
    assert scanned[0] > 0 and scanned[1] == 0
    # the option is a table property: later inserts write filters too
    name = f"{db}.logs1"
    overwrite_partitions(logs.withColumn("day", F.lit("e")).coalesce(1), name, ["day"])
    spark.catalog.refreshTable(name)
    assert _scanned_rows(read_table(spark, name).filter((F.col("ip") == absent) & (F.col("day") == "e"))) == 0


def test_options_of_log_tables():
    assert LogConfig().log_table_options == {"compression": "zstd"}
    options = LogConfig(bloom_columns=("ip", "endpoint"), bloom_values=5).log_table_options
    assert options["parquet.bloom.filter.enabled#ip"] == "true"
    assert options["parquet.bloom.filter.expected.ndv#endpoint"] == "5"


# ------------------------------------------------------------ quoting


def test_names_and_locations_are_quoted(spark, tmp_path):
    db = f"quoted_{uuid.uuid4().hex[:6]}"
    location = f"{tmp_path}/it's here"
    create_database(spark, db, location)
    assert spark.catalog.databaseExists(db)
    plain = _db(spark)
    name = f"`{plain}`.`odd_name`"
    create_table(_logs(spark), name, ["day"])
    assert table_exists(spark, name) and table_exists(spark, f"{plain}.odd_name")
    assert not table_exists(spark, f"{plain}.other")
    assert describe_table(spark, f"{plain}.odd_name").filter("col_name = 'ip'").count() == 1
    assert table_location(spark, name).endswith("odd_name")
    assert quoted_name("a.`b.c`.d") == "`a`.`b.c`.`d`"
