"""Skew reports, layout and row estimates."""

from pyspark.sql import functions as F

from tidelog.operators.layout import apply_layout, estimate_rows, volume_partitions
from tidelog.operators.skew import key_skew, partition_counts, partition_extremes, partition_skew


def test_partition_counts_include_empty(spark):
    df = spark.range(0, 10, 1, 4).filter(F.col("id") < 3)  # rows only in partition 0/1
    counts = {r.partition_id: r["count"] for r in partition_counts(df).collect()}
    assert sorted(counts) == [0, 1, 2, 3]
    assert sum(counts.values()) == 3 and min(counts.values()) == 0


def test_partition_skew_and_extremes(spark):
    df = spark.range(0, 100, 1, 4)
    s = partition_skew(df).first()
    assert (s.n_partitions, s.max_rows, s.min_rows, s.avg_rows, s.skew_ratio) == (4, 25, 25, 25.0, 1.0)
    assert s.is_skewed is False
    ext = partition_extremes(df, 2).collect()
    assert [r.side for r in ext].count("most") == 2 and all(r.ratio_to_avg == 1.0 for r in ext)


def test_empty_input_no_error(spark):
    df = spark.createDataFrame([], "k string")
    s = key_skew(df, "k").first()
    assert s.n_keys == 0 and s.skew_ratio is None and s.is_skewed is False
    p = partition_skew(df).first()
    assert p.skew_ratio is None


def test_key_skew_flags_hot_key(spark):
    rows = [("hot",)] * 90 + [(f"k{i}",) for i in range(10)]
    s = key_skew(spark.createDataFrame(rows, "k string"), "k").first()
    assert s.n_keys == 11 and s.max_rows == 90 and s.is_skewed is True


def test_layouts_preserve_rows(spark):
    rows = [(f"d{i % 3}", f"h{i % 5}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "d string, h string, v int")
    expected = sorted(tuple(r) for r in df.collect())
    for layout in ("rebalance", "dynamic", "off"):
        out = apply_layout(df, ["d", "h"], layout, row_estimate=1000)
        assert out.columns == df.columns
        assert sorted(tuple(r) for r in out.collect()) == expected


def test_volume_partitions():
    assert volume_partitions(1_000_000) == 2
    assert volume_partitions(20_000_000) == 20
    assert volume_partitions(10**10) == 50


def test_estimate_rows_exact_at_fraction_one(spark):
    assert estimate_rows(spark.range(1234), 1.0).first().estimated_rows == 1234
    est = estimate_rows(spark.range(100000), 0.1, seed=1).first().estimated_rows
    assert 80000 < est < 120000


def test_rebalance_splits_a_hot_partition(spark):
    """One (day, hour) holds a third of the rows: the clustered write splits
    it over several tasks (files) instead of one."""
    import glob
    import os

    from tidelog.session import scratch_path
    from tidelog.sources.tables import write_partitioned_path

    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .alias("process_date"),
        F.lit("00").alias("hour"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    path = scratch_path(spark, "tests-hot")
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "1m")
    try:
        write_partitioned_path(df, path, ["process_date", "hour"])
    finally:
        spark.conf.set(conf, old)
    hot = glob.glob(os.path.join(path, "process_date=2024-01-01", "hour=00", "*.parquet"))
    cold = glob.glob(os.path.join(path, "process_date=2024-02-05", "hour=00", "*.parquet"))
    assert len(hot) > 1 and len(cold) >= 1
    back = spark.read.parquet(path)
    assert back.count() == n


def test_spread_only_small_inputs(spark):
    from tidelog.operators.layout import spread

    one = spark.range(0, 1000, 1, 1)
    spread_one = spread(one, 4)
    assert spread_one.rdd.getNumPartitions() == 4
    assert sorted(r.id for r in spread_one.collect()) == list(range(1000))
    many = spark.range(0, 1000, 1, 6)
    assert spread(many, 4) is many
