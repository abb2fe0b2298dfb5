"""Direct placement and frequent-key summaries."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_text, sorted_rows
from tidelog.operators.hitters import (
    error_share,
    frequent_keys,
    heavy_hitters,
    key_sketch,
    merge_sketches,
    tracked_for,
)
from tidelog.operators.placement import place, place_balanced, placement_counts
from tidelog.operators.skew import partition_counts, partition_skew
from tidelog.session import scratch_path


def _zipf(n, seed=1):
    rng = random.Random(seed)
    return [None if i % 50 == 0 else f"k{int(rng.paretovariate(0.6)) % 5000}" for i in range(n)]


def _frame(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string").repartition(6)


# ------------------------------------------------------------ placement


@pytest.mark.parametrize("n", [1, 5, 16])
def test_rows_are_where_they_were_sent(spark, n):
    df = spark.range(200).withColumn("p", (F.col("id") - 50).cast("int"))
    df = df.withColumn("p", F.when(F.col("id") % 7 != 0, F.col("p")))
    placed = place(df, n, "p")
    got = placed.select("p", F.spark_partition_id().alias("at")).collect()
    assert all(r["at"] == (0 if r["p"] is None else r["p"] % n) for r in got)
    assert sorted_rows(partition_counts(placed)) == sorted_rows(placement_counts(df, n, "p"))
    assert placement_counts(df, n, "p").count() == n


def test_placement_is_one_shuffle_and_counts_move_no_rows(spark):
    df = spark.range(100).withColumn("p", F.col("id").cast("int"))
    assert plan_text(place(df, 4, "p")).count("Exchange") == 1
    assert "shufflepartitionidpassthrough" in plan_text(place(df, 4, "p"))
    assert "passthrough" not in plan_text(placement_counts(df, 4, "p"))


def test_placement_keeps_rows_and_refuses_no_partitions(spark):
    df = spark.range(50).withColumn("p", (F.col("id") * 7).cast("bigint"))
    assert sorted_rows(place(df, 3, "p")) == sorted_rows(df)
    assert place(df.limit(0), 3, "p").count() == 0
    with pytest.raises(ValueError):
        place(df, 0, "p")


def test_balanced_placement_splits_hot_keys_only(spark):
    # a third of the rows are one row repeated
    rows = [(1, "hot")] * 1000 + [(i, f"k{i % 400}") for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, key string")
    placed = place_balanced(df, "key", 8)
    assert placed.columns == df.columns and sorted_rows(placed) == sorted_rows(df)
    stats = partition_skew(placed).first()
    assert stats["n_partitions"] == 8 and stats["skew_ratio"] < 2
    homes = placed.select("key", F.spark_partition_id().alias("p")).distinct().groupBy("key").count()
    spread = {r["key"]: r["count"] for r in homes.collect()}
    assert spread.pop("hot") > 1 and set(spread.values()) == {1}
    # hashing alone puts the hot key in one partition
    assert partition_skew(df.repartition(8, "key")).first()["skew_ratio"] > 2


def test_balanced_placement_of_null_and_single_keys(spark):
    df = spark.createDataFrame([(i, None) for i in range(80)], "id int, key string")
    assert partition_skew(place_balanced(df, "key", 4)).first()["max_rows"] == 20
    assert place_balanced(df.limit(0), "key", 4).count() == 0


# ------------------------------------------------------------ frequent keys


def test_bounds_hold_with_few_counters(spark):
    keys = _zipf(20_000)
    true, tracked = Counter(k for k in keys if k is not None), 96
    df = _frame(spark, keys)
    found = frequent_keys(key_sketch(df, "key", tracked=tracked), tracked=tracked).collect()
    named = {r["key"]: r for r in found if r["key"] is not None}
    assert len(named) < len(true)
    error = error_share(tracked) * len(keys)
    for key, r in named.items():
        assert r["at_least"] <= true[key] <= r["at_most"] <= true[key] + error
        assert r["rows"] == len(keys)
    assert {k for k, n in true.items() if n > 2 * error} <= set(named)
    nulls = [r for r in found if r["key"] is None]
    assert [(r["at_least"], r["at_most"]) for r in nulls] == [(400, 400)]


def test_merged_sketches_are_stored_and_keep_their_bounds(spark):
    keys = _zipf(12_000, seed=2)
    df = _frame(spark, keys).withColumn("day", F.col("id") % 5)
    path = scratch_path(spark, "sketches")
    key_sketch(df, "key", "day").write.parquet(path)
    merged = merge_sketches(spark.read.parquet(path))
    found = {r["key"]: r for r in frequent_keys(merged).collect()}
    true = Counter(keys)
    error = error_share() * len(keys)
    for key, r in found.items():
        assert r["at_least"] <= true[key] <= r["at_most"] <= true[key] + error
    assert {k for k, n in true.items() if n > 2 * error} <= set(found)
    by_day = frequent_keys(spark.read.parquet(path), by="day")
    assert {r["day"] for r in by_day.collect()} == {0, 1, 2, 3, 4}


@pytest.mark.parametrize("share", [0.3, 0.05, 0.01, 0.002])
def test_heavy_hitters_are_exact(spark, share):
    keys = _zipf(9000, seed=3)
    got = {r["key"]: r["rows"] for r in heavy_hitters(_frame(spark, keys), "key", share).collect()}
    assert got == {k: n for k, n in Counter(keys).items() if n > share * len(keys)}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=60), st.sampled_from([0.05, 0.2, 0.5]))
def test_heavy_hitters_of_any_small_table(spark, keys, share):
    df = spark.createDataFrame([(k,) for k in keys], "key bigint")
    got = {r["key"]: r["rows"] for r in heavy_hitters(df, "key", share).collect()}
    assert got == {k: n for k, n in Counter(keys).items() if n / len(keys) > share}


def test_only_sketches_and_candidates_are_shuffled(spark):
    """Every distinct key stays in its task: one sketch each leaves it."""
    df = spark.range(0, 50_000, 1, 4).select((F.col("id") % 25_000).cast("string").alias("key"))
    out = heavy_hitters(df, "key", 0.1)
    assert out.collect() == []
    plan = plan_text(out)
    assert "BroadcastHashJoin" in plan and "approx_top_k_accumulate" in plan
    assert "SortMergeJoin" not in plan


def test_counters_for_a_share():
    for share in (0.5, 0.1, 0.01, 0.001):
        assert 2 * error_share(tracked_for(share)) <= share
    for share in (0, 1, -1):
        with pytest.raises(ValueError):
            tracked_for(share)
