"""Counting, top-k per period and the distributed full ranking."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import plan_text, sorted_rows
from tidelog.operators.topk import (
    count_by,
    rank_per_group,
    sort_report,
    top_k_of_counts,
    top_k_per_group,
)


_rows = sorted_rows


def test_tie_at_rank_five_keeps_first_keys(spark):
    rows = [("d1", f"k{i}") for i in range(6) for _ in range(2)]
    df = spark.createDataFrame(rows, "p string, k string")
    out = _rows(top_k_per_group(df, "p", "k", 5))
    assert out == [("d1", f"k{i}", 2) for i in range(5)]


def test_k1_subset_of_k5_and_null_group(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]), f"k{rng.randint(0, 30)}") for _ in range(3000)]
    df = spark.createDataFrame(rows, "p string, k string")
    top1, top5 = set(_rows(top_k_per_group(df, "p", "k", 1))), set(
        _rows(top_k_per_group(df, "p", "k", 5))
    )
    assert top1 <= top5
    assert len(top1) == 3 and len(top5) == 15
    assert any(r[0] is None for r in top1)


def test_counts_sum_to_rows(spark):
    rng = random.Random(3)
    rows = [(f"d{rng.randint(0, 9)}", f"ip{rng.randint(0, 99)}") for _ in range(5000)]
    df = spark.createDataFrame(rows, "p string, k string")
    total = count_by(df, "p", "k").agg(F.sum("request_count")).first()[0]
    assert total == 5000


def test_window_group_limit_in_plan(spark):
    df = spark.createDataFrame([("d", "k")], "p string, k string")
    plan = plan_text(top_k_per_group(df, "p", "k", 5))
    # the partial limit runs before the shuffle on the period: a hot period
    # receives at most k rows per upstream task
    exchange = plan.index("Exchange hashpartitioning(p#")
    partial = plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning(p#"))
    assert "Partial" in plan[partial : plan.index("\n", partial)]
    assert partial > exchange  # printed below it, i.e. executed before it


def test_large_k_uses_distributed_rank(spark):
    rows = [("d", f"k{i:04d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "p string, k string")
    out = top_k_per_group(df, "p", "k", 1200)
    assert out.count() == 1200
    assert "WindowGroupLimit" not in plan_text(out)


def test_rank_per_group_matches_row_number(spark):
    rng = random.Random(11)
    # one hot group holding most rows, several small ones and a NULL group
    rows = []
    for _ in range(20000):
        g = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        rows.append((g, f"k{rng.randint(0, 800)}"))
    df = spark.createDataFrame(rows, "g string, k string")
    counts = count_by(df, "g", "k")
    # many partitions so the hot group is split over several tasks
    ranked = rank_per_group(counts, "g", "k", num_partitions=16)
    w = Window.partitionBy("g").orderBy(F.desc("request_count"), F.asc_nulls_first("k"))
    expected = counts.withColumn("rn", F.row_number().over(w))
    assert _rows(ranked) == _rows(expected)


def test_rank_per_group_multi_column(spark):
    rows = [(d % 3, d % 2, f"k{d % 17}") for d in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, k string")
    counts = count_by(df, ["a", "b"], "k")
    ranked = rank_per_group(counts, ["a", "b"], "k", num_partitions=5)
    w = Window.partitionBy("a", "b").orderBy(F.desc("request_count"), F.asc_nulls_first("k"))
    assert _rows(ranked) == _rows(counts.withColumn("rn", F.row_number().over(w)))


def test_top_k_of_counts_with_rank(spark):
    df = spark.createDataFrame([("d", "x", 3), ("d", "y", 5)], "p string, k string, request_count long")
    out = top_k_of_counts(df, "p", "k", 1, with_rank=True).collect()
    assert [(r.k, r.rn) for r in out] == [("y", 1)]


def test_sort_report_order(spark):
    df = spark.createDataFrame(
        [("d2", "a", 1), ("d1", "b", 2), ("d1", "a", 2), (None, "z", 9)],
        "p string, k string, request_count long",
    )
    got = [tuple(r) for r in sort_report(df, "p", "k").collect()]
    assert got == [(None, "z", 9), ("d1", "a", 2), ("d1", "b", 2), ("d2", "a", 1)]


def test_empty_input(spark):
    df = spark.createDataFrame([], "p string, k string")
    assert top_k_per_group(df, "p", "k", 5).count() == 0
    assert rank_per_group(count_by(df, "p", "k"), "p", "k").count() == 0
