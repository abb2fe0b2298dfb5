"""What the steps of the n-gram Jaccard join leave on disk."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from tests.llm import brute
from tidelog.llm import jaccard_join
from tidelog.llm.common import prepare, written


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {p for d in manager.localDirs() for p in Path(d.getPath()).rglob("shuffle_*.data")}


def left_by(spark, step):
    """Shuffle files that ``step`` leaves; they are deleted in the background."""
    before = shuffle_files(spark)
    step()
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_written_tables_leave_no_shuffle_files(spark):
    rows = spark.range(20_000).groupBy(F.xxhash64("id").alias("h")).agg(F.max("id").alias("id"))
    assert left_by(spark, lambda: written(rows, "rows")) == set()
    assert written(rows, "rows-again")[0].count() == rows.count() == 20_000


def test_bit_maps_leave_no_shuffle_files(spark):
    prepare(spark)
    values = spark.range(20_000).select(F.col("id").alias("x"))
    assert left_by(spark, lambda: jaccard_join.bit_map(values, 16)) == set()


def test_sweeping_keeps_the_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    written(spark.range(3).distinct(), "few")
    assert spark.conf.get(key, "false") == before


def test_sets_are_dealt_without_being_written(spark, monkeypatch):
    """Repeated rows and a doc_id with several texts meet their pairs once."""
    prepare(spark)
    labels, inner = [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, label: labels.append(label) or inner(df, label))
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    rows = [(0, " ".join(base)), (0, " ".join(base)), (None, " ".join(base))]
    for i in range(1, 12):
        near = list(base)
        near[rng.randrange(150)] = f"changed{i}"
        rows += [(i, " ".join(near))] * (1 + i % 2)
    rows += [(40 + i, " ".join(f"v{rng.randrange(900)}" for _ in range(60))) for i in range(6)]
    rows = [(d, t, "h") for d, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in jaccard_join.jaccard_join(df).collect()]
    want = brute.jaccard_components([(d, t) for d, t, _ in rows])
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert "links" in labels and "sets" not in labels
