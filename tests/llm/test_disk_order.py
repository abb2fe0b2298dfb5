"""What op3_training_order keeps on disk: the shards are written in passes."""

from pathlib import Path

import numpy as np

from tidelog.llm import training_order
from tidelog.llm.common import prepare
from tidelog.session import scratch_path


def test_training_order_in_passes(spark, monkeypatch):
    """Each pass shuffles its own shards only, the ids go when all are written,
    and the slots are those of the permutation."""
    prepare(spark)
    monkeypatch.setattr(training_order, "SHARD", 8)
    passes, inner, gone = [], training_order.materialise, []

    def noted(df, label):
        out = inner(df, label)
        if label == "manifest":
            passes.append(sorted(r["slot"] for r in out.select("slot").collect()))
        return out

    monkeypatch.setattr(training_order, "materialise", noted)
    ids = training_order.encoded_rows
    monkeypatch.setattr(training_order, "encoded_rows", lambda *a: gone.append(ids(*a)) or gone[-1])
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "order")
    rows = [(i % 50, f"text number {i} " * (i % 7)) for i in range(75)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(source)
    manifest = training_order.write_training_order(spark.read.parquet(source), folder).collect()
    # 10 shards: three passes of three, then one of one
    assert passes == [list(range(0, 24)), list(range(24, 48)), list(range(48, 72)), [72, 73, 74]]
    assert [r["doc_id"] for r in sorted(manifest, key=lambda r: r["slot"])] == [
        rows[i][0] for i in np.argsort(training_order.feistel(np.arange(75), 75))
    ]
    back = training_order.read_training_order(spark, folder, 2).collect()
    assert sorted(r["slot"] for r in back) == list(range(75))
    assert not Path(gone[0][1].removeprefix("file:")).exists()
