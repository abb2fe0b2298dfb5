"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept; ``run`` writes each
result as Parquet and reads it again for the next stage.  All but the last
return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import hilbert_pack, host_quality, jaccard_join, line_runs, suffix_dedup
from tidelog.llm.common import materialise, table

STAGES = [
    ("quality_rules", host_quality.stage),
    ("line_dedup", line_runs.stage),
    ("ngram_jaccard_join", jaccard_join.stage),
    ("suffix_array_dedup", suffix_dedup.stage),
    ("packing", hilbert_pack.stage),
]

#: Several stages can't be expressed in SQL; tests compare them with plain computations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
