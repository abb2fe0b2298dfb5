"""Queries and SQL of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

import corpus_pipeline
from tidelog.llm import (
    adaptive_ann,
    bpe_tree,
    hilbert_pack,
    host_quality,
    integer_kmeans,
    jaccard_join,
    license_digest,
    line_runs,
    merkle_manifest,
    secret_lexing,
    suffix_dedup,
    training_order,
    warc_chain,
)


def queries() -> dict:
    return {
        "op1_hilbert_pack": hilbert_pack.query,
        "op2_warc_chain": warc_chain.query,
        "op3_training_order": training_order.query,
        "op4_adaptive_scan": adaptive_ann.query,
        "op5_license_digest": license_digest.query,
        "op6_host_quality": host_quality.query,
        "op7_bpe_tree": bpe_tree.query,
        "op8_line_runs": line_runs.query,
        "op9_jaccard_join": jaccard_join.query,
        "op10_suffix_dedup": suffix_dedup.query,
        "op11_merkle_manifest": merkle_manifest.query,
        "op12_integer_kmeans": integer_kmeans.query,
        "op13_secret_lexing": secret_lexing.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc_chain": warc_chain.oracle_sql(),
        "op5_license_digest": license_digest.oracle_sql(),
        "op6_host_quality": host_quality.ORACLE_SQL,
        "op8_line_runs": line_runs.ORACLE_SQL,
        "op11_merkle_manifest": merkle_manifest.oracle_sql(),
        "op12_integer_kmeans": integer_kmeans.oracle_sql(),
    }
