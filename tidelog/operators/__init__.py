"""Relational operators: enrichment, counting / top-k, skew, layout,
metrics summaries and rendering."""

from tidelog.operators.enrich import enrich_logs
from tidelog.operators.hitters import (
    error_share,
    frequent_keys,
    heavy_hitters,
    key_sketch,
    merge_sketches,
    tracked_for,
)
from tidelog.operators.layout import (
    apply_layout,
    count_rows,
    estimate_row_count,
    estimate_rows,
    spread,
)
from tidelog.operators.metrics import metrics_by_type, metrics_totals
from tidelog.operators.placement import (
    balanced_partition,
    place,
    place_balanced,
    placement_counts,
)
from tidelog.operators.skew import key_skew, partition_counts, partition_extremes, partition_skew
from tidelog.operators.topk import (
    count_by,
    rank_counts,
    rank_per_group,
    sort_report,
    top_k_of_counts,
    top_k_per_group,
)

__all__ = [
    "balanced_partition",
    "error_share",
    "frequent_keys",
    "heavy_hitters",
    "key_sketch",
    "merge_sketches",
    "place",
    "place_balanced",
    "placement_counts",
    "tracked_for",
    "apply_layout",
    "count_by",
    "count_rows",
    "enrich_logs",
    "estimate_row_count",
    "estimate_rows",
    "key_skew",
    "metrics_by_type",
    "metrics_totals",
    "partition_counts",
    "partition_extremes",
    "partition_skew",
    "rank_counts",
    "rank_per_group",
    "sort_report",
    "spread",
    "top_k_of_counts",
    "top_k_per_group",
]
