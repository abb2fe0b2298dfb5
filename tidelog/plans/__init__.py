"""Job plans: ingest, transform, reports, full run, ad-hoc SQL."""

from tidelog.plans.adhoc import adhoc, job_views
from tidelog.plans.days import day_filter, week_filter
from tidelog.plans.jobs import JobResult, backfill, ingest, report, run_all, transform
from tidelog.plans.rejects import (
    attach_accepted,
    failed_fields,
    ingest_split,
    read_accepted,
    read_rejected,
    split_lines,
)
from tidelog.plans.reports import (
    REPORTS,
    build_reports,
    daily_report,
    preview_tables,
    read_reports,
    union_reports,
    weekly_report,
    write_reports,
)
from tidelog.plans.state import (
    count_state,
    merge_state,
    period_top_k,
    read_state,
    refresh_state,
    state_drift,
    state_reports,
    top_k_between,
    trailing_top_k,
)

__all__ = [
    "attach_accepted",
    "failed_fields",
    "ingest_split",
    "read_accepted",
    "read_rejected",
    "split_lines",
    "REPORTS",
    "JobResult",
    "adhoc",
    "backfill",
    "day_filter",
    "job_views",
    "preview_tables",
    "week_filter",
    "build_reports",
    "daily_report",
    "ingest",
    "read_reports",
    "report",
    "run_all",
    "transform",
    "union_reports",
    "weekly_report",
    "write_reports",
    "count_state",
    "merge_state",
    "period_top_k",
    "read_state",
    "refresh_state",
    "state_drift",
    "state_reports",
    "top_k_between",
    "trailing_top_k",
]
