"""tidelog — Spark-native web access-log analytics.

Raw log text is parsed into typed columns with native Spark expressions,
enriched with day / hour / week buckets and a device class, written to
partitioned tables that can be re-ingested safely, and summarised into
top-k-per-period reports.  Everything on the data path is DataFrame code
that Catalyst plans and whole-stage codegen compiles; there is no Python
UDF and no driver-side loop over rows.
"""

from tidelog.config import LogConfig
from tidelog.functions import device_type, parse_logs, year_week
from tidelog.operators import enrich_logs, key_skew, rank_per_group, top_k_per_group
from tidelog.plans import adhoc, ingest, read_reports, report, run_all, transform
from tidelog.session import RECOMMENDED_CONF, configure_session, shared_dir

__all__ = [
    "RECOMMENDED_CONF",
    "LogConfig",
    "adhoc",
    "configure_session",
    "device_type",
    "enrich_logs",
    "ingest",
    "key_skew",
    "parse_logs",
    "rank_per_group",
    "read_reports",
    "report",
    "run_all",
    "shared_dir",
    "top_k_per_group",
    "transform",
    "year_week",
]
