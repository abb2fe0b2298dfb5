"""Scalar column functions: log-line parsing, time buckets, device class."""

from tidelog.functions.device import device_type, register_device_function
from tidelog.functions.parse import (
    add_time_columns,
    extract_bytes,
    extract_endpoint,
    extract_ip,
    extract_method,
    extract_protocol,
    extract_status,
    extract_timestamp_str,
    extract_user_agent,
    field_columns,
    parse_clf_timestamp,
    parse_fields,
    parse_logs,
    safe_int,
)
from tidelog.functions.periods import (
    day_bucket,
    hour_bucket,
    week_bucket,
    year_week,
    year_week_of_day,
)

__all__ = [
    "add_time_columns",
    "day_bucket",
    "device_type",
    "extract_bytes",
    "extract_endpoint",
    "extract_ip",
    "extract_method",
    "extract_protocol",
    "extract_status",
    "extract_timestamp_str",
    "extract_user_agent",
    "field_columns",
    "hour_bucket",
    "parse_clf_timestamp",
    "parse_fields",
    "parse_logs",
    "register_device_function",
    "safe_int",
    "week_bucket",
    "year_week",
    "year_week_of_day",
]
