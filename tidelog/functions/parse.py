"""Access-log line parsing as native Spark expressions.

Every extractor is a ``regexp_extract`` (a JVM expression inside
whole-stage codegen) followed, where a number or a time is wanted, by a
``try_cast`` / ``try_to_timestamp`` so that one malformed line yields NULL
instead of failing the job under ANSI mode.

Two parse modes:

* default: eight independent patterns, each searched anywhere in the line.
  A line may be half parsed; an unmatched pattern yields ``''`` (text) or
  NULL (numbers, time).
* ``strict=True``: one anchored pattern for the whole common / combined log
  line; a line either yields every field or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.periods import day_bucket, hour_bucket

# --- fixed values: the field patterns (after SQL-literal unescaping) -------
IP_PATTERN = r"^(\S+)"
TIMESTAMP_PATTERN = r"\[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+\-]\d{4})\]"
METHOD_PATTERN = r'"(\S+)'
ENDPOINT_PATTERN = r'"(?:\S+)\s+(\S+)'
PROTOCOL_PATTERN = r'"(?:\S+)\s+(?:\S+)\s+(\S+)"'
STATUS_PATTERN = r"\s(\d{3})\s"
FIRST_INT_PATTERN = r"\s(\d+)\s"
USER_AGENT_PATTERN = r'"([^"]*)"$'
TIMESTAMP_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# --- end of fixed values ----------------------------------------------------

# The response size is the integer after the three-digit status; a "-" size
# does not match and gives NULL.
BYTES_AFTER_STATUS_PATTERN = r"\s\d{3}\s(\d+)\s"

# Whole-line pattern for strict mode: host ident user [time] "method path
# protocol" status size, optionally followed by "referer" "agent".
STRICT_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+|-)'
    r'(?: "([^"]*)" "([^"]*)")?\s*$'
)
_STRICT_GROUPS = {
    "ip": 1,
    "timestamp_str": 4,
    "method": 5,
    "endpoint": 6,
    "protocol": 7,
    "status": 8,
    "bytes": 9,
    "user_agent": 11,
}

TEXT_FIELDS = ("ip", "timestamp_str", "method", "endpoint", "protocol", "user_agent")
FIELD_ORDER = (
    "ip",
    "timestamp_str",
    "method",
    "endpoint",
    "protocol",
    "status",
    "bytes",
    "user_agent",
)
BYTES_MODES = ("after_status", "first_int")
BYTES_TYPES = ("int", "bigint")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract(line: Column | str, pattern: str) -> Column:
    return F.regexp_extract(_col(line), pattern, 1)


def safe_int(text: Column, to: str = "int") -> Column:
    """String -> integer; NULL (never an error) for '' or out-of-range text."""
    return text.try_cast(to)


def extract_ip(line: Column | str = "value") -> Column:
    return _extract(line, IP_PATTERN)


def extract_timestamp_str(line: Column | str = "value") -> Column:
    return _extract(line, TIMESTAMP_PATTERN)


def extract_method(line: Column | str = "value") -> Column:
    return _extract(line, METHOD_PATTERN)


def extract_endpoint(line: Column | str = "value") -> Column:
    return _extract(line, ENDPOINT_PATTERN)


def extract_protocol(line: Column | str = "value") -> Column:
    return _extract(line, PROTOCOL_PATTERN)


def extract_status(line: Column | str = "value") -> Column:
    return safe_int(_extract(line, STATUS_PATTERN))


def extract_bytes(
    line: Column | str = "value", mode: str = "after_status", to: str = "int"
) -> Column:
    if mode not in BYTES_MODES:
        raise ValueError(f"bytes mode must be one of {BYTES_MODES}, got {mode!r}")
    if to not in BYTES_TYPES:
        raise ValueError(f"bytes type must be one of {BYTES_TYPES}, got {to!r}")
    pattern = BYTES_AFTER_STATUS_PATTERN if mode == "after_status" else FIRST_INT_PATTERN
    return safe_int(_extract(line, pattern), to)


def extract_user_agent(line: Column | str = "value") -> Column:
    return _extract(line, USER_AGENT_PATTERN)


def parse_clf_timestamp(text: Column | str) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss Z`` text -> TIMESTAMP (offset honoured)."""
    return F.try_to_timestamp(_col(text), F.lit(TIMESTAMP_FORMAT))


def _independent_fields(line: Column, bytes_mode: str, bytes_type: str) -> dict[str, Column]:
    return {
        "ip": extract_ip(line),
        "timestamp_str": extract_timestamp_str(line),
        "method": extract_method(line),
        "endpoint": extract_endpoint(line),
        "protocol": extract_protocol(line),
        "status": extract_status(line),
        "bytes": extract_bytes(line, bytes_mode, bytes_type),
        "user_agent": extract_user_agent(line),
    }


def _strict_fields(line: Column, bytes_type: str) -> dict[str, Column]:
    out = {}
    for name, group in _STRICT_GROUPS.items():
        text = F.regexp_extract(line, STRICT_PATTERN, group)
        if name == "status":
            out[name] = safe_int(text)
        elif name == "bytes":
            out[name] = safe_int(text, bytes_type)
        else:
            out[name] = text
    return out


def field_columns(
    line: Column | str = "value",
    bytes_mode: str = "after_status",
    bytes_type: str = "int",
    strict: bool = False,
) -> dict[str, Column]:
    """The eight extracted fields of a log line, by name, in schema order."""
    line = _col(line)
    if bytes_mode not in BYTES_MODES:
        raise ValueError(f"bytes mode must be one of {BYTES_MODES}, got {bytes_mode!r}")
    if strict:
        return _strict_fields(line, bytes_type)
    return _independent_fields(line, bytes_mode, bytes_type)


def parse_fields(
    lines: DataFrame,
    line_col: str = "value",
    keep: tuple[str, ...] = (),
    bytes_mode: str = "after_status",
    bytes_type: str = "int",
    strict: bool = False,
) -> DataFrame:
    """Lines -> ``keep`` columns + the eight extracted fields."""
    fields = field_columns(F.col(line_col), bytes_mode, bytes_type, strict)
    return lines.select(*keep, *[c.alias(n) for n, c in fields.items()])


def add_time_columns(fields: DataFrame) -> DataFrame:
    """Adds ``timestamp``, ``process_date`` ('yyyy-MM-dd') and ``hour`` ('HH').

    The timestamp is parsed once; both buckets are formatted from it in the
    session time zone.
    """
    with_ts = fields.withColumn("timestamp", parse_clf_timestamp("timestamp_str"))
    return with_ts.withColumns(
        {"process_date": day_bucket("timestamp"), "hour": hour_bucket("timestamp")}
    )


def parse_logs(
    lines: DataFrame,
    line_col: str = "value",
    keep: tuple[str, ...] = (),
    bytes_mode: str = "after_status",
    bytes_type: str = "int",
    strict: bool = False,
    drop_malformed: bool = False,
) -> DataFrame:
    """Lines -> the ``raw_logs`` schema (eight fields + time columns).

    Malformed lines (no parsable time) are kept with NULL time columns
    unless ``drop_malformed``.
    """
    parsed = add_time_columns(
        parse_fields(lines, line_col, keep, bytes_mode, bytes_type, strict)
    )
    if drop_malformed:
        parsed = parsed.filter(F.col("timestamp").isNotNull())
    return parsed
