"""Sources and sinks: log text, event-derived lines, catalog tables, JSON/CSV."""

from tidelog.sources.event_logs import lines_from_events, read_events, write_lines
from tidelog.sources.footers import footer_counts, footer_range, table_location, table_row_counts
from tidelog.sources.tables import (
    create_database,
    create_table,
    describe_table,
    list_databases,
    list_tables,
    overwrite_partitions,
    read_table,
    replace_table,
    table_exists,
    write_partitioned,
    write_partitioned_path,
)
from tidelog.sources.text import read_log_lines

__all__ = [
    "footer_counts",
    "footer_range",
    "table_location",
    "table_row_counts",
    "create_database",
    "create_table",
    "describe_table",
    "lines_from_events",
    "list_databases",
    "list_tables",
    "overwrite_partitions",
    "read_events",
    "read_log_lines",
    "read_table",
    "replace_table",
    "table_exists",
    "write_lines",
    "write_partitioned",
    "write_partitioned_path",
]
