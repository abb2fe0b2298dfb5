"""Job configuration (driver-side only)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class LogConfig:
    """Settings for the ingest -> transform -> report jobs.

    ``input_paths`` may hold several paths or globs.  ``table_format`` is the
    writer format of every table; parquet by default, or a V2 format such as
    ``iceberg`` when its catalog is configured on the session.
    """

    input_paths: list[str] = field(default_factory=list)
    recursive: bool = False  # descend into nested input folders
    file_filter: str | None = None  # keep matching file names, e.g. "*.log"
    database: str = "weblogs"
    database_location: str | None = None
    raw_table: str = "raw_logs"
    processed_table: str = "processed_logs"
    # counts per (day, key) that reports are built from (see plans.state);
    # ``report_state=False`` recounts the processed rows of whole weeks
    state_table: str = "daily_counts"
    report_state: bool = True
    table_format: str = "parquet"
    # file codec, stored as a table property at creation so every later
    # insert uses it; None keeps the session default
    compression: str | None = "zstd"
    # parsing options (see tidelog.functions.parse)
    bytes_mode: str = "after_status"
    bytes_type: str = "int"
    strict: bool = False
    drop_malformed: bool = False
    # folder for ingests with a dead-letter side (see plans.rejects): lines
    # that lack a required field are kept there with reasons, the raw table
    # holds the others; ``batch`` names the lines of one ingest
    split_root: str | None = None
    batch: str = "batch"
    # report options
    top_k: int = 5
    year_week: str = "calendar"
    # layout: "rebalance" (AQE sized, skew split), "dynamic" (volume based
    # hash repartition) or "off"
    layout: str = "rebalance"
    base_partitions: int = 2
    max_partitions: int = 50
    target_rows_per_partition: int = 1_000_000
    salt_buckets: int = 8
    # columns sorted inside each written file after the partition columns:
    # min/max statistics then let filters on them skip row groups, and runs
    # of equal values compress better
    sort_within: tuple[str, ...] = ("ip",)
    # columns of the raw and processed files that get a Bloom filter per row
    # group: look-ups of one value then skip row groups whose range holds it
    # but which don't (worth it for columns of many values, e.g. ("ip",))
    bloom_columns: tuple[str, ...] = ()
    bloom_values: int = 1_000_000  # expected distinct values in a row group
    time_zone: str = "UTC"

    @property
    def table_options(self) -> dict[str, str]:
        return {"compression": self.compression} if self.compression else {}

    @property
    def log_table_options(self) -> dict[str, str]:
        """``table_options`` and the Bloom filters of the log tables."""
        out = self.table_options
        for column in self.bloom_columns:
            out[f"parquet.bloom.filter.enabled#{column}"] = "true"
            out[f"parquet.bloom.filter.expected.ndv#{column}"] = str(self.bloom_values)
        return out

    def qualified(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    @property
    def raw_table_name(self) -> str:
        return self.qualified(self.raw_table)

    @property
    def processed_table_name(self) -> str:
        return self.qualified(self.processed_table)

    @property
    def state_table_name(self) -> str:
        return self.qualified(self.state_table)

    def report_table_name(self, report: str) -> str:
        return self.qualified(report)
