"""Ingest with a dead-letter side: accepted and rejected lines in one pass.

Every line is parsed once and written once.  One job writes below one root,
partitioned by ``kind`` first:

    kind=parsed/process_date=<day>/hour=<hour>/      accepted rows
    kind=rejected/process_date=<batch>/hour=lines/   rejected lines

so the text is neither scanned a second time for the rejects nor cached.  A
line is rejected when a required field is missing; its row keeps the whole
line and names each field that failed.  Counts are observed in the write:
accepted + rejected = lines.

Writes replace the partitions they hold: a batch that runs again replaces
its own days and its own rejects, other batches' rejects stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidelog.config import LogConfig
from tidelog.functions.parse import parse_logs
from tidelog.sources.tables import (
    create_database,
    delete_folder,
    quoted_name,
    table_exists,
    text_literal,
    write_partitioned_path,
)
from tidelog.sources.text import read_log_lines

REQUIRED = ("timestamp", "method", "endpoint", "protocol", "status")
ROOT_PARTITIONS = ("kind", "process_date", "hour")
PARSED, REJECTED, LINES = "parsed", "rejected", "lines"


def failed_fields(df: DataFrame, required: Sequence[str] = REQUIRED) -> Column:
    """The names of the required fields that a parsed row lacks (NULL, or
    empty text), in the order given."""
    checks = []
    for name in required:
        missing = F.col(name).isNull()
        if df.schema[name].dataType.simpleString() == "string":
            missing = missing | (F.col(name) == "")
        checks.append(F.when(missing, F.lit(name)))
    return F.array_compact(F.array(*checks))


def split_lines(
    lines: DataFrame, batch: str, required: Sequence[str] = REQUIRED, **parse_options
) -> DataFrame:
    """Parsed rows with ``line`` and ``reasons`` (NULL where accepted) and the
    partition columns of the root."""
    if "timestamp" not in required:
        raise ValueError("timestamp must be required: accepted rows are stored by day")
    parsed = parse_logs(lines, keep=("value",), **parse_options)
    marked = parsed.withColumn("reasons", failed_fields(parsed, required))
    rejected = F.size("reasons") > 0
    return marked.select(
        *[c for c in parsed.columns if c not in ("value", "process_date", "hour")],
        F.when(rejected, F.col("value")).alias("line"),
        F.when(rejected, F.col("reasons")).alias("reasons"),
        F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(PARSED)).alias("kind"),
        F.when(rejected, F.lit(batch)).otherwise(F.col("process_date")).alias("process_date"),
        F.when(rejected, F.lit(LINES)).otherwise(F.col("hour")).alias("hour"),
    )


def ingest_split(
    spark: SparkSession,
    cfg: LogConfig,
    root: str,
    batch: str,
    required: Sequence[str] = REQUIRED,
):
    """Text files -> accepted rows and rejected lines below ``root``.

    Returns a ``JobResult``: ``rows`` accepted, ``malformed`` rejected,
    ``rejected`` per failed field, and the days written.
    """
    from tidelog.plans.jobs import JobResult

    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError("a batch label holds letters, digits, _ . and - only")
    lines = read_log_lines(
        spark, cfg.input_paths, recursive=cfg.recursive, file_filter=cfg.file_filter
    )
    rows = split_lines(
        lines, batch, required, bytes_mode=cfg.bytes_mode, bytes_type=cfg.bytes_type, strict=cfg.strict
    )
    obs = Observation(f"split-{batch}")
    accepted = F.col("kind") == PARSED
    # observed above the clustering shuffle, as in ``ingest``
    clustered = rows.hint("rebalance", *ROOT_PARTITIONS).observe(
        obs,
        F.count_if(accepted).alias("accepted"),
        F.count_if(~accepted).alias("rejected"),
        # one value per hour of the batch's time span
        F.collect_set(F.when(accepted, F.concat_ws("/", "process_date", "hour"))).alias("hours"),
        *[F.count_if(F.array_contains("reasons", f)).alias(f"failed_{f}") for f in required],
    )
    write_partitioned_path(
        clustered.sortWithinPartitions(*ROOT_PARTITIONS, *cfg.sort_within),
        root,
        ROOT_PARTITIONS,
        cluster=False,
        options=cfg.log_table_options,
    )
    m = obs.get
    if not m["rejected"]:  # a repaired batch leaves no rejects of its former run
        delete_folder(spark, f"{root}/kind={REJECTED}/process_date={batch}")
    hours = sorted(tuple(h.split("/")) for h in m["hours"] or [])
    return JobResult(
        m["accepted"],
        m["rejected"],
        {"root": root},
        sorted({day for day, _ in hours}),
        {f: m[f"failed_{f}"] for f in required},
        hours,
    )


def _read_root(spark: SparkSession, cfg: LogConfig, root: str, kind: str) -> DataFrame:
    # partition values stay text; an empty frame gives the parser's schema
    empty = spark.createDataFrame([], "value string")
    schema = split_lines(empty, "-", bytes_mode=cfg.bytes_mode, bytes_type=cfg.bytes_type).schema
    return spark.read.schema(schema).parquet(root).filter(F.col("kind") == kind)


def read_accepted(spark: SparkSession, cfg: LogConfig, root: str) -> DataFrame:
    """Accepted rows in the raw schema."""
    return _read_root(spark, cfg, root, PARSED).drop("kind", "line", "reasons")


def read_rejected(spark: SparkSession, cfg: LogConfig, root: str) -> DataFrame:
    """``(batch, line, reasons)`` of every rejected line."""
    return _read_root(spark, cfg, root, REJECTED).select(
        F.col("process_date").alias("batch"), "line", "reasons"
    )


def attach_accepted(spark: SparkSession, cfg: LogConfig, root: str, hours: Sequence[tuple]) -> str:
    """Registers ``hours`` ((day, hour) pairs) of the accepted rows as
    partitions of the raw table, created over ``root`` on first use; transform
    and reports then run on it."""
    name = cfg.raw_table_name
    create_database(spark, cfg.database, cfg.database_location)
    if not table_exists(spark, name):
        fields = read_accepted(spark, cfg, root).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {quoted_name(name)} ({columns}) USING parquet "
            f"PARTITIONED BY (process_date, hour) LOCATION {text_literal(f'{root}/kind={PARSED}')}"
        )
    if hours:
        specs = " ".join(
            f"PARTITION (process_date={text_literal(d)}, hour={text_literal(h)})" for d, h in hours
        )
        spark.sql(f"ALTER TABLE {quoted_name(name)} ADD IF NOT EXISTS {specs}")
        spark.catalog.refreshTable(quoted_name(name))
    return name
