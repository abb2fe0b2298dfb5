"""Incremental ingest with Structured Streaming.

The batch ingest re-parses its whole input on every run.  This form keeps a
checkpoint of the files already seen, so each run (``availableNow``: process
what is there, then stop) parses only new log files and appends them to a
partitioned parquet folder.  The file sink's commit log (``_spark_metadata``)
makes the output exactly-once: a batch re-run after a lost executor or a
failed driver replaces its own files instead of duplicating rows, and readers
of the folder see only committed files.

There is no streaming aggregation, so no state and no watermark: the reports
are batch jobs over the ingested table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidelog.config import LogConfig
from tidelog.functions.parse import parse_logs
from tidelog.session import configure_session, shared_dir

LOG_PARTITIONS = ("process_date", "hour")


def raw_schema(spark: SparkSession, cfg: LogConfig) -> StructType:
    """Schema of the parsed rows for the config's parse options."""
    empty = spark.createDataFrame([], "value string")
    return _parse(empty, cfg).schema


def _parse(lines: DataFrame, cfg: LogConfig) -> DataFrame:
    return parse_logs(
        lines,
        bytes_mode=cfg.bytes_mode,
        bytes_type=cfg.bytes_type,
        strict=cfg.strict,
        drop_malformed=cfg.drop_malformed,
    )


def default_checkpoint(spark: SparkSession, name: str) -> str:
    """A stable checkpoint folder below the shared folder (reused by runs)."""
    return f"{shared_dir(spark)}/tidelog-streams/{name}"


def start_ingest_stream(
    spark: SparkSession,
    cfg: LogConfig,
    output_path: str,
    checkpoint: str,
    input_dir: str | None = None,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    partition_cols: Sequence[str] = LOG_PARTITIONS,
) -> StreamingQuery:
    """Starts the stream: text files of ``input_dir`` -> parsed rows ->
    parquet under ``output_path`` partitioned by (day, hour).

    ``processing_time`` (e.g. ``"1 minute"``) keeps it running; by default it
    drains the available files and stops.
    """
    configure_session(spark, cfg.time_zone)
    if input_dir is None and len(cfg.input_paths) != 1:
        raise ValueError("a file stream reads one folder or glob: pass input_dir")
    source = input_dir or cfg.input_paths[0]
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    parsed = _parse(reader.load(source), cfg)
    writer = (
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_cols)
        .outputMode("append")
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start(output_path)


def run_ingest_stream(
    spark: SparkSession,
    cfg: LogConfig,
    output_path: str,
    checkpoint: str,
    input_dir: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """One incremental run: processes the files not seen before and stops."""
    query = start_ingest_stream(
        spark, cfg, output_path, checkpoint, input_dir, max_files_per_trigger
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def read_ingested(spark: SparkSession, output_path: str, cfg: LogConfig | None = None) -> DataFrame:
    """The committed rows of a streamed folder, with the parse schema (the
    day and hour stay strings instead of inferred DATE / INT)."""
    schema = raw_schema(spark, cfg or LogConfig())
    return spark.read.schema(schema).parquet(output_path)
