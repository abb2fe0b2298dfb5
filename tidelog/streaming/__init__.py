"""Structured Streaming form of the ingest job (incremental, exactly-once)."""

from tidelog.streaming.ingest import (
    default_checkpoint,
    read_ingested,
    run_ingest_stream,
    start_ingest_stream,
)

__all__ = ["default_checkpoint", "read_ingested", "run_ingest_stream", "start_ingest_stream"]
