"""Text source: one row per log line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    with_file_name: bool = False,
    recursive: bool = False,
    file_filter: str | None = None,
) -> DataFrame:
    """Reads text files (paths or globs; compressed files are decoded by
    extension) into ``value STRING`` rows.  Splits follow
    ``spark.sql.files.maxPartitionBytes``; ``with_file_name`` adds the source
    file from the hidden ``_metadata`` column.  ``recursive`` descends into
    nested folders (e.g. ``logs/2024/01/01/``) and ``file_filter`` keeps only
    matching file names (e.g. ``"*.log"``).
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if file_filter:
        reader = reader.option("pathGlobFilter", file_filter)
    df = reader.text(list(paths))
    if with_file_name:
        df = df.select("value", F.col("_metadata.file_name").alias("file_name"))
    return df
