"""Ad-hoc SQL surface."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidelog.sources.tables import table_exists


def adhoc(
    spark: SparkSession,
    sql: str,
    views: Mapping[str, DataFrame] | None = None,
    limit: int | None = None,
    args: Mapping[str, Any] | Sequence[Any] | None = None,
) -> DataFrame:
    """Runs Spark SQL over the session catalog plus ``views`` (registered as
    temporary views).  Lazy: nothing runs until the caller asks; errors are
    raised, not printed.  ``limit`` bounds a preview.

    ``args`` binds values to the statement's markers: a mapping for ``:name``,
    a sequence for ``?``.  Values become typed literals, never SQL text, so a
    quote in one is a character like any other and filters on partition
    columns still prune.  Columns (e.g. ``F.array(...)``) can be bound too."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    out = spark.sql(sql) if args is None else spark.sql(sql, args=_bound(args))
    return out.limit(limit) if limit is not None else out


def _bound(args: Mapping[str, Any] | Sequence[Any]) -> dict[str, Any] | list[Any]:
    if isinstance(args, str):
        raise TypeError("args must be a mapping or a sequence of values, not text")
    return dict(args) if isinstance(args, Mapping) else list(args)


def job_views(spark: SparkSession, cfg) -> dict[str, DataFrame]:
    """The job tables of ``cfg`` under their short names (``raw_logs``,
    ``processed_logs`` and the four reports), for ``adhoc(..., views=...)``.
    Views are lazy table scans: filters on ``process_date`` / ``hour`` in
    the SQL still prune partitions."""
    from tidelog.plans.reports import REPORTS

    names = {cfg.raw_table: cfg.raw_table_name, cfg.processed_table: cfg.processed_table_name}
    names.update({r: cfg.report_table_name(r) for r in REPORTS})
    return {
        short: spark.table(full)
        for short, full in names.items()
        if table_exists(spark, full)
    }
