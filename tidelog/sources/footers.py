"""Counts and ranges from Parquet footers.

A footer states the rows of each row group and the least and greatest value
of its columns, so totals, rows per partition and column ranges need no data
page: one footer per file is read, whatever the file holds.  Spark pushes
such aggregates down for its V2 Parquet source only; these functions read
through a session of their own (same context and catalog) with that source
and push-down on, and leave the caller's session as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.tables import describe_table

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSH_DOWN = "spark.sql.parquet.aggregatePushdown"


def _footer_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    # a new session starts from the context's settings, not this session's
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        session.conf.set(key, spark.conf.get(key))
    kept = [s for s in session.conf.get(_V1_SOURCES).split(",") if s.strip() != "parquet"]
    session.conf.set(_V1_SOURCES, ",".join(kept))
    session.conf.set(_PUSH_DOWN, "true")
    # partition values stay text, as the tables declare them
    session.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return session


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table."""
    rows = describe_table(spark, name).filter(F.col("col_name") == "Location").collect()
    if not rows:
        raise ValueError(f"{name} has no location")
    return rows[0]["data_type"]


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return _footer_session(spark).read.parquet(path)


def footer_counts(
    spark: SparkSession,
    path: str,
    by: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """``(by..., rows BIGINT)`` of a Parquet folder; ``by`` and ``where``
    take partition columns, anything else would have to read the data and
    raises.

    The scan groups by all partition columns or none, so counts per some of
    them are sums over its (partition, rows) pairs.
    """
    data = _scan(spark, path)
    partitions = _partition_columns(data)
    unknown = [c for c in by if c not in partitions]
    if unknown:
        raise ValueError(f"{unknown} are not partition columns of {path}")
    if where is not None:
        data = data.filter(where)
    out = data.groupBy(*(partitions if by else ())).agg(F.count(F.lit(1)).alias("rows"))
    out = _pushed(out, path)
    if not by:
        return out.agg(_no_rows_is_zero("rows"))
    if set(by) == set(partitions):
        return out.select(*by, "rows")
    return out.groupBy(*by).agg(F.sum("rows").alias("rows"))


def _partition_columns(df: DataFrame) -> list[str]:
    relation = df._jdf.queryExecution().analyzed().collectLeaves().head()
    return list(relation.table().fileIndex().partitionSchema().fieldNames())


def footer_range(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row ``(rows, n_values, least, greatest)`` of a numeric, date or
    boolean column (footers may shorten strings, so those raise)."""
    c = F.col(column)
    out = _scan(spark, path).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(c).alias("n_values"),
        F.min(c).alias("least"),
        F.max(c).alias("greatest"),
    )
    return _pushed(out, path).agg(
        _no_rows_is_zero("rows"),
        _no_rows_is_zero("n_values"),
        F.max("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )


def _no_rows_is_zero(name: str) -> Column:
    """The one value of ``name``: a pushed count over files without row
    groups comes out as NULL, though its type says it can't."""
    return F.coalesce(F.max(name), F.lit(0).cast("bigint")).alias(name)


def _pushed(df: DataFrame, path: str) -> DataFrame:
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "PushedAggregation: [COUNT(" not in plan:
        raise ValueError(f"the footers of {path} don't answer this aggregate")
    return df


def table_row_counts(spark: SparkSession, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows of a Parquet catalog table, per its partition columns ``by``."""
    return footer_counts(spark, table_location(spark, name), by)
