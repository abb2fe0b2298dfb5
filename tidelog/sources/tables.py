"""Catalog tables: create, replace, dynamic partition overwrite, read, list.

Parquet (a V1 source) is the default format.  For a V1 table, dynamic
partition overwrite needs the *session* setting
``spark.sql.sources.partitionOverwriteMode=dynamic`` around a positional
``insertInto`` - a writer option is ignored and ``saveAsTable`` in overwrite
mode replaces the whole table.  V2 formats (e.g. iceberg, when its catalog is
configured) use ``DataFrameWriterV2.overwritePartitions``.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1_FORMATS = frozenset({"parquet", "orc", "json", "csv", "avro", "text"})
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# The overwrite mode is a session-wide setting: two threads setting and
# restoring it around their inserts could let one insert run in static mode,
# which replaces the whole table.  tidelog's own dynamic inserts are
# therefore serialised (code outside tidelog must not change the setting
# concurrently).
_OVERWRITE_LOCK = threading.Lock()


def _quote(name: str) -> str:
    """A database name as one SQL identifier."""
    return name if name.startswith("`") else f"`{name.replace('`', '``')}`"


def _parts(name: str) -> list[str]:
    """The parts of a table name, dotted and optionally in backticks."""
    found = re.findall(r"`((?:[^`]|``)*)`|([^.`]+)", name)
    return [quoted.replace("``", "`") if quoted else plain for quoted, plain in found]


def quoted_name(name: str) -> str:
    """A table name with every part in backticks, safe within SQL text."""
    return ".".join(_quote(part) for part in _parts(name))


def text_literal(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Sets a SQL conf for the duration of the block, then restores it."""
    previous = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (idempotent)."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_quote(name)}"
    if location:
        sql += f" LOCATION {text_literal(location)}"
    spark.sql(sql)
    return name


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(quoted_name(name))


def clustered(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Clusters rows by the table's partition columns before a write, so each
    table partition gets few files.  REBALANCE lets AQE split a partition
    that is too large (a hot hour) and merge small ones; it never drops or
    reorders the rows' content.
    """
    if not partition_cols:
        return df.hint("rebalance")
    return df.hint("rebalance", *partition_cols)


def create_table(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    cluster: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """First write of a table (CTAS).

    For a V1 table the empty table is created first and the rows are then
    inserted: the insert registers exactly the partitions it writes, where a
    partitioned ``saveAsTable`` re-discovers every partition directory after
    the write.  A failed insert leaves an empty table that a re-run fills.
    ``options`` (e.g. ``compression``) become table properties that every
    later insert uses.
    """
    data = clustered(df, partition_cols) if cluster else df
    options = options or {}
    if fmt in V1_FORMATS:
        spark = df.sparkSession
        # schema only: the input plan is not executed for the empty table
        writer = spark.createDataFrame([], df.schema).write.format(fmt).options(**options)
        if partition_cols:
            writer = writer.partitionBy(*partition_cols)
        writer.saveAsTable(name)
        data.select(*spark.table(name).columns).write.insertInto(name)
    else:
        writer = data.writeTo(name).using(fmt).options(**options)
        if partition_cols:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_cols])
        writer.create()
    return name


def replace_table(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    cluster: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """Replaces the table's contents and schema; old partitions are gone.
    ``options`` become properties of the new table."""
    data = clustered(df, partition_cols) if cluster else df
    options = options or {}
    if fmt in V1_FORMATS:
        writer = data.write.format(fmt).options(**options).mode("overwrite")
        if partition_cols:
            writer = writer.partitionBy(*partition_cols)
        writer.saveAsTable(name)
    else:
        writer = data.writeTo(name).using(fmt).options(**options)
        if partition_cols:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_cols])
        writer.createOrReplace()
    return name


def overwrite_partitions(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    cluster: bool = True,
) -> str:
    """Replaces only the partitions present in ``df``; the others stay."""
    spark = df.sparkSession
    data = clustered(df, partition_cols) if cluster else df
    if fmt in V1_FORMATS:
        # insertInto is positional: order columns as the table declares them
        table_cols = spark.table(name).columns
        ordered = data.select(*table_cols)
        with _OVERWRITE_LOCK, session_conf(spark, _OVERWRITE_MODE, "dynamic"):
            ordered.write.insertInto(name, overwrite=True)
    else:
        data.writeTo(name).overwritePartitions()
    return name


def write_partitioned(
    df: DataFrame,
    name: str,
    partition_cols: Sequence[str] = (),
    fmt: str = "parquet",
    cluster: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """Creates the table on first use (with ``options`` as table
    properties), else overwrites the partitions in ``df``; re-running with
    the same input is idempotent."""
    spark = df.sparkSession
    if table_exists(spark, name):
        return overwrite_partitions(df, name, partition_cols, fmt, cluster)
    return create_table(df, name, partition_cols, fmt, cluster, options)


def write_partitioned_path(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    fmt: str = "parquet",
    cluster: bool = True,
    options: dict[str, str] | None = None,
) -> str:
    """Path form (no catalog): dynamic partition overwrite into ``path``."""
    data = clustered(df, partition_cols) if cluster else df
    (
        data.write.format(fmt)
        .options(**(options or {}))
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*partition_cols)
        .save(path)
    )
    return path


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Deletes a folder of any Hadoop file system; False where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``SHOW TABLES [IN db]`` as a DataFrame (namespace, tableName, isTemporary)."""
    if database:
        return spark.sql(f"SHOW TABLES IN {_quote(database)}")
    return spark.sql("SHOW TABLES")


def list_databases(spark: SparkSession, current: str | None = None) -> DataFrame:
    """``SHOW DATABASES`` plus ``is_current`` (the given or the session's)."""
    current = current or spark.catalog.currentDatabase()
    dbs = spark.sql("SHOW DATABASES")
    name = dbs.columns[0]
    return dbs.select(
        F.col(name).alias("database"), (F.col(name) == F.lit(current)).alias("is_current")
    )


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """``DESCRIBE FORMATTED`` (col_name, data_type, comment)."""
    return spark.sql(f"DESCRIBE FORMATTED {quoted_name(name)}")
