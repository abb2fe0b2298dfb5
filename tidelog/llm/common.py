"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import configure_session, scratch_path

#: Stands for a null identifier; sorts before every other one.
NULL_ID = -(2**63)
#: Rows of an Arrow batch.
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Prepares a session for the operators: rows reach Python workers in small
    batches, since texts can be long, and the workers can import this package."""
    configure_session(spark, "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_tidelog_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidelog-")) / "tidelog-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidelog_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    This cuts the lineage: after a lost executor Spark goes back to the
    written files, not to the input.  It also gives the planner a true size.
    """
    return written(df, label)[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``materialise``, with the folder."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with swept_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a folder of ``written`` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def swept_shuffles(spark: SparkSession):
    """Queries made and run within this block delete their shuffle files when
    they end.  Otherwise these stay until the driver collects its garbage, so
    that the steps of an operator add up on disk."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def pinned_splits(spark: SparkSession):
    """Scans planned within this block cut a file at the same places each.

    Spark takes the size of splits from the cores that are registered when a
    job is planned, unless the least number of partitions is set.
    """
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    spark.conf.set(key, before or cores or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def id_or_null(col: str = "doc_id") -> Column:
    """The identifier, with a fixed number in place of null."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def null_id_back(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c != NULL_ID, c)
