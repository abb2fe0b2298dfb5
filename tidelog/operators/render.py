"""Result rendering: JSON / CSV rows and bounded previews.

Rendering stays distributed: ``to_json`` / ``to_csv`` run per row in the JVM
and the files are written by the executors.  A preview takes the first
``n`` rows of a total order (TakeOrderedAndProject keeps ``n`` rows per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows_as_json(df: DataFrame) -> DataFrame:
    """One ``json`` string column per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def rows_as_csv(df: DataFrame) -> DataFrame:
    """One ``csv`` string column per row (no header)."""
    return df.select(F.to_csv(F.struct(*df.columns)).alias("csv"))


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """First ``n`` rows; deterministic when ``order_by`` is a total order."""
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(n)
