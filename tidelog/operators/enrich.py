"""Enrichment projection: device class and ISO week."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from tidelog.functions.device import device_of_lowered
from tidelog.functions.periods import week_bucket

_LOWERED = "_user_agent_lower"


def enrich_logs(logs: DataFrame) -> DataFrame:
    """``raw_logs`` -> ``processed_logs``: adds ``device_type`` and ``week``.

    The agent is lower-cased once in its own projection (Catalyst keeps the
    two projections apart rather than repeat a non-trivial expression), and
    every device rule tests that one value.
    """
    lowered = logs.withColumn(_LOWERED, F.lower("user_agent"))
    return lowered.withColumns(
        {"device_type": device_of_lowered(_LOWERED), "week": week_bucket("timestamp")}
    ).drop(_LOWERED)
