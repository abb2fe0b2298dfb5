"""Device class from a user-agent string, as a native CASE expression.

The same ordered rule list builds both the DataFrame ``Column`` and a SQL
function (``CREATE TEMPORARY FUNCTION ... RETURN CASE ...``), which Catalyst
inlines: no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- fixed values: ordered (substring of the lower-cased agent, class) -----
# The first rule whose substring occurs wins; an agent matching none is
# Desktop and a NULL agent is Unknown.
DEVICE_RULES = (
    ("mobile", "Mobile"),
    ("tablet", "Tablet"),
    ("ipad", "Tablet"),
    ("android", "Tablet"),
    ("windows phone", "Mobile"),
)
DEFAULT_DEVICE = "Desktop"
NULL_DEVICE = "Unknown"
# --- end of fixed values ----------------------------------------------------

SQL_FUNCTION_NAME = "extract_device_type"


def device_of_lowered(lowered: Column | str) -> Column:
    """Device class of an already lower-cased agent (NULL stays Unknown)."""
    lowered = F.col(lowered) if isinstance(lowered, str) else lowered
    expr = F.when(lowered.isNull(), F.lit(NULL_DEVICE))
    for needle, label in DEVICE_RULES:
        expr = expr.when(lowered.contains(needle), F.lit(label))
    return expr.otherwise(F.lit(DEFAULT_DEVICE))


def device_type(user_agent: Column | str) -> Column:
    """Device class of a user-agent string.

    Spark does not share ``lower(agent)`` between CASE arms; a DataFrame
    operator that classifies many rows should project the lower-cased agent
    once and use ``device_of_lowered`` (as ``enrich_logs`` does).
    """
    ua = F.col(user_agent) if isinstance(user_agent, str) else user_agent
    return device_of_lowered(F.lower(ua))


def device_case_sql(arg: str) -> str:
    """The rule list as a SQL CASE over the string expression ``arg``."""
    arms = [f"WHEN {arg} IS NULL THEN '{NULL_DEVICE}'"]
    for needle, label in DEVICE_RULES:
        arms.append(f"WHEN contains(lower({arg}), '{needle}') THEN '{label}'")
    return "CASE " + " ".join(arms) + f" ELSE '{DEFAULT_DEVICE}' END"


def register_device_function(spark: SparkSession, name: str = SQL_FUNCTION_NAME) -> str:
    """Registers ``name(user_agent STRING) RETURNS STRING`` for SQL use."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(user_agent STRING) "
        f"RETURNS STRING RETURN {device_case_sql('user_agent')}"
    )
    return name
