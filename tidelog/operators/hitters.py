"""Heavy hitters: the keys with the most rows, from bounded summaries.

A frequent-items sketch keeps a fixed number of counters per group, however
many keys there are, and sketches merge: daily ones combine to weeks.  Its
estimate never is below the true count and exceeds it by at most
``error_share(tracked)`` of the rows, and no key above twice that share is
missing.  Tasks send one sketch each through the shuffle, where an exact
count sends every distinct key.

``heavy_hitters`` uses the sketch to name candidates and counts those alone,
so its result is exact.  NULL keys are counted beside the sketch, exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 1024
# Share of its slots that a frequent-items sketch fills, and its error in slots.
_LOAD, _ERROR_SLOTS = 0.75, 3.5


def _slots(tracked: int) -> int:
    return 1 << math.ceil(math.log2(math.ceil(tracked / _LOAD)))


def error_share(tracked: int = TRACKED) -> float:
    """Largest excess of an estimate, as a share of the rows."""
    return _ERROR_SLOTS / _slots(tracked)


def tracked_for(share: float) -> int:
    """Counters with which no key above ``share`` of the rows is missed."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    slots = 1 << math.ceil(math.log2(2 * _ERROR_SLOTS / share))
    return int(slots * _LOAD)


def _names(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def key_sketch(
    df: DataFrame, key: str, by: str | Sequence[str] = (), tracked: int = TRACKED
) -> DataFrame:
    """``(by..., sketch, rows, null_rows)``: a mergeable summary of the keys
    of each group; ``sketch`` is a struct that can be stored in a table."""
    by = _names(by)
    quoted = f"`{key}`"
    return df.groupBy(*by).agg(
        F.expr(f"approx_top_k_accumulate({quoted}, {int(tracked)})").alias("sketch"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("null_rows"),
    )


def merge_sketches(sketches: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Summaries of coarser groups, ``by`` columns of ``sketches``."""
    return sketches.groupBy(*_names(by)).agg(
        F.expr("approx_top_k_combine(sketch)").alias("sketch"),
        F.sum("rows").alias("rows"),
        F.sum("null_rows").alias("null_rows"),
    )


def frequent_keys(
    sketches: DataFrame, key: str = "key", by: str | Sequence[str] = (), tracked: int = TRACKED
) -> DataFrame:
    """``(by..., key, at_least, at_most, rows)`` of the keys a summary can
    tell from noise; the true count lies between the two, and every key with
    more than twice the error's share of ``rows`` is there."""
    by = _names(by)
    error = F.floor(F.col("rows") * F.lit(error_share(tracked)))
    items = F.expr(f"approx_top_k_estimate(sketch, {int(tracked)})")
    found = sketches.select(*by, "rows", error.alias("_error"), F.explode(items).alias("_i"))
    # whether NULL is among the items depends on the Spark version
    named = found.filter(F.col("_i.item").isNotNull()).select(
        *by,
        F.col("_i.item").alias(key),
        F.greatest(F.col("_i.count") - F.col("_error"), F.lit(1)).cast("bigint").alias("at_least"),
        F.col("_i.count").cast("bigint").alias("at_most"),
        "rows",
    )
    nulls = sketches.filter(F.col("null_rows") > 0).select(
        *by,
        F.lit(None).cast(named.schema[key].dataType).alias(key),
        F.col("null_rows").alias("at_least"),
        F.col("null_rows").alias("at_most"),
        "rows",
    )
    return named.unionByName(nulls)


def heavy_hitters(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """``(key, rows, share)`` of exactly the keys with more than ``share`` of
    all rows.

    The sketch is sized so that none of them is missed; its keys, fewer than
    ``tracked_for(share)``, are then counted in a second pass, which moves
    one row of each task and candidate.
    """
    tracked = tracked_for(share)
    summary = key_sketch(df, key, tracked=tracked)
    keys = frequent_keys(summary, "_key", tracked=tracked).select("_key", F.col("rows").alias("_total"))
    # bounded: no more candidates than the sketch has counters
    matched = df.select(key).join(F.broadcast(keys), F.col(key).eqNullSafe(F.col("_key")))
    counted = matched.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.first("_total").alias("_total")
    )
    part = F.col("rows") / F.col("_total")
    return counted.filter(part > F.lit(share)).select(key, "rows", F.round(part, 6).alias("share"))
