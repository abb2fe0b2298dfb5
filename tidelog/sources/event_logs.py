"""Access-log lines derived from the ``events`` table.

The driver's test data has no raw log text, so lines are rendered from
``events`` with one Spark projection (no Python per row); the work grows with
the table.  The rendering rules are the test-data contract:

``<ip> - - [<time>] "<method> <endpoint> HTTP/1.1" <status> <bytes> "-" "<agent>"``

* every 97th ``event_id`` becomes the malformed line ``corrupt line <id>``;
* every 10th ``event_id`` writes its time in the ``+0530`` zone;
* the agent is picked by ``user_id % 6``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: test-data rendering rules --------------------------------
CORRUPT_EVERY = 97
SHIFTED_EVERY = 10
SHIFT = "INTERVAL '05:30' HOUR TO MINUTE"
SHIFTED_ZONE = "+0530"
UTC_ZONE = "+0000"
POST_EVENTS = ("signup", "purchase")
STATUS_BY_EVENT = (("error", 500), ("signup", 201))
DEFAULT_STATUS = 200
USER_AGENTS = (
    "Mozilla/5.0 (iPhone) Mobile/15E148",
    "Mozilla/5.0 (X11; Linux x86_64)",
    "Mozilla/5.0 (Linux; Android 13; SM-X700)",
    "Mozilla/5.0 (iPad; CPU OS 12_0)",
    "Mozilla/5.0 (Windows Phone 8.0)",
    "",
)
# --- end of fixed values ----------------------------------------------------


def _ip(user_id: Column) -> Column:
    return F.concat_ws(
        ".", F.lit("10"), F.lit("0"), (user_id / 256).cast("bigint"), F.pmod(user_id, F.lit(256))
    )


def _time_text(event_id: Column, ts: Column) -> Column:
    shifted = F.pmod(event_id, F.lit(SHIFTED_EVERY)) == 0
    local = F.when(shifted, ts + F.expr(SHIFT)).otherwise(ts)
    zone = F.when(shifted, F.lit(SHIFTED_ZONE)).otherwise(F.lit(UTC_ZONE))
    return F.concat(F.date_format(local, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" "), zone)


def _status(event_type: Column) -> Column:
    expr = None
    for name, code in STATUS_BY_EVENT:
        expr = (F.when if expr is None else expr.when)(event_type == name, F.lit(code))
    return expr.otherwise(F.lit(DEFAULT_STATUS))


def log_line(
    event_id: Column, ts: Column, user_id: Column, event_type: Column, value: Column, props: Column
) -> Column:
    agents = F.array(*[F.lit(a) for a in USER_AGENTS])
    agent = F.element_at(agents, (F.pmod(user_id, F.lit(len(USER_AGENTS))) + 1).cast("int"))
    method = F.when(event_type.isin(*POST_EVENTS), F.lit("POST")).otherwise(F.lit("GET"))
    endpoint = F.concat(F.lit("/"), event_type, F.lit("?k="), F.get_json_object(props, "$.k"))
    size = F.floor(value * 100).cast("bigint")
    line = F.format_string(
        '%s - - [%s] "%s %s HTTP/1.1" %d %d "-" "%s"',
        _ip(user_id),
        _time_text(event_id, ts),
        method,
        endpoint,
        _status(event_type),
        size,
        agent,
    )
    corrupt = F.pmod(event_id, F.lit(CORRUPT_EVERY)) == 0
    return F.when(corrupt, F.concat(F.lit("corrupt line "), event_id.cast("string"))).otherwise(
        line
    )


def lines_from_events(events: DataFrame, keep_id: bool = True) -> DataFrame:
    """``events`` -> ``(event_id, value)`` log lines (``value`` only if not ``keep_id``)."""
    line = log_line(
        F.col("event_id"),
        F.col("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        F.col("props"),
    ).alias("value")
    return events.select("event_id", line) if keep_id else events.select(line)


def read_events(spark, sf_dir: str) -> DataFrame:
    """The ``events`` table, spread over the cluster's cores when the file
    has fewer splits than that (rendering and parsing are per-row work)."""
    from tidelog.operators.layout import spread

    return spread(spark.read.parquet(f"{sf_dir}/events.parquet"))


def write_lines(lines: DataFrame, path: str, compression: str | None = None) -> str:
    """Writes the ``value`` column as text files (one line per row)."""
    writer = lines.select("value").write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path
