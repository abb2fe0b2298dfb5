"""Operator 6: quality rules judged by host.

Every document is tested against a few text rules.  Failures are counted by
host (the ``source`` column), the hosts' failure rates are shrunk towards a
beta prior that is fitted to all hosts, and the hosts' verdicts go back to
their documents.  A host is judged by its place against that prior: it is
rejected if its shrunk rate lies ``PRIOR_DEVIATIONS`` standard deviations
above the prior's mean and is ``TIMES_MEAN`` times as high, or in any case
above ``MAX_HOST_RATE``.  A document is kept if it passes the base rules
itself and its host is not rejected.

Everything here is DataFrame code without Python workers.  The measures are
taken within each row, so no text is shuffled; a host with a third of all
rows is one key of a map-side combined count.

Defined cases: a null text has no words; a null host is a host of its own;
repeated rows count as often as they occur; an empty table gives an empty
result.  Only the named columns are read, so further columns may have any
name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialise, prepare, table

SPACES = "[ \\t-\\r]+"
TRIMMED = " \t\n\x0b\x0c\r"
NOT_SYMBOLS = "[^#*$%&|<>]+"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Further rules that count against a host, in percent.
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: A host is rejected when its shrunk failure rate is above this, or that far
#: above the prior's mean in the prior's standard deviations and as a multiple.
MAX_HOST_RATE = 0.8
PRIOR_DEVIATIONS, TIMES_MEAN = 3.0, 2.0
#: Bounds of the prior's weight, in documents.
PRIOR_MIN, PRIOR_MAX = 1.0, 1000.0


def _has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(TRIMMED)) != ""


def document_measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, a hash of the text and the measures of every whole text."""
    keys = ["doc_id", "host", "text_hash"]
    text = F.coalesce("text", F.lit(""))
    d = docs.select(
        "doc_id", F.col("source").alias("host"), F.xxhash64(text).alias("text_hash"), text.alias("t")
    )
    d = d.select(
        *keys,
        F.filter(F.split("t", SPACES), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), _has_word).alias("lines"),
        F.length(F.regexp_replace("t", NOT_SYMBOLS, "")).cast("long").alias("n_symbols"),
    )
    n = F.size("words")
    d = d.select(
        *keys,
        "n_symbols",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            n >= 3,
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.xxhash64(
                    F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)
                ),
            ),
        ).alias("windows"),
    )
    # windows in order of their hash, where any occurs again; equal ones are neighbours then
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    d = d.withColumn(
        "ordered",
        F.when(
            again,
            F.array_sort(
                F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
            ),
        ),
    ).drop("windows")
    d = d.withColumn(
        "repeated",
        F.filter(
            "ordered",
            lambda x, k: (F.get("ordered", k - 1)["h"] == x["h"])
            | (F.get("ordered", k + 1)["h"] == x["h"]),
        ),
    ).drop("ordered")
    covered = F.array_distinct(
        F.flatten(F.transform("repeated", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    )
    return d.withColumn(
        "n_repeat_words", F.coalesce(F.size(covered).cast("long"), F.lit(0).cast("long"))
    ).drop("repeated")


def with_rules(measures: DataFrame) -> DataFrame:
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    more = (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")
    )
    return measures.withColumn("base_failed", base).withColumn("any_failed", base | more)


def host_verdicts(rules: DataFrame) -> DataFrame:
    """Per host: n_docs, n_failed, the shrunk rate and whether it is rejected.

    The prior is a beta distribution with the mean and variance of the hosts'
    rates.  Only those two numbers reach the driver.
    """
    hosts = rules.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("any_failed").cast("long")).alias("n_failed"),
    )
    rate = F.col("n_failed") / F.col("n_docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, var = mean or 0.0, var or 0.0
    weight = PRIOR_MAX if var <= 1e-12 else mean * (1 - mean) / var - 1
    weight = min(max(weight, PRIOR_MIN), PRIOR_MAX)
    shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    limit = min(MAX_HOST_RATE, max(mean + PRIOR_DEVIATIONS * var**0.5, TIMES_MEAN * mean))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", F.col("host_rate") > limit)


def host_quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict per row of ``docs``: doc_id, host, n_words,
    word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
    host_rate, kept."""
    rules = materialise(with_rules(document_measures(docs)), "host-quality")
    hosts = host_verdicts(rules).withColumnRenamed("host", "judged_host")
    judged = rules.join(hosts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
    return judged.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "host_rate",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
    )


QUERY_COLUMNS = (
    "doc_id",
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
)

ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, source, t,
         regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), x AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM x
), p AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM g, (VALUES (0), (1), (2)) AS o(k) WHERE n >= 2 GROUP BY doc_id
), m AS (
  SELECT w.doc_id, w.source, len(words) AS n_words, len(list_distinct(lines)) AS n_distinct, len(lines) AS n_lines,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(p.n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN p USING (doc_id)
), r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS more_failed
  FROM m
), h AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed OR more_failed AS BIGINT)) AS f FROM r GROUP BY source
), s AS (
  SELECT avg(f / n) AS mean, var_pop(f / n) AS v FROM h
), q AS (
  SELECT mean, least(0.8, greatest(mean + 3.0 * sqrt(v), 2.0 * mean)) AS top,
         least(greatest(CASE WHEN v <= 1e-12 THEN 1000.0 ELSE mean * (1 - mean) / v - 1 END, 1.0), 1000.0) AS k FROM s
), j AS (
  SELECT source, (f + mean * k) / (n + k) > top AS rejected FROM h, q
)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT j.rejected AS kept
FROM r JOIN j ON r.source IS NOT DISTINCT FROM j.source
"""


def query(spark, sf_dir):
    return host_quality(table(spark, sf_dir, "documents")).select(*QUERY_COLUMNS)


def stage(spark, docs, sf_dir):
    """Pipeline stage: the documents that are kept, unchanged.

    The verdicts are written and joined with the documents by identifier,
    text and host; equal rows have one verdict.
    """
    prepare(spark)
    rules = with_rules(document_measures(docs))
    rules = materialise(rules.select("doc_id", "host", "text_hash", "base_failed", "any_failed"), "rules")
    rejected = host_verdicts(rules).where("host_rejected").select(F.col("host").alias("judged_host"))
    passed = rules.where(~F.col("base_failed")).join(
        rejected, F.col("host").eqNullSafe(F.col("judged_host")), "left_anti"
    )
    kept = passed.select(
        F.col("doc_id").alias("hq_id"), F.col("host").alias("hq_host"), F.col("text_hash").alias("hq_text")
    ).distinct()
    same = (
        F.col("doc_id").eqNullSafe(F.col("hq_id"))
        & F.col("source").eqNullSafe(F.col("hq_host"))
        & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("hq_text"))
    )
    # the texts are shuffled at any size, so that the plan doesn't depend on it
    return docs.join(materialise(kept, "kept").hint("merge"), same, "left_semi")
