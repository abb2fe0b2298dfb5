"""Operator 8: removal of repeated runs of lines by winnowing.

A document is the sequence of its lines that hold a word.  Every window of
``MIN_RUN`` lines selects its smallest line hash (the rightmost of equals) as
a fingerprint, so two equal windows always select the same line of theirs.
Only the selected lines become rows: each with the run of lines that the
windows which chose it cover, and hashes of its neighbours to the left and to
the right in that run.

Positions are joined by fingerprint.  Those whose runs agree as a whole are
one class, and all but its first are removed with their run.  The classes'
first positions are matched by extending them from the fingerprint: both
lines to the right, one to each side, both to the left.  What agrees with an
earlier position so far is removed, so that overlapping pieces make up the
longest repeated runs, a line being removed when it lies in a window that
starts earlier too (smaller doc_id, or earlier in the same document).

A passage can be long on one or two lines.  With ``long_words`` (the query and
the pipeline's stage) windows of one and two lines that hold more words than
that are compared too, their first line being the fingerprint, and documents
of fewer than ``MIN_RUN`` lines with fewer words as a whole among each other.

Everything is DataFrame code without Python workers.  No group is gathered
and no pairs are made: first positions come from map-side combined minima,
and joins on a hot line are split by adaptive execution.  A fingerprint is
128 bits, its neighbours are told apart by 64 bits among equal fingerprints.

Defined cases: a null text stays null and has no lines; lines without a word
are neither compared nor removed; rows with equal doc_id and text are one
document (each is returned); a null doc_id comes before all others; an empty
table gives an empty result.  Other columns are returned as they are, whatever
their names; ``drop_repeated_lines`` replaces those named lr_lines and
lr_removed by its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import id_or_null, materialise, prepare, table
from tidelog.llm.host_quality import TRIMMED

#: Lines of a window, and the shortest run of lines that is removed.
MIN_RUN = 3
#: Shorter runs are removed where they hold more words than this.
LONG_WORDS = 50


def _hashed(docs: DataFrame, long_words: int | None) -> DataFrame:
    """k_id, k_text, and h: two hashes (and the words) of each line with a word."""
    d = docs.select(
        id_or_null().alias("k_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("k_text"),
        F.split(F.coalesce("text", F.lit("")), "\n").alias("raw"),
    )
    d = d.select(
        "k_id", "k_text", F.filter("raw", lambda s: F.btrim(s, F.lit(TRIMMED)) != "").alias("lines")
    ).where(F.size("lines") >= (MIN_RUN if long_words is None else 1))

    def hashes(s):
        h = [F.xxhash64(s).alias("a"), F.xxhash64(F.lit(1), s).alias("b")]
        if long_words is not None:
            h.append(F.size(F.split(F.btrim(s, F.lit(TRIMMED)), f"[{TRIMMED}]+")).alias("words"))
        return F.struct(*h)

    return d.select("k_id", "k_text", F.transform("lines", hashes).alias("h"))


def _up_to(n):
    """0, 1, ... n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _print(kind, at, start, end, left=(None, None), right=(None, None)):
    """A fingerprint at line ``at`` of the lines from ``start`` and before ``end``."""
    no = F.lit(None).cast("long")
    sides = dict(zip(("left1", "left2", "right1", "right2"), (*left, *right)))
    return F.struct(
        F.lit(kind).alias("kind"),
        at.alias("at"),
        start.alias("start"),
        end.alias("end"),
        F.get("h", at)["a"].alias("a"),
        F.get("h", at)["b"].alias("b"),
        *[(no if c is None else c).alias(name) for name, c in sides.items()],
    )


def fingerprints(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """One row per selected line: k_id, k_text, kind (0 for windows of
    ``MIN_RUN`` lines), its number ``at`` among the lines with a word, the run
    from ``start`` before ``end`` that its windows cover, its hashes a and b,
    and those of one and two neighbours within the run on either side."""
    d = _hashed(docs, long_words)
    line = lambda i: F.get("h", i)
    n = F.size("h")

    def chosen(j):
        """The rightmost line of the smallest hash."""
        lines = [line(j + i)["a"] for i in range(MIN_RUN)]
        low = F.least(*lines)
        return F.greatest(*[F.when(x == low, j + i) for i, x in enumerate(lines)])

    d = d.withColumn("w", F.transform(_up_to(n - (MIN_RUN - 1)), chosen))
    # windows with one choice are neighbours, as no choice lies before an earlier one
    d = d.withColumn(
        "heads",
        F.filter(_up_to(F.size("w")), lambda j: (j == 0) | (F.get("w", j) != F.get("w", j - 1))),
    )

    def selected(start, i):
        at = F.get("w", start)
        end = F.coalesce(F.get("heads", i + 1), F.size("w")) + (MIN_RUN - 1)
        b = lambda i: line(i)["b"]
        left = F.when(at - 1 >= start, b(at - 1)), F.when(at - 2 >= start, F.xxhash64(b(at - 2), b(at - 1)))
        right = F.when(at + 1 < end, b(at + 1)), F.when(at + 2 < end, F.xxhash64(b(at + 1), b(at + 2)))
        return _print(0, at, start, end, left, right)

    rows = F.transform("heads", selected)
    if long_words is not None:

        def long(j):
            second = j + 1
            both = line(j)["words"] + line(second)["words"]
            one, two = _print(1, j, j, j + 1), _print(2, j, j, j + 2, right=(line(second)["b"], None))
            # the text of a short document is one window of its own kind
            whole_one = _print(3, j, j, j + 1)
            whole_two = _print(4, j, j, j + 2, right=(line(second)["b"], None))
            return F.array(
                F.when(line(j)["words"] > long_words, one),
                F.when((second < n) & (both > long_words), two),
                F.when((n == 1) & (line(j)["words"] <= long_words), whole_one),
                F.when((j == 0) & (n == 2) & (both <= long_words), whole_two),
            )

        few = F.filter(F.flatten(F.transform(_up_to(n), long)), lambda x: x.isNotNull())
        rows = F.concat(rows, few)
    return d.select("k_id", "k_text", F.explode(rows).alias("p")).select("k_id", "k_text", "p.*")


def repeated_runs(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """Runs of lines whose windows all start earlier too: k_id, k_text, start, size."""
    prints = materialise(fingerprints(docs, long_words), "line-prints")
    place = F.struct("k_id", "k_text", "at")
    shared = (
        prints.groupBy("a", "b")
        .agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("a", "b")
    )
    sides = ["left1", "left2", "right1", "right2"]
    shape = F.xxhash64("kind", F.col("at") - F.col("start"), F.col("end") - F.col("at"), *sides)
    joined = prints.join(shared, ["a", "b"], "left_semi").withColumn("x", shape)
    classes = materialise(
        joined.groupBy("a", "b", "x").agg(
            F.min(place).alias("first"),
            F.max(place).alias("last"),
            *[F.min(c).alias(c) for c in ("kind", *sides)],
        ),
        "line-classes",
    )
    several = classes.where(F.col("first") != F.col("last")).select("a", "b", "x", "first")
    whole = (
        joined.join(several, ["a", "b", "x"])
        .where(place > F.col("first"))
        .select("k_id", "k_text", "start", (F.col("end") - F.col("start")).alias("size"))
    )
    return whole.unionByName(_extended(classes.where("kind = 0")))


def _extended(classes: DataFrame) -> DataFrame:
    """Windows of the classes' first positions that agree with an earlier one
    of the same fingerprint, extended over MIN_RUN - 1 lines in all."""
    mixed = (
        classes.groupBy("a", "b")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .where(F.col("lo") != F.col("hi"))
        .select("a", "b")
    )
    ways = F.array(
        F.struct(F.lit(0).alias("back"), F.col("right2").alias("e")),
        F.struct(
            F.lit(1).alias("back"),
            F.when(F.col("left1").isNotNull() & F.col("right1").isNotNull(), F.xxhash64("left1", "right1")).alias("e"),
        ),
        F.struct(F.lit(2).alias("back"), F.col("left2").alias("e")),
    )
    windows = (
        classes.join(mixed, ["a", "b"], "left_semi")
        .select("a", "b", "first", F.explode(ways).alias("way"))
        .select("a", "b", "way.back", "way.e", "first")
        .where(F.col("e").isNotNull())
    )
    windows = materialise(windows, "line-extensions")
    key = ["a", "b", "back", "e"]
    earliest = (
        windows.groupBy(*key)
        .agg(F.min("first").alias("least"), F.max("first").alias("most"))
        .where(F.col("least") != F.col("most"))
        .select(*key, "least")
    )
    late = windows.join(earliest, key).where(F.col("first") > F.col("least"))
    return late.select(
        "first.k_id", "first.k_text", (F.col("first.at") - F.col("back")).alias("start"), F.lit(MIN_RUN).alias("size")
    )


def removed_lines(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """Per document with removed lines: k_id, k_text, and the removed runs'
    first lines' numbers among its lines with a word, with their sizes (sorted)."""
    runs = repeated_runs(docs, long_words)
    return runs.groupBy("k_id", "k_text").agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("starts")
    )


def _shortened(docs: DataFrame, long_words: int | None) -> DataFrame:
    """``row`` (all columns of ``docs``, the text shortened; unchanged where
    nothing goes), ``lines`` (with a word) and ``removed``."""
    gone = materialise(removed_lines(docs, long_words), "line-runs").withColumnsRenamed(
        {"k_id": "g_id", "k_text": "g_text"}
    )
    left = docs.select(
        F.struct(*docs.columns).alias("row"),
        id_or_null().alias("k_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("k_text"),
    )
    # the texts are shuffled at any size, so that the plan doesn't depend on it
    same = (F.col("k_id") == F.col("g_id")) & (F.col("k_text") == F.col("g_text"))
    both = left.join(gone.hint("merge"), same, "left").withColumn("raw", F.split("row.text", "\n"))
    # number of each line among those with a word; others get none
    both = both.withColumn(
        "worded",
        F.filter(
            F.transform("raw", lambda s, i: F.when(F.btrim(s, F.lit(TRIMMED)) != "", i)),
            lambda i: i.isNotNull(),
        ),
    )
    cut = F.array_distinct(
        F.flatten(
            F.transform(
                "starts",
                lambda s: F.transform(_up_to(s["size"]), lambda o: F.get("worded", s["start"] + o)),
            )
        )
    )
    both = both.withColumn("cut", cut)
    # the numbers of lines that stay, by a set difference within the row
    stay = F.transform(F.array_except(_up_to(F.size("raw")), F.col("cut")), lambda i: F.get("raw", i))
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(F.array_join(stay, "\n"))
    return both.select(
        F.col("row").withField("text", text).alias("row"),
        F.coalesce(F.size("worded"), F.lit(0)).cast("long").alias("lines"),
        F.coalesce(F.size("cut"), F.lit(0)).cast("long").alias("removed"),
    )


def drop_repeated_lines(docs: DataFrame, long_words: int | None = None) -> DataFrame:
    """``docs`` with shortened texts, plus ``lr_lines`` (lines with a word)
    and ``lr_removed``; a text is returned unchanged where nothing goes."""
    own = docs.drop("lr_lines", "lr_removed")
    out = _shortened(own, long_words).withColumnsRenamed({"lines": "lr_lines", "removed": "lr_removed"})
    return out.select("row.*", "lr_lines", "lr_removed")


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_repeated_lines(docs, LONG_WORDS).select(
        "doc_id",
        F.col("lr_lines").alias("n_lines"),
        F.col("lr_removed").alias("n_removed_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def stage(spark, docs, sf_dir):
    """Pipeline stage: documents without later repeated runs of lines; one
    that loses every line with a word goes."""
    prepare(spark)
    out = _shortened(docs, LONG_WORDS)
    return out.where((F.col("removed") == 0) | (F.col("removed") < F.col("lines"))).select("row.*")


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS raw_no
  FROM documents
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw_no) AS no,
         count(*) OVER (PARTITION BY doc_id) AS lines,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), w AS (
  SELECT doc_id, no, lines, words, line, lead(line, 1) OVER d AS line2, lead(line, 2) OVER d AS line3,
         words + lead(words, 1) OVER d AS words2
  FROM n WINDOW d AS (PARTITION BY doc_id ORDER BY no)
), v AS (
  SELECT doc_id, no, 3 AS size, 'lines' AS kind, line, line2, line3 FROM w WHERE line3 IS NOT NULL
  UNION ALL
  SELECT doc_id, no, 1, 'long', line, '', '' FROM w WHERE words > 50
  UNION ALL
  SELECT doc_id, no, 2, 'long', line, line2, '' FROM w WHERE words2 > 50
  UNION ALL
  SELECT doc_id, no, 1, 'whole', line, '', '' FROM w WHERE lines = 1 AND words <= 50
  UNION ALL
  SELECT doc_id, no, 2, 'whole', line, line2, '' FROM w WHERE lines = 2 AND words2 <= 50
), r AS (
  SELECT doc_id, no, size,
         row_number() OVER (PARTITION BY kind, size, line, line2, line3 ORDER BY doc_id, no) AS k
  FROM v
), c AS (
  SELECT DISTINCT doc_id, no + o AS no FROM r, (VALUES (0), (1), (2)) AS t(o) WHERE k > 1 AND o < size
), s AS (
  SELECT l.doc_id, l.raw_no, l.line, n.no, c.no IS NOT NULL AS gone
  FROM l LEFT JOIN n ON l.doc_id = n.doc_id AND l.raw_no = n.raw_no
         LEFT JOIN c ON n.doc_id = c.doc_id AND n.no = c.no
)
SELECT doc_id, count(no) AS n_lines, count(*) FILTER (gone) AS n_removed_lines,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY raw_no) FILTER (NOT gone), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""
