"""Operator 2: WARC archives, read back by boundary-chain verification.

Writing: every page becomes a record, written by Spark's text writer with the
end of a record as line separator.  Of pages with equal payloads (of
``MIN_REVISIT`` bytes or more) the one with the smallest page_id is the
response; the others are revisits without payload that refer to it.

Reading: the archives are split at every occurrence of the magic ``WARC/1.``,
whether it begins a record or lies inside a payload.  Each split's task adds
up the sizes of its chunks, so that running sums of the splits' totals give
every chunk its offset, and emits candidates with the offset of the record
that would follow.  Within a split, chains are followed to the first offset
outside; across splits, pointer jumping from the start of each file doubles
the reach in every round.  Only candidates on a chain from the start are
records, and the run ends with an error unless the chain of every file ends
exactly at the file's end, so that no record is lost without a word.  A
header that holds the magic is read over the chunks of its split (the writer
writes the magic of a url as ``WARC%2F1.``).  Where a payload holds the magic, its chunks are fetched in a second
scan with the same splits (``pinned_splits``) and put together; the run ends
if they don't fill the record that the first scan saw.

Defined cases: a null html is an empty payload; a null page_id is written as
such and refers to the smallest known page_id of its payload, and is a
response where there is none; equal rows are written as often as they occur
(those with the smallest page_id are responses); line ends in a url are
written as blanks; an empty table gives no record; a file that is cut off or
that doesn't begin with a record is an error.  Only page_id, url and
html are read.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialise, pinned_splits, table
from tidelog.session import scratch_path

#: Fixed values of the format.
MAGIC, END = "WARC/1.", "\r\n\r\n"
ESCAPED_MAGIC = "WARC%2F1."
HEX_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: A chunk that may be the beginning of a header which goes on behind another magic.
OPEN_HEADER = re.compile(rb"[01]\r\n(?:[A-Za-z-]+: [^\r\n]*\r\n)*[A-Za-z-]+: [^\r\n]*\Z")

#: Equal payloads of at least so many bytes become revisits.
MIN_REVISIT = 0

CANDIDATE = (
    "path string, block long, rel long, size long, next_rel long, page_id long, type string, "
    "refers_to long, header_size long, payload_bytes long, payload_digest string, whole boolean"
)


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: five hexadecimal digits make four of base32."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), HEX_DIGITS, BASE32_DIGITS)


def _digested(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n"),
        base32_sha1(payload.cast("binary")).alias("digest"),
    )


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages that are revisits."""
    d = materialise(
        _digested(pages).where(F.col("n") >= MIN_REVISIT).select("page_id", "digest"), "digests"
    )
    first = (
        d.groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("times"))
        .where((F.col("times") > 1) & F.col("refers_to").isNotNull())
        .select("digest", "refers_to")
    )
    again = d.join(first.hint("merge"), "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return again.distinct()


def write_warc(pages: DataFrame, folder: str) -> None:
    """Writes the archives; each task writes a file."""
    # written first: its true size lets the planner send it to the pages where it is small
    again = materialise(revisits(pages), "revisits").select(
        F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to"
    )
    d = _digested(pages).join(
        again,
        F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")),
        "left",
    )
    revisit = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " ")
    url = F.replace(url, F.lit(MAGIC), F.lit(ESCAPED_MAGIC))
    record = F.concat(
        F.lit(f"{MAGIC}1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(""),
        line("X-Payload-Length", F.col("n").cast("string")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("n").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    d.select(record.alias("value")).write.option("lineSep", END).text(folder)


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    """What lies between occurrences of the magic, in the order of the file within a split."""
    lines = spark.read.option("lineSep", MAGIC).text(folder)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("chunk"),
    )


def _located(batches):
    """Chunks with their place relative to the first one of their split."""
    seen: dict[tuple, int] = {}
    for b in batches:
        for path, block, chunk in zip(*(b.column(k).to_pylist() for k in ("path", "block", "chunk"))):
            rel = seen.get((path, block), 0)
            seen[path, block] = rel + len(chunk) + len(MAGIC)
            yield path, block, rel, chunk


def _with_headers(items):
    """Chunks of splits, each with those that its header goes on in."""
    waiting: list[tuple] = []
    for path, block, rel, chunk in items:
        if waiting and waiting[0][:2] != (path, block):
            yield from waiting
            waiting = []
        for w in waiting:
            w[4].append(chunk)
        closed = END.encode() in chunk
        if closed:
            yield from waiting
            waiting = []
        if not closed and OPEN_HEADER.match(chunk):
            waiting.append((path, block, rel, chunk, []))
        else:
            yield path, block, rel, chunk, []
    yield from waiting


def _urn(text: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(m[1]) if m else None


def parse_candidate(path, block, rel, chunk: bytes, more=()) -> tuple:
    """The candidate record that a chunk begins, if its header can be read;
    ``more``: the chunks in which the header goes on."""
    head, end, _ = MAGIC.encode().join([chunk, *more]).partition(END.encode())
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    length = fields.get("Content-Length", "")
    if not end or lines[0] not in ("0", "1") or not re.fullmatch(r"[0-9]{1,18}", length):
        return (path, block, rel, len(chunk), None, None, None, None, None, None, None, False)
    header = len(head) + len(END)
    stop = header + int(length)
    kind = fields.get("WARC-Type")
    whole = not more and stop + len(END) == len(chunk)
    n = digest = None
    if kind == "revisit":
        n, digest = int(fields.get("X-Payload-Length", 0)), fields.get("WARC-Payload-Digest", "")[5:]
    elif whole:
        n, digest = payload_facts(chunk[header:stop])
    ids = _urn(fields.get("WARC-Record-ID")), kind, _urn(fields.get("WARC-Refers-To"))
    return (path, block, rel, len(chunk), rel + stop + len(END), *ids, header, n, digest, whole)


def payload_facts(payload: bytes) -> tuple[int, str]:
    return len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Every chunk with its offset (``at``: that of its magic) and, if it
    reads as a record, the offset ``next`` of the one that would follow."""

    def parse(batches):
        rows = []
        kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), *[pa.int64()] * 3, pa.string(), pa.bool_()]
        names = [x.split()[0] for x in CANDIDATE.split(", ")]
        for item in _with_headers(_located(batches)):
            rows.append(parse_candidate(*item))
            if len(rows) == 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    found = materialise(_chunks(spark, folder).mapInArrow(parse, CANDIDATE), "candidates")
    sums = found.groupBy("path", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("path", "block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = found.join(materialise(bases, "split-bases"), ["path", "block"])
    return placed.withColumn("at", F.col("base") + F.col("rel") - len(MAGIC)).withColumn(
        "next", F.col("base") + F.col("next_rel")
    )


def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, where its chain leaves the split."""
    rows = rows.sort_values("at", ascending=False)
    known: dict[int, int] = {}
    for at, nxt in zip(rows["at"], rows["next"]):
        known[at] = known.get(nxt, nxt)
    return pd.DataFrame({"path": rows["path"], "block": rows["block"], "at": rows["at"], "leaves": list(known.values())})


def entries(nodes: DataFrame) -> DataFrame:
    """path and at of the candidates at which chains from the files' starts
    enter a split.  ``nodes``: path, block, at, next."""
    exits = materialise(
        nodes.groupBy("path", "block").applyInPandas(_exits, "path string, block long, at long, leaves long"),
        "exits",
    )
    reached = materialise(exits.where(F.col("at") == 0).select("path", "at"), "reached")
    targets = exits.select("path", F.col("leaves").alias("at")).unionByName(reached).distinct()
    # tables of offsets compress to little, so their files' sizes would call for a broadcast
    jump = exits.join(targets.hint("merge"), ["path", "at"]).select("path", "at", "leaves")
    jump = materialise(jump, "jump")
    every, n = jump.select("path", "at"), reached.count()
    while True:
        ahead = reached.join(jump.hint("merge"), ["path", "at"])
        ahead = ahead.select("path", F.col("leaves").alias("at"))
        known = ahead.join(every.hint("merge"), ["path", "at"], "left_semi")
        grown = materialise(reached.unionByName(known).distinct(), "reached")
        if (more := grown.count()) == n:
            return grown
        onward = jump.select("path", F.col("at").alias("leaves"), F.col("leaves").alias("far"))
        doubled = jump.join(onward.hint("merge"), ["path", "leaves"])
        doubled = doubled.select("path", "at", F.col("far").alias("leaves"))
        reached, jump, n = grown, materialise(doubled, "jump"), more


def _walk(rows: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a split on the chains from its entries."""
    follow, on = dict(zip(rows["at"], rows["next"])), set()
    for at in starts["at"]:
        while at in follow and at not in on:
            on.add(at)
            at = follow[at]
    return rows[rows["at"].isin(on)][["path", "block", "at"]]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record that a chain from the start of its file reaches."""
    with pinned_splits(spark):
        return _read_warc(spark, folder)


def _read_warc(spark: SparkSession, folder: str) -> DataFrame:
    every = materialise(candidates(spark, folder), "chunks")
    able = every.where((F.col("at") >= 0) & F.col("next").isNotNull())
    nodes = able.select("path", "block", "at", "next")
    starts = materialise(
        entries(nodes).join(nodes.hint("merge"), ["path", "at"]).select("path", "block", "at"), "starts"
    )
    on = (
        nodes.groupBy("path", "block")
        .cogroup(starts.groupBy("path", "block"))
        .applyInPandas(_walk, "path string, block long, at long")
    )
    on = materialise(on.select("path", "at"), "records")
    records = able.join(on.hint("merge"), ["path", "at"])
    check_ends(every, records)
    ready = records.where(F.col("whole") | (F.col("type") == "revisit"))
    facts = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"]
    broken = records.where(~F.col("whole") & (F.col("type") != "revisit"))
    if broken.isEmpty():
        return ready.select(*facts)
    return ready.select(*facts).unionByName(_put_together(spark, folder, every, broken, on))


def check_ends(every: DataFrame, records: DataFrame) -> None:
    """Raises unless the chain of every file ends at the file's end."""
    sizes = every.groupBy("path").agg((F.sum(F.col("size") + len(MAGIC)) - len(MAGIC)).alias("bytes"))
    ends = records.groupBy("path").agg(F.max("next").alias("end"))
    short = sizes.join(ends, "path", "left").where(~F.col("end").eqNullSafe(F.col("bytes"))).first()
    if short:
        raise ValueError(f"{short['path']}: records end at byte {short['end']} of {short['bytes']}")


def _put_together(spark, folder, every, broken, on) -> DataFrame:
    """Records whose payload holds the magic, from all of their chunks."""
    files = every.join(broken.select("path").distinct(), "path", "left_semi")
    owner = F.last(F.when(F.col("is_record"), F.col("at")), ignorenulls=True).over(
        Window.partitionBy("path").orderBy("at")
    )
    marked = files.join(on.withColumn("is_record", F.lit(True)), ["path", "at"], "left")
    ends = broken.select("path", F.col("at").alias("owner"), F.col("next").alias("end"))
    owned = (
        marked.select("path", "block", "rel", "at", owner.alias("owner"))
        .join(ends, ["path", "owner"])
        .where(F.col("at") < F.col("end"))
        .drop("end")
    )

    def located(batches):
        for path, block, rel, chunk in _located(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([block], pa.int64()), pa.array([rel], pa.int64()), pa.array([chunk], pa.binary())],
                ["path", "block", "rel", "chunk"],
            )

    texts = _chunks(spark, folder).mapInArrow(located, "path string, block long, rel long, chunk binary")
    pieces = texts.join(owned, ["path", "block", "rel"]).groupBy("path", "owner").agg(
        F.array_sort(F.collect_list(F.struct("at", "chunk"))).alias("parts")
    )

    @F.udf("struct<n:long,digest:string>")
    def facts_of(parts, at, header, size):
        stop = at + len(MAGIC) + header + size + len(END)
        reached = at
        for p in parts or ():
            if p["at"] != reached:
                break
            reached += len(MAGIC) + len(p["chunk"])
        if reached != stop:
            raise ValueError(f"record at {at}: chunks reach {reached}, the header states {stop}")
        raw = MAGIC.encode().join(bytes(p["chunk"]) for p in parts)
        return payload_facts(raw[header : header + size])

    size = F.col("next") - F.col("at") - len(MAGIC) - F.col("header_size") - len(END)
    found = broken.join(
        pieces.withColumnRenamed("owner", "at"), ["path", "at"], "left"
    ).withColumn("facts", facts_of("parts", "at", "header_size", size))
    found = found.select(
        "page_id",
        F.col("facts.n").alias("payload_bytes"),
        F.col("facts.digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )
    # read here, while the splits are pinned
    return materialise(found, "put-together")


def query(spark, sf_dir):
    folder = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    write_warc(pages, folder)
    found = materialise(read_warc(spark, folder), "warc-records")
    n, m = pages.count(), found.count()
    if n != m:
        raise RuntimeError(f"{m} records read of {n} written")
    return found


def oracle_sql() -> str:
    digits = " || ".join(
        f"substr('{BASE32_DIGITS}', 1 + ((('0x' || substr(h, {5 * i + 1}, 5))::INTEGER >> {15 - 5 * j}) & 31), 1)"
        for i in range(8)
        for j in range(4)
    )
    return f"""
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {digits} AS payload_digest,
       CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM f
"""
