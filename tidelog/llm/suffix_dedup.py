"""Operator 10: removal of repeated strings of 100 bytes.

Every byte is removed that a string of ``WIDTH`` bytes covers which also
starts earlier (in a document with a smaller doc_id, or earlier in the same
one).

* Anchors: each window of WIDTH bytes selects the smallest hash of its
  ``GRAM``-byte strings (the rightmost of equals), so equal windows select
  the same place of theirs.  About one byte in 33 is an anchor; only those
  whose hash occurs again go on.
* Contexts: an anchor's context is what windows around it can cover.
  Occurrences with equal contexts form a class; all but its first are
  removed with their whole context.
* Column-wise construction: the first contexts of the classes of an anchor
  are put together, and a task builds the Burrows-Wheeler transform and
  common prefixes of its collections column by column, one symbol of every
  context a round (``column_bwt``).  The anchor counts as two symbols.
  Neighbours with a common prefix of WIDTH bytes are equal windows; all but
  the earliest are removed.

Collections are bounded: anchors with more than ``MOST`` different contexts
don't come together in one task.  Their windows are dealt by content and the
earliest of each is found by a map-side combined minimum.

The documents themselves are too long for a construction with a round for
every symbol (each round rewrites the whole transform); the contexts have at
most 2 * BEFORE + 2 symbols, and since a collection is bounded, its transform
is held in memory rather than in external files.

Anchors, contexts and windows in the hot case are told apart by 64-bit
hashes (two of them together).  Bit maps of a fixed size spare the shuffle
rows that can't matter; exact joins follow.

Defined cases: a null or empty text has no bytes and loses none; rows with
equal doc_id and text are one document (each is returned), those with one
doc_id and different texts come in the order of a 32-bit hash of the text; a null
doc_id comes first; an empty table gives an empty result.  Further columns
are returned as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.column_bwt import equal_windows
from tidelog.llm.common import id_or_null, materialise, null_id_back, prepare, table
from tidelog.llm.jaccard_join import bit_map, in_map
from tidelog.llm.shingles import mix, powers, text_buffers

#: Bytes of a window and of an anchor.
WIDTH, GRAM = 100, 36
BEFORE = WIDTH - GRAM
#: Contexts of an anchor that may meet in one task, of a task, and of a collection.
MOST, TASK_ROWS, TOGETHER = 16_384, 2000, 1000
#: Bytes that are hashed at a time.
PART = 1 << 19
ANCHOR_BITS, PLACE_BITS = 26, 26

_BYTES = np.random.default_rng(20260102).integers(0, 2**64, 256, np.uint64)
_PLACE = np.uint64((1 << 21) - 1)  # places within a part


def _minima(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, from those of 2, 4, 8... neighbours."""
    n, k = len(x) - w + 1, 1
    while 2 * k <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:n], x[w - k : w - k + n])


class Part:
    """Anchors of some neighbouring texts, or of a part of a long one.

    ``bounds`` are the texts' bounds in ``data`` (the first and last may lie
    outside); windows that start from ``core[0]`` and before ``core[1]`` count.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, core: tuple[int, int]):
        n = len(data)
        self.data, self.bounds = data, bounds
        self.at = np.zeros(0, np.int64)
        if n < WIDTH:
            return
        up, self.down = powers(n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:n])])
        grams = mix((self.sums[GRAM:] - self.sums[:-GRAM]) * self.down[: n - GRAM + 1])
        least = grams | _PLACE
        least -= np.arange(len(grams), dtype=np.uint64)
        least = _minima(least, BEFORE + 1)
        # the first of the windows of an anchor, within one text and the core
        lo = np.maximum(bounds[:-1], core[0])
        hi = np.minimum(bounds[1:] - WIDTH + 1, core[1])
        lo, hi = lo[hi > lo], hi[hi > lo]
        new = np.concatenate([[True], least[1:] != least[:-1]])
        new[lo] = True
        new = np.flatnonzero(new)
        text = np.searchsorted(lo, new, "right") - 1
        new = new[(text >= 0) & (new < np.append(hi, 0)[text])]
        self.at = (_PLACE - (least[new] & _PLACE)).astype(np.int64)
        self.anchor = grams[self.at].view(np.int64)
        self.doc = np.searchsorted(bounds, self.at, "right") - 1
        self.lo = np.maximum(bounds[self.doc], self.at - BEFORE)
        self.hi = np.minimum(bounds[self.doc + 1], self.at + WIDTH)

    def after(self, place: int) -> None:
        """Keeps the anchors beyond a place only."""
        if len(self.at) and self.at[0] <= place:
            on = self.at > place
            for name in ("at", "anchor", "doc", "lo", "hi"):
                setattr(self, name, getattr(self, name)[on])

    def offset(self, base: int) -> np.ndarray:
        """What to add to a place in ``data`` for the place in its text."""
        return np.full(len(self.at), base) if base else -np.maximum(self.bounds[self.doc], 0)

    def contexts(self) -> np.ndarray:
        """A hash of each anchor's context, its place in it, and the anchor."""
        raw = (self.sums[self.hi] - self.sums[self.lo]) * self.down[self.lo]
        shape = (self.at - self.lo) << 8 | (self.hi - self.at)
        own = mix(shape.astype(np.uint64) + np.uint64(1)) + self.anchor.view(np.uint64)
        return mix(raw ^ mix(own)).view(np.int64)


def parts(texts: pa.Array):
    """``Part``s of a string column, each with the number of its first text
    and the place of its data in that text."""
    data, offsets = text_buffers(texts)
    i = 0
    while i < len(texts):
        to = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PART // 2, "right")) - 1)
        a, b = int(offsets[i]), int(offsets[to])
        if b - a <= PART:
            yield Part(data[a:b], offsets[i : to + 1] - a, (0, b - a)), i, 0
        else:  # one long text, with what surrounds each part's windows
            last = -1
            for s in range(a, b, PART // 2):
                x, y = max(a, s - WIDTH), min(b, s + PART // 2 + 2 * WIDTH)
                part = Part(data[x:y], np.array([a - x, b - x]), (s - x, s + PART // 2 - x))
                part.after(last - x)  # windows of two parts may share an anchor
                last = max(last, x + int(part.at[-1])) if len(part.at) else last
                yield part, to - 1, x - a
        i = to


def _short(anchor: np.ndarray) -> np.ndarray:
    return (mix(anchor.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _place(doc: np.ndarray, th: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits for an anchor's place, for the bit map."""
    both = doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ th.astype(np.uint64)
    return mix(both + mix(at.astype(np.uint64))).view(np.int64)


class RepeatedBytes:
    """The steps of the removal over one table.

    A place in a text is one number, ``at``: the anchor's position, the bytes
    of its context before it, and those from it on.
    """

    def __init__(self, docs: DataFrame):
        text = F.coalesce("text", F.lit(""))
        self.docs = docs.select(
            text.alias("text"), id_or_null().alias("doc"), F.hash(text).alias("th")
        ).where(F.octet_length("text") >= WIDTH)
        self.context = docs.sparkSession.sparkContext

    def spans(self) -> DataFrame:
        """doc, th, and the removed spans as a sorted array s of a and b."""
        occurrences = self._occurrences()
        place = F.struct("doc", "th", "at")
        classes = occurrences.groupBy("cls").agg(
            F.min(place).alias("first"), F.min("anchor").alias("anchor"), F.count(F.lit(1)).alias("n")
        )
        classes = materialise(classes, "context-classes")
        repeated = classes.where(F.col("n") > 1).select("cls", "first")
        later = occurrences.select("cls", "doc", "th", "at").join(repeated, "cls")
        pos, left, right = F.shiftright("at", 16), _byte(8), _byte(0)
        later = later.where((place > F.col("first")) & (left + right >= WIDTH)).select(
            "doc", "th", (pos - left).alias("a"), (pos + right).alias("b")
        )
        several = (
            classes.groupBy("anchor")
            .agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
            .where(F.col("lo") != F.col("hi"))
            .select("anchor")
        )
        firsts = materialise(
            classes.join(several, "anchor", "left_semi").select("anchor", "first.*"), "first-contexts"
        )
        found = later.unionByName(self._among_firsts(firsts))
        merged = F.array_sort(F.collect_list(F.struct("a", "b"))).alias("s")
        return materialise(found.groupBy("doc", "th").agg(merged), "removed-spans")

    def _scan(self, rows_of, schema: str) -> DataFrame:
        """Runs ``rows_of(part, doc, th, at)`` over the anchors of all texts."""
        names = [x.split()[0] for x in schema.split(", ")]

        def run(batches):
            for b in batches:
                docs, hashes = b.column("doc").to_numpy(), b.column("th").to_numpy()
                for part, first, base in parts(b.column("text")):
                    if len(part.at):
                        at = part.at + part.offset(base)
                        at = at << 16 | (part.at - part.lo) << 8 | (part.hi - part.at)
                        columns = rows_of(part, docs[first + part.doc], hashes[first + part.doc], at)
                        yield pa.RecordBatch.from_arrays(
                            [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names
                        )

        return self.docs.mapInArrow(run, schema)

    def _occurrences(self) -> DataFrame:
        """Anchors that occur again: cls (a hash of anchor and context), anchor, doc, th, at."""
        seen = self._scan(lambda part, doc, th, at: [_short(part.anchor)], "k int")
        again = seen.groupBy("k").count().where("count > 1")
        words = self.context.broadcast(
            bit_map(again.select(F.col("k").cast("long").alias("x")), ANCHOR_BITS)
        )

        def rows_of(part, doc, th, at):
            on = in_map(_short(part.anchor).astype(np.int64), words.value, ANCHOR_BITS)
            return [x[on] for x in (part.contexts(), part.anchor, doc, th, at)]

        schema = "cls long, anchor long, doc long, th int, at long"
        return materialise(self._scan(rows_of, schema), "anchors")

    def _texts_of(self, firsts: DataFrame) -> DataFrame:
        """anchor, doc, th, at and the bytes s of the contexts ``firsts``.

        A few others come along by way of the bit map; they are windows of
        the texts as well and don't change what repeats.
        """

        def placed(frames):
            for f in frames:
                yield pd.DataFrame({"x": _place(*(f[c].to_numpy(np.int64) for c in ("doc", "th", "at")))})

        places = firsts.select("doc", "th", "at").mapInPandas(placed, "x long")
        words = self.context.broadcast(bit_map(places, PLACE_BITS))

        def rows_of(part, doc, th, at):
            on = np.flatnonzero(in_map(_place(doc, th, at), words.value, PLACE_BITS))
            raw = part.data.tobytes()
            strings = [raw[x:y] for x, y in zip(part.lo[on].tolist(), part.hi[on].tolist())]
            return [part.anchor[on], doc[on], th[on], at[on], pa.array(strings, pa.binary())]

        schema = "anchor long, doc long, th int, at long, s binary"
        return materialise(self._scan(rows_of, schema), "contexts")

    def _among_firsts(self, firsts: DataFrame) -> DataFrame:
        """Spans of windows in first contexts of which an equal one starts earlier."""
        contexts = self._texts_of(firsts)
        sizes = firsts.groupBy("anchor").count()
        hot = materialise(sizes.where(F.col("count") > MOST).select("anchor"), "hot-anchors")
        cool = contexts.join(hot, "anchor", "left_anti")
        tasks = max(1, firsts.count() // TASK_ROWS)
        spans = "doc long, th int, a long, b long"
        out = (
            cool.withColumn("task", F.pmod(F.xxhash64("anchor"), F.lit(tasks)))
            .groupBy("task")
            .applyInPandas(_repeats, spans)
        )
        if hot.isEmpty():
            return out
        first = F.shiftright("at", 16) - _byte(8)
        text = F.expr(f"substring(s, o + 1, {WIDTH})")
        windows = materialise(
            contexts.join(hot, "anchor", "left_semi")
            .where(F.octet_length("s") >= WIDTH)
            .select(
                "doc",
                "th",
                first.alias("lo"),
                "s",
                F.explode(F.sequence(F.lit(0), F.octet_length("s") - WIDTH)).alias("o"),
            )
            .select(
                "doc",
                "th",
                (F.col("lo") + F.col("o")).alias("a"),
                F.xxhash64(text).alias("h1"),
                F.xxhash64(F.lit(1), text).alias("h2"),
            ),
            "hot-windows",
        )
        start = F.struct("doc", "th", "a")
        earliest = (
            windows.groupBy("h1", "h2")
            .agg(F.min(start).alias("first"), F.max(start).alias("last"))
            .where(F.col("first") != F.col("last"))
            .select("h1", "h2", "first")
        )
        late = windows.join(earliest, ["h1", "h2"]).where(start > F.col("first"))
        return out.unionByName(late.select("doc", "th", "a", (F.col("a") + WIDTH).alias("b")))


def _byte(shift: int):
    return F.shiftright("at", shift).bitwiseAND(F.lit(0xFF))


def _with_a_half(rows: pd.DataFrame) -> pd.DataFrame:
    """The contexts that can hold a window of another one of their anchor: of
    a window's bytes beside the anchor, half stand before or after it."""
    half = BEFORE // 2
    able = np.zeros(len(rows), bool)
    left = (rows["at"].to_numpy() >> 8 & 0xFF).tolist()
    before = [s[x - half : x] if x >= half else b"" for s, x in zip(rows["s"], left)]
    after = [s[x + GRAM : x + GRAM + half] for s, x in zip(rows["s"], left)]
    for side in (before, after):
        whole = np.fromiter(map(len, side), np.int64, len(side)) == half
        f = pd.DataFrame({"anchor": rows["anchor"].to_numpy(), "side": side})[whole]
        able[np.flatnonzero(whole)[f.duplicated(keep=False).to_numpy()]] = True
    return rows[able]


def _collections(rows: pd.DataFrame):
    """The task's contexts in collections: their rows, and the contexts with
    two bytes that occur in none of the texts in place of the anchor, another
    pair for each anchor of the collection."""
    rows = _with_a_half(rows)
    if rows.empty:
        return
    rows = rows.sort_values("anchor", kind="stable").reset_index(drop=True)
    free = np.flatnonzero(np.bincount(np.frombuffer(b"".join(rows["s"]), np.uint8), minlength=256) == 0)
    number = (rows["anchor"] != rows["anchor"].shift()).cumsum().to_numpy() - 1
    left = (rows["at"].to_numpy() >> 8 & 0xFF).tolist()
    marks = free[np.stack([number // len(free), number], 1) % len(free)].astype(np.uint8)
    contexts = [s[:x] + m.tobytes() + s[x + GRAM :] for s, x, m in zip(rows["s"], left, marks)]
    at = 0
    while at < len(rows):
        # whole anchors
        more = int(np.searchsorted(number, number[at + TOGETHER])) if at + TOGETHER < len(rows) else len(rows)
        more = max(more, int(np.searchsorted(number, number[at], "right")))
        to = min(more, int(np.searchsorted(number, number[at] + len(free) ** 2)))
        yield rows.iloc[at:to], contexts[at:to]
        at = to


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans that repeat earlier windows of the task's contexts."""
    found = [_repeats_of(part, contexts) for part, contexts in _collections(rows)]
    none = pd.DataFrame(columns=["doc", "th", "a", "b"], dtype="int64")
    return pd.concat(found) if found else none


def _repeats_of(rows: pd.DataFrame, contexts: list[bytes]) -> pd.DataFrame:
    who, offset, group = equal_windows(contexts, WIDTH - GRAM + 2)
    doc, th, at = (rows[c].to_numpy(np.int64) for c in ("doc", "th", "at"))
    start = (at >> 16) - (at >> 8 & 0xFF)
    # a number that orders the windows' places (texts are shorter than 2^31)
    order = np.lexsort((th, doc))
    other = (np.diff(doc[order]) != 0) | (np.diff(th[order]) != 0)
    text = np.empty(len(rows), np.int64)
    text[order] = np.cumsum(np.concatenate([[False], other]))
    place = text[who] << 32 | start[who] + offset
    new = np.flatnonzero(np.diff(group, prepend=0))
    first = np.minimum.reduceat(place, new) if len(new) else place
    late = np.flatnonzero(place > first[group - 1])
    window = np.sort(who[late] << 16 | offset[late])
    # windows at neighbouring places make one span
    head = np.diff(window, prepend=-2) != 1
    tail = np.append(head[1:], True)[: len(head)]
    who, a = window[head] >> 16, window[head] & 0xFFFF
    b = (window[tail] & 0xFFFF) + WIDTH
    return pd.DataFrame({"doc": doc[who], "th": th[who], "a": start[who] + a, "b": start[who] + b})


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint maximal runs of sorted spans."""
    out: list[list[int]] = []
    for a, b in spans:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame) -> DataFrame:
    spans = RepeatedBytes(docs).spans().withColumnsRenamed({"doc": "sd_d", "th": "sd_t", "s": "sd_spans"})
    keyed = docs.withColumn("sd_doc", id_or_null()).withColumn(
        "sd_th", F.hash(F.coalesce("text", F.lit("")))
    )
    on = (F.col("sd_doc") == F.col("sd_d")) & (F.col("sd_th") == F.col("sd_t"))
    # the texts are shuffled at any size, so that the plan doesn't depend on it
    return keyed.join(spans.hint("merge"), on, "left")


def _cut(text: str | None, spans) -> tuple[bytes, list[tuple[int, int]]]:
    raw = (text or "").encode()
    runs = merged_spans([] if spans is None else [(s["a"], s["b"]) for s in spans])
    at, kept = 0, []
    for a, b in runs:
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]), runs


def cut_texts(docs: DataFrame) -> DataFrame:
    """sd_kept (bytes), sd_bytes, sd_removed and sd_runs with doc_id of every
    row, for ``drop_repeats`` and the query."""
    rows = _with_spans(docs.select("doc_id", "text")).select("sd_doc", "text", "sd_spans")

    def cut(batches):
        for b in batches:
            done = [_cut(t, s) for t, s in zip(b.column("text").to_pylist(), b.column("sd_spans").to_pylist())]
            gone = [sum(y - x for x, y in runs) for _, runs in done]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("sd_doc"),
                    pa.array([len(k) + g for (k, _), g in zip(done, gone)], pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array([len(runs) for _, runs in done], pa.int64()),
                    pa.array([k for k, _ in done], pa.binary()),
                ],
                ["sd_doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = "sd_doc long, n_bytes long, n_removed long, n_spans long, kept binary"
    return rows.mapInArrow(cut, schema).withColumn("doc_id", null_id_back("sd_doc")).drop("sd_doc")


def query(spark, sf_dir):
    return cut_texts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def stage(spark, docs, sf_dir):
    """Pipeline stage: texts without repeated strings; a text's remaining
    bytes that are no UTF-8 at a cut are dropped, and so are documents that
    lose all of their text."""
    prepare(spark)

    @F.pandas_udf("string")
    def without(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(
            [
                t if s is None else _cut(t, s)[0].decode("utf-8", "ignore")
                for t, s in zip(text, spans)
            ],
            dtype=object,
        )

    rows = _with_spans(docs)
    rows = rows.withColumn("text", F.when(F.col("sd_spans").isNull(), F.col("text")).otherwise(without("text", "sd_spans")))
    return rows.where(F.col("sd_spans").isNull() | (F.col("text") != "")).select(*docs.columns)
