"""Operator 9: n-gram Jaccard join by T-occurrence search.

Documents with one set of shingles are one class.  Two classes link when
100 * intersection >= 80 * union.

All shingles have one order, rare ones first: common ones are told by counts
in ``BUCKETS`` buckets (of those that a task meets repeatedly), then comes the
hash.  The order only steers the work; any order gives the same links.  Two
sets that link share one of their first n - ceil(0.8 n) + 1 shingles, so only
these *short lists* are shuffled, and only those of shingles that two classes
have.

Candidates come from the short lists without making all pairs of a list: first
the list's leader is paired with its members.  The leader is the class that
has the list's shingle earliest in its order, for its size: it has the fewest
shingles of its own, as a text has from which the others were made.  What links
joins components, and lists within one component are done.  Then the pairs
across components that are left and that sizes and places allow are taken,
block by block of a list, so that no link between components is lost.

Candidates first pass a bit signature: sets that link differ in at most a
ninth of their sizes' sum, and every bit in which the signatures differ is a
shingle that only one of them has.  The rest are verified leader by leader with DivideSkip: the lists of the
leader's shingles over a block of members are cut into long and short ones,
the short ones are merged with a heap, and members that reach the required
overlap less the number of long lists are looked up in the long ones by
binary search.

Only sketches of a fixed size reach the driver: the buckets, and bit maps of
2**26 and 2**23 bits that keep most unneeded rows from being shuffled; joins
make the choice exact.

Classes and shingles are told apart by 64-bit and 58-bit hashes.

Defined cases: a null text, or one without words, has an empty set and links
with nothing; repeated rows are each returned; component_id is the smallest
doc_id that isn't null; an empty table gives an empty result.  Only doc_id
and text are read.
"""

from __future__ import annotations

import heapq
from itertools import groupby
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import (
    NULL_ID,
    discard,
    id_or_null,
    materialise,
    prepare,
    swept_shuffles,
    table,
    written,
)
from tidelog.llm.components import components, joined_components
from tidelog.llm.shingles import mix, shingle_sets

#: Similarity in percent.
PERCENT = 80
#: Buckets of the counts, and shingles that a task counts at a time.
BUCKETS, AT_A_TIME = 1 << 18, 2_000_000
SHINGLE_BITS, DOC_BITS = 26, 23
#: Bits of a signature.
SIGNATURE = 1024
#: Members of a block when sets are verified, rows of a verifying task.
BLOCK, TASK_ROWS = 256, 1000
#: Members of a block of a list that is left after its leader.
MEMBERS = 512
#: Cost of a merge step against a lookup, which sets the number of long lists.
MU = 0.0085


def required(na: int, nb) -> int:
    """Smallest intersection of linked sets of these sizes."""
    return -(-PERCENT * (na + nb) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def class_id(s: np.ndarray) -> int:
    """64-bit hash of a set of shingles, as a signed number."""
    a = s.sum(dtype=np.uint64, keepdims=True)
    b = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(a * np.uint64(0x9E3779B97F4A7C15) ^ b).view(np.int64)[0])


def _measure(batches):
    """A row for each text, and the task's counts of repeated shingles."""
    counts, pending, size = np.zeros(BUCKETS, np.int64), [], 0
    names = ["doc_id", "h", "n", "cid", "bucket", "c"]

    def flush():
        if pending:
            seen, times = np.unique(np.concatenate(pending), return_counts=True)
            again = times > 1
            where = (seen[again] & np.uint64(BUCKETS - 1)).astype(np.int64)
            counts[:] += np.bincount(where, times[again], BUCKETS).astype(np.int64)

    for b in batches:
        sets = shingle_sets(b.column("text"))
        for s in sets:
            pending.append(s)
            size += len(s)
            if size > AT_A_TIME:
                flush()
                pending, size = [], 0
        none = pa.nulls(len(sets), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc_id"),
                b.column("h"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
                none,
                none,
            ],
            names,
        )
    flush()
    found = np.flatnonzero(counts)
    none = pa.nulls(len(found), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, none, none, pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], names
    )


def _ordered(s: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set in the common order: level above 58 bits of the hash."""
    level = levels[(s & np.uint64(BUCKETS - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort(level << np.uint64(58) | s >> np.uint64(6))


def _bits(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two places of each value in a map of 2**bits bits."""
    h = mix(values.astype(np.uint64))
    return [(h >> np.uint64(64 - bits)).astype(np.int64), (h & np.uint64((1 << bits) - 1)).astype(np.int64)]


def bit_map(values: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the long column ``x``, with two places a value:
    2**bits bits whatever the number of values."""

    def places(frames):
        for f in frames:
            yield pd.DataFrame({"bit": np.concatenate(_bits(f["x"].to_numpy(np.int64), bits))})

    rows = values.select("x").mapInPandas(places, "bit long")
    with swept_shuffles(values.sparkSession):
        words = rows.groupBy(F.shiftright("bit", 6).alias("w")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("b")
        )
        got = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return out


def in_map(values: np.ndarray, words: np.ndarray, bits: int) -> np.ndarray:
    one, two = (
        words[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1) == 1 for bit in _bits(values, bits)
    )
    return one & two


def _short(k: np.ndarray) -> np.ndarray:
    """32 bits of shingles or classes."""
    return (mix(k.view(np.uint64)) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def verify(a: np.ndarray, members: list[np.ndarray]) -> list[tuple[int, int]]:
    """Numbers and overlaps of the members that link with ``a`` (DivideSkip).
    All sets are sorted."""
    need = [required(len(a), len(m)) for m in members]
    place, which = [], []
    for i, m in enumerate(members):
        at = np.minimum(np.searchsorted(a, m), len(a) - 1)
        hit = at[a[at] == m]
        place.append(hit)
        which.append(np.full(len(hit), i))
    place, which = np.concatenate(place), np.concatenate(which)
    order = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[order], np.arange(len(a) + 1))
    which = which[order]
    lists = [which[x:y] for x, y in zip(ends[:-1], ends[1:]) if y > x]
    lists.sort(key=len)
    least = min(need)
    longest = len(lists[-1]) if lists else 1
    n_long = min(least - 1, int(least / (MU * log(longest + 1) + 1)), len(lists))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    merged = heapq.merge(*(x.tolist() for x in short))
    counts = {i: sum(1 for _ in same) for i, same in groupby(merged)}
    able = np.array([i for i in range(len(members)) if counts.get(i, 0) >= need[i] - n_long], np.int64)
    total = np.array([counts.get(i, 0) for i in able], np.int64)
    for x in long:
        if len(able):
            at = np.minimum(np.searchsorted(x, able), len(x) - 1)
            total += x[at] == able
    return [(int(i), int(t)) for i, t in zip(able, total) if t >= need[i]]


def signature(s: np.ndarray) -> bytes:
    """A bit for each shingle, by the high bits of its hash."""
    bits = np.zeros(SIGNATURE, bool)
    bits[(s >> np.uint64(40) & np.uint64(SIGNATURE - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _differing(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Number of bits in which the signatures of two binary columns differ."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(-1, SIGNATURE // 64) for c in (a, b))
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _may_link(batches):
    for t in batches:
        n = t.column("na").to_numpy() + t.column("nb").to_numpy()
        # the sizes' sum less twice the required intersection
        most = n - 2 * required(0, n)
        on = pa.array(_differing(t.column("sa"), t.column("sb")) <= most)
        yield t.select(["a", "b"]).filter(on)


def _verify_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """Linked pairs among a task's leaders (b equals a) and members."""
    found = []
    for leader, own in rows.groupby("a", sort=False):
        lead = own["b"] == leader
        if not lead.any() or lead.all():
            continue
        a = np.frombuffer(own.loc[lead, "s"].iloc[0], np.uint64)
        ids, sets = own.loc[~lead, "b"].tolist(), own.loc[~lead, "s"].tolist()
        for at in range(0, len(ids), BLOCK):
            part = [np.frombuffer(s, np.uint64) for s in sets[at : at + BLOCK]]
            found += [(leader, int(ids[at + i]), t) for i, t in verify(a, part)]
    return pd.DataFrame(found, columns=["u", "v", "overlap"]).astype("int64")


def _end(x: str, of: str = "") -> list[Column]:
    """Class, size and place of a list's row as one end of a pair."""
    return [F.col(f"{of}cid").alias(x), F.col(f"{of}n").alias(f"n{x}"), F.col(f"{of}pos").alias(f"p{x}")]


def _able() -> Column:
    """Sizes that can link, and enough shingles left after a first common one
    at these places."""
    left = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    return (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")) & (
        (100 + PERCENT) * left >= PERCENT * (F.col("na") + F.col("nb"))
    )


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


class ShingleJoin:
    """The steps of the join over one table."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        return self._labelled(self.classes())

    def classes(self) -> DataFrame:
        """doc_id, h (hash of the text), n, cid and comp (the smallest class of
        the component) of every row; empty sets have no class."""
        rows = "doc_id long, h long, n long, cid long, bucket long, c long"
        hashed = self.docs.withColumn("h", text_hash())
        measured = materialise(hashed.mapInArrow(_measure, rows), "shingle-counts")
        self.rows = measured.where(F.col("n").isNotNull()).select("doc_id", "h", "n", "cid")
        self.levels = self._levels(measured.where(F.col("bucket").isNotNull()))
        lists = self._lists()
        return self._with_components(self._components(lists))

    def _levels(self, counts: DataFrame) -> np.ndarray:
        with swept_shuffles(counts.sparkSession):
            total = counts.groupBy("bucket").agg(F.sum("c").alias("c")).toArrow()
        levels = np.zeros(BUCKETS, np.uint8)
        c = total.column("c").to_numpy()
        levels[total.column("bucket").to_numpy()] = np.minimum(np.log2(c).astype(np.uint8), 63)
        return levels

    def _lists(self) -> DataFrame:
        """The short lists that several classes share: k, cid, n, pos."""
        levels = self.levels

        def brief(batches):
            for b in batches:
                k, c = [], []
                for s in shingle_sets(b.column("text")):
                    if len(s):
                        p = _ordered(s, levels)[: prefix_length(len(s))]
                        k.append(_short(p))
                        c.append(np.full(len(p), class_id(s), np.int64))
                if k:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(k)), pa.array(np.concatenate(c))], ["k", "c"]
                    )

        seen = self.docs.mapInArrow(brief, "k int, c long")
        both = seen.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
        shared = both.where(F.col("lo") != F.col("hi")).select(F.col("k").cast("long").alias("x"))
        words = self.docs.sparkSession.sparkContext.broadcast(bit_map(shared, SHINGLE_BITS))

        def full(batches):
            for b in batches:
                out, signed = [], []
                for s in shingle_sets(b.column("text")):
                    if len(s):
                        p = _ordered(s, levels)[: prefix_length(len(s))]
                        at = np.flatnonzero(in_map(_short(p).astype(np.int64), words.value, SHINGLE_BITS))
                        if len(at):
                            out.append((p[at].view(np.int64), class_id(s), len(s), at))
                            signed.append(signature(s))
                if out:
                    sizes = [len(x[3]) for x in out]
                    cids = np.array([x[1] for x in out], np.int64)
                    n = np.array([x[2] for x in out], np.int64)
                    total, none = sum(sizes), pa.nulls(len(out), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([x[0] for x in out])),
                            pa.array(np.repeat(cids, sizes)),
                            pa.array(np.repeat(n, sizes)),
                            pa.array(np.concatenate([x[3] for x in out])),
                            pa.nulls(total, pa.binary()),
                        ],
                        ["k", "cid", "n", "pos", "sig"],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [none, pa.array(cids), pa.array(n), none, pa.array(signed, pa.binary())],
                        ["k", "cid", "n", "pos", "sig"],
                    )

        schema = "k long, cid long, n long, pos long, sig binary"
        spark = self.docs.sparkSession
        raw, raw_path = written(self.docs.mapInArrow(full, schema), "postings")
        signed = raw.where(F.col("sig").isNotNull()).select("cid", "n", "sig")
        self.signatures = materialise(signed.dropDuplicates(["cid"]), "signatures")
        entries = raw.where(F.col("k").isNotNull()).drop("sig").distinct()
        entries, entries_path = written(entries, "short-lists")
        discard(spark, raw_path)
        several = (
            entries.groupBy("k")
            .agg(F.min("cid").alias("lo"), F.max("cid").alias("hi"))
            .where(F.col("lo") != F.col("hi"))
            .select("k")
        )
        shared = materialise(entries.join(several, "k", "left_semi"), "shared-lists")
        discard(spark, entries_path)
        return shared

    def _passed(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose signatures allow a link."""
        sign = lambda x: self.signatures.select(
            F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}")
        )
        both = pairs.join(sign("b"), "b").join(sign("a"), "a")
        return both.mapInArrow(_may_link, "a long, b long")

    def _sets(self, needs: DataFrame):
        """cid and the ordered set (8 bytes a shingle), once each, of the classes
        in ``needs``, and of a few others that the bit map lets through; and
        that map's broadcast."""
        reps = self.rows.groupBy("cid").agg(F.min(id_or_null()).alias("x"))
        words = self.docs.sparkSession.sparkContext.broadcast(
            bit_map(reps.join(needs, "cid", "left_semi").select("x"), DOC_BITS)
        )
        levels = self.levels

        def whole(batches):
            for b in batches:
                ids = b.column("doc_id").fill_null(NULL_ID).to_numpy()
                b = b.filter(pa.array(in_map(ids, words.value, DOC_BITS)))
                sets = [s for s in shingle_sets(b.column("text")) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([class_id(s) for s in sets], pa.int64()),
                        pa.array([_ordered(s, levels).tobytes() for s in sets], pa.binary()),
                    ],
                    ["cid", "s"],
                )

        return self.docs.mapInArrow(whole, "cid long, s binary").dropDuplicates(["cid"]), words

    def _verified(self, pairs: DataFrame, n: int) -> tuple[DataFrame, str]:
        """Those of the n pairs (a, b) that link, as u and v, and their folder."""
        spark = pairs.sparkSession
        size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
        dealt, dealt_path = written(
            pairs.join(size, "a").select(
                "a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("blk")
            ),
            "dealt-pairs",
        )
        members = dealt.select(F.col("b").alias("cid"), "a", "blk")
        needs = members.unionByName(dealt.select(F.col("a").alias("cid"), "a", "blk").distinct())
        # the sets aren't written: they are dealt by class, where each meets its
        # pairs, and from there to the tasks
        sets, words = self._sets(needs)
        task = F.pmod(F.xxhash64("a", "blk"), F.lit(max(1, n // TASK_ROWS))).alias("task")
        rows = sets.join(needs, "cid").select(task, "a", F.col("cid").alias("b"), "s")
        found = rows.groupBy("task").applyInPandas(_verify_rows, "u long, v long, overlap long")
        links = written(found.select("u", "v"), "links")
        words.unpersist()
        discard(spark, dealt_path)
        return links

    def _linked(self, pairs: DataFrame, comp: DataFrame | None) -> DataFrame | None:
        """The components after trying ``pairs``."""
        spark = pairs.sparkSession
        passed, passed_path = written(self._passed(pairs), "passed-pairs")
        if n := passed.count():
            found, found_path = self._verified(passed, n)
            if not found.isEmpty():
                comp = components(found) if comp is None else joined_components(comp, found)
            discard(spark, found_path)
        discard(spark, passed_path)
        return comp

    def _leader_pairs(self, lists: DataFrame) -> DataFrame:
        """Every list's leader with the other members, as a and b."""
        rank = F.struct(F.expr("pos / n").alias("at"), F.xxhash64("cid").alias("h"), "cid", "n", "pos")
        lead = lists.groupBy("k").agg(F.min(rank).alias("l")).select("k", *_end("a", "l."))
        both = lead.join(lists.select("k", *_end("b")), "k")
        return both.where((F.col("a") != F.col("b")) & _able()).select("a", "b").distinct()

    def _open_lists(self, lists: DataFrame, comp: DataFrame | None) -> DataFrame:
        """The lists of more than two members that lie in several components:
        k, cid, n, pos, comp and size."""
        if comp is None:
            labelled = lists.withColumn("comp", F.col("cid"))
        else:
            labelled = lists.join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
                "comp", F.coalesce("comp", "cid")
            )
        several = (
            labelled.groupBy("k")
            .agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
            .where((F.col("lo") != F.col("hi")) & (F.col("size") > 2))
            .select("k", "size")
        )
        return labelled.join(several, "k")

    def _pairs_apart(self, lists: DataFrame) -> DataFrame:
        """The pairs a < b of a list's members in different components.  A long
        list is cut in blocks; two blocks meet in one group, so that no group
        grows with its list."""
        blocks = F.ceil(F.col("size") / MEMBERS).cast("int")
        dealt = lists.select("k", "cid", "n", "pos", "comp", blocks.alias("of")).withColumn(
            "own", F.pmod(F.xxhash64("cid"), F.col("of")).cast("int")
        )
        met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1))).withColumn(
            "lo", F.least("own", "other")
        ).withColumn("hi", F.greatest("own", "other"))
        group = ["k", "lo", "hi"]
        both = met.select(*group, *_end("a"), F.col("own").alias("oa"), F.col("comp").alias("ca")).join(
            met.select(*group, *_end("b"), F.col("own").alias("ob"), F.col("comp").alias("cb")), group
        )
        # the groups of two blocks hold the pairs across, those of one block its own
        apart = (F.col("ca") != F.col("cb")) & (F.col("a") < F.col("b"))
        across = (F.col("lo") == F.col("hi")) | (F.col("oa") != F.col("ob"))
        return both.where(apart & across & _able()).select("a", "b").distinct()

    def _components(self, lists: DataFrame) -> DataFrame | None:
        """node and comp of the classes that are linked."""
        if lists.isEmpty():
            return None
        spark = lists.sparkSession
        led, led_path = written(self._leader_pairs(lists), "leader-pairs")
        comp = self._linked(led, None)
        rest, rest_path = written(self._open_lists(lists, comp), "open-lists")
        if not rest.isEmpty():
            turned = led.select(F.col("b").alias("a"), F.col("a").alias("b"))
            left = self._pairs_apart(rest).join(led.unionByName(turned), ["a", "b"], "left_anti")
            pairs, pairs_path = written(left, "pairs-apart")
            comp = self._linked(pairs, comp)
            discard(spark, pairs_path)
        discard(spark, led_path)
        discard(spark, rest_path)
        return comp

    def _with_components(self, comp: DataFrame | None) -> DataFrame:
        if comp is None:
            return self.rows.withColumn("comp", F.col("cid"))
        return self.rows.join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "comp", F.coalesce("comp", "cid")
        )

    def _labelled(self, rows: DataFrame) -> DataFrame:
        least = rows.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("doc_id").alias("low"))
        return rows.join(least, "comp", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    return ShingleJoin(docs).run()


def query(spark, sf_dir):
    return jaccard_join(table(spark, sf_dir, "documents"))


def stage(spark, docs, sf_dir):
    """Pipeline stage: one document of each component stays, that with the
    smallest (doc_id, class, hash of the text), where no doc_id comes last.
    Rows of one doc_id and text are one document.  The others are removed by
    doc_id and hash, so that further texts of a doc_id, or without one, are
    judged by themselves."""
    prepare(spark)
    labelled = materialise(ShingleJoin(docs).classes(), "components")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cid", "h")
    ranked = labelled.where(F.col("comp").isNotNull()).select("doc_id", "h", "comp", rank.alias("rank"))
    first = ranked.groupBy("comp").agg(F.min("rank").alias("first"))
    others = (
        ranked.join(first, "comp")
        .where(~F.col("rank").eqNullSafe(F.col("first")))
        .select(id_or_null().alias("jj_gone"), F.col("h").alias("jj_hash"))
    )
    out = docs
    if not labelled.groupBy("doc_id", "h").count().where("count > 1").isEmpty():
        out = docs.dropDuplicates(["doc_id", "text"])
    gone = materialise(others, "later-copies")
    same = (id_or_null() == F.col("jj_gone")) & (text_hash() == F.col("jj_hash"))
    return out.join(gone.hint("merge"), same, "left_anti")
