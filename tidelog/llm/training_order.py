"""Operator 3: token ids in training order, as fixed-stride shards.

Each document's ids and an end id are cut into sequences of ``STRIDE`` ids
(the last one padded).  The ids are written once, with the task and the
sequences of that task before each row; running sums of the tasks' few counts
give each sequence its place in the
input.  A keyed Feistel network permutes the places: it works on the next
even power of two and is applied again while the result lies outside of the
number of sequences, so that every sequence gets its own slot below that
number.  The rows are dealt by ranges of shards, ``SHARD`` slots each, and each
task writes its shards in slot order as files without headers: slot s is
found at byte (s mod SHARD) * STRIDE * width of file s div SHARD, so reading
is sequential and can go on at any slot.  The shards are written in at most
``PASSES`` passes over the stored ids, each over as many of them: a pass
shuffles only its own sequences, and its shuffle files are deleted before the
next one, so that disk holds the ids, the shards and a part of the shuffle.

Each task checks that its shards' slots are dense, and the manifest is
compared with the count.  A shard is written under a name of its own attempt
and then renamed, so that a repeated task leaves a whole file.

Defined cases: a null or empty text is one sequence with the end id; repeated
rows and ids are materialised row by row; an empty table gives no shard and
an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.bpe import codec, vocabulary_path
from tidelog.llm.common import discard, materialise, table, written
from tidelog.session import scratch_path

STRIDE, END_ID, PAD_ID = 512, 50256, 0
#: Slots of a shard, the key of the order, and the network's rounds.
SHARD, KEY, ROUNDS = 8192, 20260101, 6
#: Tasks that write or read shards; beyond it a task takes a range of several.
MOST_TASKS = 20_000
#: Passes in which the shards are written.
PASSES = 4
#: File of the number of sequences, written when all shards are complete.
TOTAL = "sequences"
#: Sequences of an Arrow batch.
BATCH = 1024


def feistel(places: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot of each place below ``n``: a permutation of 0 .. n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(key).integers(0, 2**63, ROUNDS, np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            f = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ f >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (f >> np.uint64(32)) & low
        return left << np.uint64(half) | right

    out = once(np.asarray(places).astype(np.uint64))
    while (far := out >= n).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def _files(folder: str):
    """File system and path of a URI, or of a plain path."""
    if ":" in folder.split("/")[0]:
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def _width(c) -> str:
    return "<u2" if len(c.pieces) <= 1 << 16 else "<u4"


def _cells(encoded: list[bytes], width: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of texts as rows of STRIDE ids, each text's number of ids, and
    of rows."""
    item = np.dtype(width).itemsize
    sizes = np.array([len(raw) // item + 1 for raw in encoded], np.int64)
    counts = -(-sizes // STRIDE)
    flat = np.full(int(counts.sum()) * STRIDE, PAD_ID, width)
    for raw, size, end in zip(encoded, sizes, np.cumsum(counts) * STRIDE):
        start = end - -(-size // STRIDE) * STRIDE
        flat[start : start + size - 1] = np.frombuffer(raw, width)
        flat[start + size - 1] = END_ID
    return flat.reshape(-1, STRIDE), sizes, counts


def _binary(cells: np.ndarray | bytes, n: int, size: int) -> pa.Array:
    """n binary values of one size from their joint bytes."""
    offsets = np.arange(n + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(cells)])


def encoded_rows(docs: DataFrame, vocabulary: str) -> tuple[DataFrame, str]:
    """Every row's ids, written once: task, first (sequences of the task before
    this row's), n (its sequences), doc_id, ids; and their folder.  A retried
    task's rows are those of the attempt that was committed, so places never
    mix."""

    def encode(batches):
        c, before, task = codec(vocabulary), 0, TaskContext.get().partitionId()
        for b in batches:
            encoded = c.encode_all(b.column("text").fill_null("").to_pylist())
            n = np.array([-(-(len(raw) // 4 + 1) // STRIDE) for raw in encoded], np.int64)
            first = before + np.cumsum(n) - n
            before += int(n.sum())
            ids = [np.frombuffer(raw, "<u4").astype(_width(c)).tobytes() for raw in encoded]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), task, np.int64)),
                    pa.array(first),
                    pa.array(n),
                    b.column("doc_id"),
                    pa.array(ids, pa.binary()),
                ],
                ["task", "first", "n", "doc_id", "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(
        rows.mapInArrow(encode, "task long, first long, n long, doc_id long, ids binary"), "encoded-rows"
    )


def split_counts(rows: DataFrame) -> DataFrame:
    """Sequences of every task of ``encoded_rows``, and of those before it."""
    counts = rows.groupBy("task").agg(F.sum("n").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(
        counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "split-bases"
    )


def write_training_order(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Writes the shards below ``folder`` (a URI or path that all executors
    share) and returns the manifest: slot, shard, byte_offset, doc_id, part,
    n_ids."""
    words = vocabulary or vocabulary_path()
    spark = docs.sparkSession
    rows, rows_path = encoded_rows(docs, words)
    splits = split_counts(rows)
    total = splits.agg(F.sum("n")).first()[0] or 0

    def cut(batches, first_slot, end_slot):
        """The sequences with slots in this range."""
        width = _width(codec(words))
        for b in batches:
            cells, sizes, counts = _cells(b.column("ids").to_pylist(), width)
            first = b.column("first").to_numpy()
            row = np.repeat(np.arange(len(counts)), counts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            slot = feistel(first[row] + part, total)
            own = np.flatnonzero((slot >= first_slot) & (slot < end_slot))
            for at in range(0, len(own), BATCH):
                i = own[at : at + BATCH]
                r, p = row[i], part[i]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slot[i]),
                        b.column("doc_id").take(pa.array(r)),
                        pa.array(p),
                        pa.array(np.minimum(STRIDE, sizes[r] - p * STRIDE)),
                        _binary(cells[i], len(i), cells.itemsize * STRIDE),
                    ],
                    ["slot", "doc_id", "part", "n_ids", "ids"],
                )

    def write(batches):
        files, root = _files(folder)
        out, shard, name, ahead = None, None, None, 0

        def close():
            if out is not None:
                if ahead != min((shard + 1) * SHARD, total):
                    raise RuntimeError(f"shard {shard} ends before slot {ahead}")
                out.close()
                files.move(name, f"{root}/shard-{shard:08d}.bin")

        for b in batches:
            shards = b.column("shard").to_numpy()
            slots = b.column("slot").to_numpy()
            ids = b.column("ids").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(ids) else []
            for i, to in zip(starts, [*starts[1:], len(ids)]):
                if shards[i] != shard:
                    close()
                    shard = int(shards[i])
                    name = f"{root}/attempt-{uuid.uuid4().hex}"
                    out = files.open_output_stream(name)
                    ahead = shard * SHARD
                if not np.array_equal(slots[i:to], np.arange(ahead, ahead + to - i)):
                    raise RuntimeError(f"slots of shard {shard} aren't dense from {ahead} on")
                ahead += int(to - i)
                out.write(b"".join(ids[i:to]))
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in ("slot", "shard", "byte_offset", "doc_id", "part", "n_ids")],
                ["slot", "shard", "byte_offset", "doc_id", "part", "n_ids"],
            )
        close()

    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    based = rows.join(splits.select("task", "base"), "task").select(
        (F.col("base") + F.col("first")).alias("first"), "doc_id", "ids"
    )
    shards = max(1, -(-total // SHARD))
    per_pass = -(-shards // PASSES)

    def written_pass(low):
        """Writes up to ``per_pass`` shards from ``low`` on; their manifest."""
        here = min(per_pass, shards - low)
        ends = low * SHARD, (low + here) * SHARD
        placed = based.mapInArrow(
            lambda batches: cut(batches, *ends), "slot long, doc_id long, part long, n_ids long, ids binary"
        ).select(
            "slot",
            F.floor(F.col("slot") / SHARD).cast("long").alias("shard"),
            (F.col("slot") % SHARD * F.length("ids")).cast("long").alias("byte_offset"),
            "doc_id",
            "part",
            "n_ids",
            "ids",
        )
        # slots are dense, so shards are even: task t takes the t-th range of them
        each = -(-here // MOST_TASKS)
        task = F.floor((F.col("shard") - low) / each).cast("int")
        dealt = placed.repartitionById(-(-here // each), task).sortWithinPartitions("slot")
        return materialise(
            dealt.mapInArrow(
                write, "slot long, shard long, byte_offset long, doc_id long, part long, n_ids long"
            ),
            "manifest",
        )

    parts = [written_pass(low) for low in range(0, shards, per_pass)]
    discard(spark, rows_path)
    manifest = reduce(DataFrame.unionAll, parts)
    if (n := manifest.count()) != total:
        raise RuntimeError(f"{n} sequences written, {total} counted")
    with files.open_output_stream(f"{root}/{TOTAL}") as f:
        f.write(str(total).encode())
    return manifest


def read_training_order(spark, folder: str, width: int, first_slot: int = 0) -> DataFrame:
    """slot and ids of the shards from ``first_slot`` on, each shard read from
    its start or from that slot to its end.  The number of sequences, which
    the writer leaves last, gives the shards; the folder isn't listed."""
    files, root = _files(folder)
    with files.open_input_file(f"{root}/{TOTAL}") as f:
        total = int(f.read())
    first, end = first_slot // SHARD, -(-total // SHARD)
    size = STRIDE * width

    def read(batches):
        files, root = _files(folder)
        for b in batches:
            for shard in b.column("id").to_pylist():
                with files.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
                    slot = max(first_slot, shard * SHARD)
                    f.seek((slot - shard * SHARD) * size)
                    while raw := f.read(size * BATCH):
                        n = len(raw) // size
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.arange(slot, slot + n)), _binary(raw, n, size)],
                            ["slot", "ids"],
                        )
                        slot += n

    tasks = spark.range(first, max(first, end), 1, max(1, min(end - first, MOST_TASKS)))
    return tasks.mapInArrow(read, "slot long, ids binary")


def query(spark, sf_dir):
    folder = scratch_path(spark, "training-order")
    manifest = write_training_order(table(spark, sf_dir, "documents"), folder)
    width = np.dtype(_width(codec(vocabulary_path()))).itemsize
    back = read_training_order(spark, folder, width).select("slot", F.crc32("ids").alias("ids_crc32"))
    # both grow with the input, though the plan takes the list of shards for a small table
    return manifest.join(back.hint("merge"), "slot").select(
        "slot", "shard", "byte_offset", "doc_id", "part", "n_ids", "ids_crc32"
    )
