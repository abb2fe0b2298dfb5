"""Operator 1: packing documents in the order of a space-filling curve.

Each document's token ids are counted in hashed buckets; the normalised
vector is projected to ``DIMENSIONS`` coordinates, whose Hilbert key orders
the documents.  They are range-partitioned and sorted by that key, and every
partition packs neighbours along the curve into sequences of ``SEQUENCE``
tokens: a sequence is filled to its end, the document goes on in the next
one.  Only the last sequence of a partition can be shorter, and is padded
unless its length is a power of two.

A group of documents with one key is split over partitions, as the row
number breaks ties in the range.  The encoded rows are written once, so that
neither the range's sampling nor a lost executor encodes again.

Defined cases: a null or empty text is its end token alone; repeated rows and
repeated or null ids are packed row by row; an empty table gives an empty
result.  Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bpe import codec, vocabulary_path
from tidelog.llm.common import materialise, prepare, table

SEQUENCE, END_ID = 2048, 1
BUCKETS, DIMENSIONS, BITS = 256, 4, 15
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def projection() -> np.ndarray:
    """Fixed orthonormal directions, one column for each dimension."""
    draws = np.random.default_rng(20260101).standard_normal((BUCKETS, DIMENSIONS))
    return np.linalg.qr(draws)[0]


def hashed_vector(ids: np.ndarray) -> np.ndarray:
    """Unit vector of the ids' counts in hashed buckets."""
    mixed = ids.astype(np.uint32) * np.uint32(2654435761) >> np.uint32(24)
    v = np.sqrt(np.bincount(mixed, minlength=BUCKETS))
    return v / max(np.sqrt((v * v).sum()), 1e-12)


def grid(points: np.ndarray) -> np.ndarray:
    """Coordinates in [-1, 1] as cells of a grid with 2**BITS cells a side,
    finer around 0, where most projections lie."""
    unit = 0.5 + np.arctan(points * np.sqrt(BUCKETS)) / np.pi
    return np.clip((unit * 2**BITS).astype(np.int64), 0, 2**BITS - 1)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells.

    The axes are turned into the curve's transposed index bit plane by bit
    plane (inverse undo, then Gray code), all rows at a time.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def encoded_with_key(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, key, ids (little-endian unsigned 16-bit numbers, or 32-bit ones
    for a vocabulary that needs them), with the end token."""

    def run(batches):
        c, directions = codec(vocabulary), projection()
        kind = "<u2" if len(c.pieces) <= 1 << 16 else "<u4"
        for b in batches:
            packed, vectors = [], np.zeros((b.num_rows, BUCKETS))
            texts = b.column("text").fill_null("").to_pylist()
            for i, raw in enumerate(c.encode_all(texts)):
                ids = np.frombuffer(raw, "<u4")
                vectors[i] = hashed_vector(ids)
                packed.append(np.append(ids, END_ID).astype(kind).tobytes())
            keys = hilbert_key(grid(vectors @ directions))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(keys, pa.int64()), pa.array(packed, pa.binary())],
                ["doc_id", "key", "ids"],
            )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(run, "doc_id long, key long, ids binary")


def hilbert_pack(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned
    32-bit numbers), doc_tokens, sequence_id, offset."""
    path = vocabulary or vocabulary_path()

    def pack(batches):
        kind = "<u2" if len(codec(path).pieces) <= 1 << 16 else "<u4"
        sequence, fill = TaskContext.get().partitionId() << 33, 0
        for b in batches:
            rows = []
            for doc, raw in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                ids = np.frombuffer(raw, kind).astype("<u4")
                at = 0
                while at < len(ids):
                    n = min(SEQUENCE - fill, len(ids) - at)
                    rows.append((doc, at, n, ids[at : at + n].tobytes(), len(ids), sequence, fill))
                    at, fill = at + n, fill + n
                    if fill == SEQUENCE:
                        sequence, fill = sequence + 1, 0
            for i in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(x, pa.binary() if k == 3 else pa.int64())
                        for k, x in enumerate(zip(*rows[i : i + 2000]))
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    rows = materialise(
        encoded_with_key(docs, path).withColumn("row", F.monotonically_increasing_id()), "curve"
    )
    ordered = rows.repartitionByRange("key", "doc_id", "row").sortWithinPartitions(
        "key", "doc_id", "row"
    )
    return ordered.select("doc_id", "ids").mapInArrow(pack, PIECES)


def query(spark, sf_dir):
    return hilbert_pack(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def stage(spark, docs, sf_dir):
    """Pipeline stage: the packed pieces with their ids."""
    prepare(spark)
    return hilbert_pack(docs)
