"""Operator 7: byte-pair encoding of long texts by tree concatenation.

A text of more than ``LEAF`` characters is cut into leaves, which different
tasks encode.  Neighbours are then joined pair by pair, level by level: a
window around each join is encoded again and grows until its ends agree with
both sides.  An end agrees exactly

* at a place where a letter meets a character that is none: the
  pre-tokenizer splits there whatever stands further away; or
* within a run of letters, which the pre-tokenizer takes as one piece, at a
  place where the tokens on both sides are what their joint bytes encode to:
  a row of tokens is the encoding if that holds for all neighbours.

If neither is found, the window ends up as the whole text.  Shorter texts are
leaves by themselves.

Defined cases: a null or empty text has no tokens and the digests of no
bytes; repeated rows are each returned; a null doc_id stays null; an empty
table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.bpe import codec, vocabulary_path
from tidelog.llm.common import table

#: Characters of a leaf, and tokens on either side in the first window.
LEAF, WINDOW = 32_768, 16

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _hard_places(text: str):
    """Places where an ASCII character that is no letter follows a letter;
    not before a bar, which may be inside a special token."""
    return [
        i
        for i in range(1, len(text))
        if text[i - 1].isalpha() and text[i] != "|" and text[i].isascii() and not text[i].isalpha()
    ]


def join_encoded(c, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], first=WINDOW):
    """Text and ids of two neighbours that were encoded alone."""
    (lt, li), (rt, ri) = left, right
    if not lt or not rt:
        return lt + rt, np.concatenate([li, ri])
    from_end = np.cumsum(c.lengths[li[::-1]])  # bytes of the last 1, 2, ... tokens
    from_start = np.cumsum(c.lengths[ri])
    reach = first
    while True:
        tail, head = lt[-4 * reach :], rt[: 4 * reach]
        whole_left, whole_right = len(tail) == len(lt), len(head) == len(rt)
        edges = (
            _edge_left(c, lt, li, tail, from_end, tail + head),
            _edge_right(c, rt, ri, head, from_start, tail + head),
        )
        if whole_left and edges[0] is None:
            edges = ((0, 0), edges[1])
        if whole_right and edges[1] is None:
            edges = (edges[0], (len(rt), len(ri)))
        if None not in edges:
            (a, i), (b, j) = edges
            middle = np.frombuffer(c.encode(lt[a:] + rt[:b]), "<u4")
            if _agree(c, li, i, a, lt, middle, ri, j, b, rt):
                return lt + rt, np.concatenate([li[:i], middle, ri[j:]])
        if whole_left and whole_right:
            return lt + rt, np.frombuffer(c.encode(lt + rt), "<u4")
        reach *= 2


def _edge_left(c, text, ids, tail, from_end, around):
    """Character and token of ``text`` at which the window starts, or None."""
    places = _hard_places(tail)
    if places:
        at = len(text) - len(tail) + places[0]
        size = len(text[at:].encode())
        k = int(np.searchsorted(from_end, size))
        return (at, len(ids) - 1 - k) if from_end[k] == size else None
    if not around.isalpha():
        return None
    return _token_edge(c, ids, from_end, len(tail.encode()), text, True)


def _edge_right(c, text, ids, head, from_start, around):
    places = _hard_places(head)
    if places:
        at = places[-1]
        size = len(text[:at].encode())
        k = int(np.searchsorted(from_start, size))
        return (at, k + 1) if from_start[k] == size else None
    if not around.isalpha():
        return None
    return _token_edge(c, ids, from_start, len(head.encode()), text, False)


def _token_edge(c, ids, sums, most, text, left):
    """The furthest token boundary within ``most`` bytes that is one of characters too."""
    raw = text.encode()
    for k in range(int(np.searchsorted(sums, most, "right")) - 1, -1, -1):
        size = int(sums[k])
        at = len(raw) - size if left else size
        if at in (0, len(raw)) or raw[at] & 0xC0 != 0x80:
            chars = len(raw[:at].decode())
            return (chars, len(ids) - 1 - k) if left else (chars, k + 1)
    return None


def _agree(c, li, i, a, lt, middle, ri, j, b, rt) -> bool:
    def fits(x: int, y: int) -> bool:
        return c.one_piece(c.pieces[x] + c.pieces[y]) == [x, y]

    inside_left = 0 < a and lt[a - 1].isalpha() and lt[a : a + 1].isalpha()
    inside_right = b < len(rt) and rt[b - 1 : b].isalpha() and rt[b].isalpha()
    if inside_left and (not len(middle) or i == 0 or not fits(int(li[i - 1]), int(middle[0]))):
        return False
    return not (
        inside_right and (not len(middle) or j >= len(ri) or not fits(int(middle[-1]), int(ri[j])))
    )


def join_all(c, leaves: list[tuple[str, np.ndarray]]) -> tuple[str, np.ndarray]:
    """Joins neighbours pair by pair until one is left."""
    while len(leaves) > 1:
        pairs = [leaves[i : i + 2] for i in range(0, len(leaves), 2)]
        leaves = [join_encoded(c, *p) if len(p) == 2 else p[0] for p in pairs]
    return leaves[0]


def _digests(c, ids: bytes) -> tuple[int, str, str]:
    decoded = c.decode(ids).encode("utf-8")
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encoded_texts(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs``: doc_id and its ids as little-endian
    unsigned 32-bit numbers (``ids``)."""
    path = vocabulary or vocabulary_path()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    size = F.length("t")

    def short(batches):
        c = codec(path)
        for b in batches:
            ids = c.encode_all(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"]
            )

    def leaves(batches):
        c = codec(path)
        for b in batches:
            ids = c.encode_all(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.binary())], [*b.schema.names, "ids"]
            )

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        c = codec(path)
        times = int((rows["n"] == 0).sum())  # equal rows have equal leaves
        rows = rows.drop_duplicates("n").sort_values("n")
        parts = [(t, np.frombuffer(i, "<u4")) for t, i in zip(rows["t"], rows["ids"])]
        ids = join_all(c, parts)[1].tobytes()
        return pd.DataFrame({"doc_id": [key[0]] * times, "ids": [ids] * times}).astype(
            {"doc_id": "Int64"}
        )

    one = d.where(size <= leaf).mapInArrow(short, "doc_id long, ids binary")
    cut = d.where(size > leaf).select(
        "doc_id",
        F.xxhash64("t").alias("k"),
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.floor((size - 1) / leaf).cast("int")),
                lambda i: F.substr("t", i * leaf + 1, F.lit(leaf)),
            )
        ).alias("n", "t"),
    )
    cut = cut.repartition("doc_id", "k", "n").mapInArrow(
        leaves, "doc_id long, k long, n int, t string, ids binary"
    )
    many = cut.groupBy("doc_id", "k").applyInPandas(joined, "doc_id long, ids binary")
    return one.unionByName(many)


def query(spark, sf_dir):
    path = vocabulary_path()

    def digests(batches):
        c = codec(path)
        for b in batches:
            rows = [_digests(c, i) for i in b.column("ids").to_pylist()]
            n, h, d = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(h, pa.string()),
                    pa.array(d, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encoded_texts(table(spark, sf_dir, "documents"), path).mapInArrow(digests, SCHEMA)
