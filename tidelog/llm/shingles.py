"""Distinct word shingles of texts as 64-bit hashes, for a batch at a time.

Words are runs of bytes other than the ASCII white space, A-Z in lower case.
A word's hash is a polynomial in a random odd base over random byte values;
running sums give all words of a batch at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5
#: Bytes of text that are hashed at a time (a longer text is taken whole).
PART = 1 << 21

_RNG = np.random.default_rng(20260101)
_BYTES = _RNG.integers(0, 2**64, 256, np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_BASE = int(_RNG.integers(0, 2**62)) * 2 + 1
_FACTORS = _RNG.integers(0, 2**63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, PART + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _words(data: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words; ``edge`` marks where texts begin and end."""
    up, down = powers(len(data))
    word = ~_SPACE[data]
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _long_words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one long text, part by part."""
    out, at = [], 0
    while at < len(data):
        to = min(at + PART, len(data))
        while to < len(data) and not _SPACE[data[to]]:
            to += 1
        edge = np.zeros(to - at + 1, bool)
        edge[[0, -1]] = True
        out.append(_words(data[at:to], edge)[1])
        at = to
    return np.concatenate(out)


def _hashes(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; ``offsets`` begins with 0."""
    if not len(data):
        return [np.zeros(0, np.uint64)] * (len(offsets) - 1)
    if len(data) > PART:  # one text
        words = _long_words(data)
        first = np.array([0] * (len(offsets) - 1) + [len(words)])
    else:
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        starts, words = _words(data, edge)
        first = np.searchsorted(starts, offsets)
    five = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        five += words[k : k + len(five)] * _FACTORS[k]
    five = mix(five)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= WORDS:
            out.append(np.unique(five[a : b - WORDS + 1]))
        elif b > a:
            few = (words[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([few], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each text begins in them (and the
    last ends); a null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), offsets


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a string column."""
    data, offsets = text_buffers(texts)
    out, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART, "right")) - 1)
        part = offsets[at : to + 1]
        out += _hashes(data[part[0] : part[-1]], part - part[0])
        at = to
    return out
