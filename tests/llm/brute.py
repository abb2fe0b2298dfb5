"""Plain computations of the results, for small inputs."""

import base64
import hashlib
import re
import zlib

import numpy as np


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def jaccard_components(docs):
    """{row number: (n_shingles, component_id)} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    comp = list(range(len(docs)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def repeated_bytes(docs, width=100):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of (doc_id, text) rows with distinct ids."""
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - width + 1):
            w = raw[i : i + width]
            if w in seen:
                gone[i] += 1
                gone[min(i + width, len(raw))] -= 1
            seen.add(w)
        cut = np.cumsum(gone)[: len(raw)] > 0
        kept = np.frombuffer(raw, np.uint8)[~cut].tobytes()
        spans = int((cut & ~np.concatenate([[False], cut[:-1]])).sum()) if len(raw) else 0
        out.append((d, len(raw), int(cut.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def neighbours(rows, k=10, step=100):
    """{query: [(vec_id, score)]} of (vec_id, vector) rows with distinct ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % step == 0):
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        far[q] = np.inf
        best = np.lexsort((ids, far))[: min(k, len(ids) - 1)]
        out[int(ids[q])] = [(int(ids[j]), float(far[j])) for j in best]
    return out


def sha1_base32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def check_packing(pieces, ids_of, end=1, size=2048):
    """Asserts what a packing must satisfy; ids_of: {doc_id: ids with the end}.
    pieces: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""
    by_doc, by_seq = {}, {}
    for d, start, length, crc, n, seq, off in pieces:
        ids = ids_of[d]
        assert n == len(ids) and ids[-1] == end and length > 0
        assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
        by_doc.setdefault(d, []).append((start, length))
        by_seq.setdefault(seq, []).append((off, length))
    assert set(by_doc) == set(ids_of)
    for d, got in by_doc.items():
        at = 0
        for start, length in sorted(got):
            assert start == at
            at += length
        assert at == len(ids_of[d])
    short = 0
    for got in by_seq.values():
        at = 0
        for off, length in sorted(got):
            assert off == at
            at += length
        assert at <= size
        short += at < size
    return short
