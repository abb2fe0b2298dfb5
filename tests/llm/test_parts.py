"""Parts of the operators that need no Spark, against plain computations."""

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm import brute
from tidelog.llm import shingles as sh
from tidelog.llm import column_bwt
from tidelog.llm import suffix_dedup as sd
from tidelog.llm.adaptive_ann import rotation, scan_block
from tidelog.llm.bpe import codec, vocabulary_path
from tidelog.llm.bpe_tree import join_all, join_encoded
from tidelog.llm.column_bwt import equal_windows
from tidelog.llm.hilbert_pack import hilbert_key
from tidelog.llm.jaccard_join import prefix_length, required, verify
from tidelog.llm.training_order import feistel
from tidelog.llm.warc_chain import parse_candidate


@pytest.fixture(scope="module")
def c():
    return codec(vocabulary_path())


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda x: t.encode(x, add_special_tokens=False).ids


def _ids(c, text):
    return np.frombuffer(c.encode(text), "<u4")


PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'", "ll", "é", "中", "1", "23", "!", "...", "|>"]
PARTS += ["<|endoftext|>", "<|", "the", "tion", "😀", "\r\n", "ing", "zz", "’", "endoftext"]


def test_every_vocabulary_entry_encodes_to_itself(c):
    assert all(c.one_piece(c.pieces[i]) == [i] for i in range(50256))


def test_encoding_equals_the_library(c, reference):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 30)))
        assert _ids(c, text).tolist() == reference(text)
        assert c.decode(c.encode(text)) == text


def test_tree_of_leaves_equals_the_whole(c, reference):
    rng = random.Random(2)
    for _ in range(600):
        text = "".join(rng.choices(PARTS, k=rng.randint(1, 30)))
        n = rng.randint(1, 12)
        leaves = [text[i : i + n] for i in range(0, len(text), n)]
        got = join_all(c, [(x, _ids(c, x)) for x in leaves])
        assert got[0] == text and got[1].tolist() == reference(text)


def test_join_within_a_long_run_of_letters(c, reference):
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(["th", "e", "ion", "a", "zq", "ou", "r", "é"], k=rng.randint(40, 200)))
        cut = rng.randint(1, len(text) - 1)
        sides = [(x, _ids(c, x)) for x in (text[:cut], text[cut:])]
        assert join_encoded(c, *sides, 2)[1].tolist() == reference(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab\x00ÿ", max_size=20).map(lambda s: s.encode("latin-1")), max_size=8), st.integers(1, 7))
def test_column_wise_windows(strings, width):
    who, offset, group = equal_windows(strings, width)
    want = {
        (i, o): s[o : o + width] for i, s in enumerate(strings) for o in range(len(s) - width + 1)
    }
    got = dict(zip(zip(who.tolist(), offset.tolist()), group.tolist()))
    assert set(got) == set(want)
    of = {}
    for k, g in got.items():
        of.setdefault(g, set()).add(want[k])
    assert all(len(x) == 1 for x in of.values())
    assert len(of) == len(set(want.values()))


def test_transform_sorts_only_the_rows_that_wait(monkeypatch):
    """A round's work doesn't grow with the rows of the transform."""
    rng = random.Random(7)
    strings = [bytes(rng.choices(b"abc", k=129)) for _ in range(40)]
    sorted_rows, argsort = [], np.argsort

    def counted(x, *args, **kwargs):
        sorted_rows.append(len(x))
        return argsort(x, *args, **kwargs)

    monkeypatch.setattr(np, "argsort", counted)
    equal_windows(strings, 66)
    assert sum(sorted_rows) < 10 * sum(map(len, strings))


@pytest.mark.parametrize("columns, compared", [(1, 1), (2, 3), (5, 1 << 16), (300, 7)])
def test_windows_at_any_number_of_waiting_columns(columns, compared, monkeypatch):
    monkeypatch.setattr(column_bwt, "COLUMNS", columns)
    monkeypatch.setattr(column_bwt, "COMPARED", compared)
    rng = random.Random(8)
    for _ in range(20):
        strings = [bytes(rng.choices([0, 97, 255], k=rng.randint(0, 40))) for _ in range(rng.randint(1, 9))]
        who, offset, group = equal_windows(strings, 4)
        got = {(i, o): g for i, o, g in zip(who.tolist(), offset.tolist(), group.tolist())}
        want = {(i, o): s[o : o + 4] for i, s in enumerate(strings) for o in range(len(s) - 3)}
        assert set(got) == set(want)
        assert len(set(got.values())) == len(set(want.values())) == len({(got[k], want[k]) for k in got})


def _contexts(anchors, rng):
    """Three contexts of each anchor, the last two with a window in common;
    all anchors have the same bytes around them."""
    around = [bytes(rng.choices(b"xyz", k=64)) for _ in range(4)]
    rows = []
    for i, a in enumerate(anchors):
        for doc, (x, y) in enumerate([(0, 1), (2, 3), (2, 3)]):
            s = around[x] + a + around[y] if doc < 2 else around[x][-50:] + a + around[y][:60]
            left = 64 if doc < 2 else 50
            rows.append((i, 10 - doc, -doc, (1000 * i + left) << 16 | left << 8 | len(s) - left, s))
    return pd.DataFrame(rows, columns=["anchor", "doc", "th", "at", "s"])


def test_anchors_beyond_the_free_bytes_share_a_collection():
    rng = random.Random(9)
    rows = _contexts([bytes(rng.choices(b"abc", k=sd.GRAM)) for _ in range(300)], rng)
    assert [len(x) for x, _ in sd._collections(rows)] == [600]
    got = sd._repeats(rows)
    # the document with the smaller id, 8, starts earlier: 9 loses what 8 holds
    want = [(9, -1, 1000 * i + 14, 1000 * i + 64 + sd.GRAM + 60) for i in range(300)]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)


@pytest.mark.parametrize("n", [1, 2, 3, 100, 1023, 1024, 1025, 40_000])
def test_feistel_permutes(n):
    slots = feistel(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    if n > 1000:
        assert (slots != np.arange(n)).mean() > 0.9
        assert (feistel(np.arange(n), n, 7) != slots).any()


@pytest.mark.parametrize("dims", [2, 3, 4])
def test_hilbert_neighbours_are_adjacent(dims):
    side = np.arange(1 << 2)
    cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = hilbert_key(cells, 2)
    assert sorted(key.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


TEXTS = ["a b c d e f", "A  B\tc\nd e F", "", "x y", None, " a b c d e f ", "é b c d e", "a b c d e a b c d e"]


@pytest.mark.parametrize("part", [1 << 21, 7, 1])
def test_shingle_sets(part, monkeypatch):
    monkeypatch.setattr(sh, "PART", part)
    sets = sh.shingle_sets(pa.array(TEXTS).slice(0))
    want = [brute.shingles(t) for t in TEXTS]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for s, w in zip(sets, want):
        for s2, w2 in zip(sets, want):
            assert len(np.intersect1d(s, s2)) == len(w & w2)
    assert [len(s) for s in sh.shingle_sets(pa.array(TEXTS).slice(3))] == [len(w) for w in want[3:]]


def test_verify_finds_exactly_the_links():
    rng = np.random.default_rng(4)
    u = np.arange(60, dtype=np.uint64)
    for _ in range(300):
        a = np.sort(rng.choice(u, rng.integers(1, 30), replace=False))
        members = [
            np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1)), rng.choice(u, rng.integers(0, 4))]))
            for _ in range(rng.integers(1, 9))
        ]
        both = [(len(np.intersect1d(a, m)), len(np.union1d(a, m))) for m in members]
        want = [(i, n) for i, (n, all_) in enumerate(both) if 100 * n >= 80 * all_]
        assert verify(a, members) == want


def test_required_overlap_and_prefix():
    for na in range(1, 60):
        for nb in range(1, 60):
            least = next(i for i in range(200) if 100 * i >= 80 * (na + nb - i))
            assert required(na, nb) == least
        # a partner holds at least 0.8 n of the shingles, so it meets the prefix
        assert na - prefix_length(na) < -(-80 * na // 100)


@pytest.mark.parametrize("part", [1 << 21, 400, 256])
def test_anchors_meet_every_equal_window(part, monkeypatch):
    """Equal windows have equal anchors at equal places, however texts are cut into parts."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdefgh é", k=400))
    texts = ["".join(rng.choices("xyzu ", k=rng.randint(0, 300))) for _ in range(8)]
    texts = [t + passage[rng.randint(0, 200) :] + t[:50] for t in texts] + ["a" * 700, None, "short"]
    monkeypatch.setattr(sd, "PART", part)
    found = {}
    for p, first, base in sd.parts(pa.array(texts)):
        if not len(p.at):
            continue
        off = p.offset(base)
        for i in range(len(p.at)):
            doc, raw = first + int(p.doc[i]), p.data[p.lo[i] : p.hi[i]].tobytes()
            at = int(p.lo[i] + off[i])
            assert (texts[doc] or "").encode()[at : at + len(raw)] == raw
            found.setdefault(doc, set()).add((int(p.at[i] + off[i]), int(p.anchor[i])))
    for doc, t in enumerate(texts):
        raw = (t or "").encode()
        places = sorted(found.get(doc, ()))
        for s in range(len(raw) - sd.WIDTH + 1):
            inside = [a for a, _ in places if s <= a <= s + sd.BEFORE]
            assert inside, (doc, s)
    whole = {}
    monkeypatch.setattr(sd, "PART", 1 << 21)
    for p, first, base in sd.parts(pa.array(texts)):
        for i in range(len(p.at)):
            whole.setdefault(first + int(p.doc[i]), set()).add((int(p.at[i] + p.offset(base)[i]), int(p.anchor[i])))
    assert found == whole


def test_merged_spans():
    assert sd.merged_spans([(0, 5), (5, 8), (7, 9), (20, 30)]) == [(0, 9), (20, 30)]
    assert sd.merged_spans([]) == []


@pytest.mark.parametrize("same", [False, True])
def test_adaptive_scan_of_a_block(same):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((900, 64))
    if same:
        x[100:600] = x[0]
    ids = rng.permutation(900)
    found = scan_block(ids[:9], x[:9], ids, x, rotation(64))
    want = brute.neighbours([(int(i) * 100, v) for i, v in zip(ids, x)])
    hits = total = 0
    for q in ids[:9]:
        got = [(b * 100, s) for a, b, s in found if a == q]
        assert len(got) == 10 and got == sorted(got, key=lambda g: (g[1], g[0]))
        hits += len({v for v, _ in got} & {v for v, _ in want[q * 100]})
        total += 10
        if same and x[ids == q][0][0] == x[0][0]:
            assert got == want[q * 100]
    assert hits / total >= 0.95


def test_candidate_headers():
    good = b"1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    row = parse_candidate("p", 0, 10, good)
    assert row[4] == 10 + len(good) and row[5] == 7 and row[-1] and row[-3:-1] == (2, brute.sha1_base32(b"hi"))
    for bad in (b"", b"1\r\n", b"1 is a version\r\n\r\n", b"1\r\nContent-Length: -4\r\n\r\n", b"1\r\nContent-Length: x\r\n\r\n", b"\xff\r\n\r\n"):
        assert parse_candidate("p", 0, 0, bad)[4] is None
    assert zlib.crc32(b"") == 0


def test_contexts_that_share_no_half_hold_no_repeats(monkeypatch):
    """Leaving them out changes no span."""
    rng = np.random.default_rng(5)
    rows, anchors = [], [rng.bytes(sd.GRAM) for _ in range(4)]
    pieces = [rng.bytes(16) for _ in range(5)]
    for i in range(300):
        left = b"".join(pieces[j] for j in rng.integers(0, 5, 4))[int(rng.integers(0, 40)) :]
        right = b"".join(pieces[j] for j in rng.integers(0, 5, 4))[: int(rng.integers(24, 65))]
        number = int(rng.integers(0, 4))
        s = left + anchors[number] + right
        rows.append((number, i, 0, 1000 << 16 | len(left) << 8 | len(s) - len(left), s))
    f = pd.DataFrame(rows, columns=["anchor", "doc", "th", "at", "s"])
    kept = len(sd._with_a_half(f))
    got = sorted(map(tuple, sd._repeats(f).to_numpy().tolist()))
    monkeypatch.setattr(sd, "_with_a_half", lambda rows: rows)
    assert got == sorted(map(tuple, sd._repeats(f).to_numpy().tolist()))
    assert got and kept < len(f)
    alone = f[f["anchor"] == 0].iloc[:1]
    monkeypatch.undo()
    assert len(sd._repeats(alone)) == 0
