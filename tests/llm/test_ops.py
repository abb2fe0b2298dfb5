"""The operators on small tables with every awkward case, against brute force."""

import hashlib
import random
import textwrap
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tests.llm import brute
from tidelog.llm import adaptive_ann, bpe_tree, hilbert_pack, host_quality, jaccard_join
from tidelog.llm import license_digest, line_runs, suffix_dedup, training_order, warc_chain
from tidelog.llm.bpe import vocabulary_path
from tidelog.llm.common import prepare
from tidelog.llm.components import components
from tidelog.session import scratch_path

# further columns whose names the operators use themselves
NAMES = "t k n s a b x h ids kept host row word words lines at doc th pos lo hi cid comp gone key path block"
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField(x, T.StringType()) for x in NAMES.split()]
)


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


def frame(spark, rows):
    """A table of (doc_id, text[, source]) rows with the further columns."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "h", *NAMES.split()) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def texts():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgéü", k=rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    base, passage = prose(120), prose(60)
    out = [base, base, prose(80), None, "", "one two", "One  two", "\n \t", "a b c d e", "A b C d e f"]
    for i in range(12):  # near copies of near copies
        w = out[-1].split() if i and i % 3 else base.split()
        w = w if len(w) > 20 else base.split()
        w[rng.randrange(len(w))] = f"changed{i}"
        out.append(" ".join(w))
    for i in range(12):
        out.append(f"{prose(rng.randint(1, 50))} {passage if i % 2 else passage[40:300]} {prose(20)}")
    lines = [prose(6) for _ in range(8)]
    for i in range(8):
        out.append("\n".join([prose(5), *lines[i % 3 : i % 3 + 4], "", prose(4), *lines[:2]]))
    out += ["x" * 900, "x" * 950, prose(3000), base * 3]
    return out


@pytest.fixture(scope="module")
def docs():
    return list(enumerate(texts()))


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r))


# ------------------------------------------------------------ n-gram Jaccard join


def test_jaccard_components(spark, docs):
    got = rows_of(jaccard_join.jaccard_join(frame(spark, docs)))
    assert by_key(got) == by_key(brute.jaccard_components(docs))
    assert len({c for _, n, c in got if n}) < len([1 for _, n, _ in got if n])


def test_jaccard_in_blocks_and_with_repeats(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MEMBERS", 2)
    more = [*docs, *docs[:14], (None, docs[0][1]), (None, "lonely text of six words here"), (None, None)]
    got = rows_of(jaccard_join.jaccard_join(frame(spark, more)))
    assert by_key(got) == by_key(brute.jaccard_components(more))


@pytest.mark.parametrize("members", [3, 512])
def test_jaccard_chain_across_leaders(spark, monkeypatch, members):
    """Neighbours link, distant ones don't: one component by way of all."""
    monkeypatch.setattr(jaccard_join, "MEMBERS", members)
    words = [f"w{i}" for i in range(220)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(25)]
    got = rows_of(jaccard_join.jaccard_join(frame(spark, rows)))
    assert by_key(got) == by_key(brute.jaccard_components(rows))
    assert {c for *_, c in got} == {0}


def test_jaccard_empty(spark):
    assert rows_of(jaccard_join.jaccard_join(frame(spark, []))) == []
    got = rows_of(jaccard_join.jaccard_join(frame(spark, [(1, None), (2, "")])))
    assert by_key(got) == [(1, 0, 1), (2, 0, 2)]


def test_jaccard_stage_keeps_one_of_each(spark, docs):
    df = frame(spark, [*docs, docs[0], (None, docs[1][1])])
    out = jaccard_join.stage(spark, df, None)
    assert out.columns == df.columns
    want = {d for d, n, c in brute.jaccard_components(docs) if c == d}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)


def test_jaccard_stage_with_null_and_repeated_ids(spark, docs):
    words = [f"n{i}" for i in range(200)]
    copy, other, lonely = " ".join(words[:100]), " ".join(words[100:160]), " ".join(words[160:])
    rows = [
        *docs,
        (None, docs[1][1]),  # a copy of one that has an id
        (None, lonely),  # a unique one
        (None, None),
        (5000, docs[0][1]),  # a later copy, whose id has another text too
        (5000, other),
        (None, copy),  # near copies without any id
        (None, copy + " more"),
        (None, copy + " words"),
        (None, copy),
    ]
    got = rows_of(jaccard_join.stage(spark, frame(spark, rows), None).select("doc_id", "text"))
    kept = {d for d, n, c in brute.jaccard_components(docs) if c == d}
    copies = [r for r in got if r[0] is None and (r[1] or "").startswith(copy)]
    assert len(copies) == 1
    want = [r for r in docs if r[0] in kept] + [(None, lonely), (None, None), (5000, other)]
    assert by_key(r for r in got if r not in copies) == by_key(want)


def test_components(spark):
    pairs = [(5, 4), (4, 3), (3, 9), (10, 11), (12, 11), (7, 7), (2, 9), *[(100, i) for i in range(101, 130)]]
    got = dict(rows_of(components(spark.createDataFrame(pairs, "u long, v long"))))
    assert got == {3: 2, 4: 2, 5: 2, 9: 2, 11: 10, 12: 10, **{i: 100 for i in range(101, 130)}}
    assert rows_of(components(spark.createDataFrame([], "u long, v long"))) == []


# ------------------------------------------------------------ repeated bytes


def spans_of(spark, rows):
    return by_key(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
        for r in suffix_dedup.cut_texts(frame(spark, rows)).collect()
    )


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 2])
def test_repeated_bytes(spark, docs, most, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = [*docs, (None, docs[2][1])]
    got = spans_of(spark, rows)
    assert got == by_key(brute.repeated_bytes(rows))
    assert sum(r[2] for r in got) > 0


def test_repeated_rows_are_one_document(spark, docs):
    got = spans_of(spark, [*docs, *docs])
    want = brute.repeated_bytes(docs)
    assert got == by_key([*want, *want])


def test_repeated_bytes_empty(spark):
    assert spans_of(spark, []) == []
    assert [r[:4] for r in spans_of(spark, [(1, None), (2, "ab")])] == [(1, 0, 0, 0), (2, 2, 0, 0)]


def test_suffix_stage(spark, docs):
    df = frame(spark, docs)
    out = suffix_dedup.stage(spark, df, None)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    want = {r[0]: r for r in brute.repeated_bytes(docs)}
    assert 1 not in got and got[3] is None
    for d, text in docs:
        if want[d][2] == 0:
            assert got[d] == text


# ------------------------------------------------------------ runs of lines


def test_line_runs(spark, docs):
    def windows(text):
        lines = (text or "").split("\n")
        at = [i for i, s in enumerate(lines) if s.strip(" \t\n\x0b\x0c\r")]
        return lines, at, [tuple(lines[j] for j in at[i : i + 3]) for i in range(len(at) - 2)]

    more = [*docs, (None, docs[-10][1]), (900, "p\nq\nr\np\nq\nr\np\nq"), (901, "\n\n\n\n")]
    first, want = {}, {}
    for d, t in sorted(more, key=lambda r: (r[0] is not None, r[0])):
        lines, at, w = windows(t)
        cut = set()
        for i, x in enumerate(w):
            if x in first:
                cut |= set(at[i : i + 3])
            first.setdefault(x, 1)
        kept = "\n".join(s for i, s in enumerate(lines) if i not in cut) if t is not None else None
        want[d] = (kept, len(at), len(cut))
    df = frame(spark, more)
    out = line_runs.drop_repeated_lines(df)
    assert out.columns == [*df.columns, "lr_lines", "lr_removed"]
    got = {r["doc_id"]: (r["text"], r["lr_lines"], r["lr_removed"]) for r in out.collect()}
    assert got == want
    assert sum(x[2] for x in got.values()) > 6
    twice = line_runs.drop_repeated_lines(df.unionByName(df)).collect()
    assert {r["doc_id"]: (r["text"], r["lr_lines"], r["lr_removed"]) for r in twice} == want
    assert len(twice) == 2 * len(more)
    assert line_runs.drop_repeated_lines(frame(spark, [])).count() == 0


def test_line_stage_finds_long_passages_on_few_lines(spark, docs):
    def passage(n, word):
        return " ".join(f"{word}{i}" for i in range(n))

    def windows(text):
        lines = (text or "").split("\n")
        at = [i for i, s in enumerate(lines) if s.strip(" \t\n\x0b\x0c\r")]
        out = []
        for i in range(len(at)):
            for size in (1, 2, 3):
                part = [lines[j] for j in at[i : i + size]]
                if len(part) == size and (size == 3 or sum(len(s.split()) for s in part) > line_runs.LONG_WORDS):
                    out.append((tuple(part), at[i : i + size]))
        if 0 < len(at) < 3 and not any(len(p) == len(at) for p, _ in out):
            out.append((("whole", *[lines[j] for j in at]), at))
        return lines, at, out

    long, left, right = passage(51, "a"), passage(30, "b"), passage(21, "c")
    more = [
        *docs,
        (800, f"{long}\nx1\nx2\n{left}\n{right}\n{passage(50, 'd')}\nshort line"),
        (801, f"y1\n{long}\ny2"),  # one line
        (802, f"z1\nz2\n{left}\n \n{right}"),  # two lines
        (803, f"v1\n{passage(50, 'd')}\nv2"),  # 50 words aren't more than 50
        (804, "short line"),
        (805, "short line\n"),  # the whole text again
        (806, long),
        (807, f"{long}\n{long}"),
    ]
    seen, want = set(), {}
    for d, t in sorted(more):
        lines, at, found = windows(t)
        cut = set()
        for content, places in found:
            cut |= set(places) if content in seen else set()
            seen.add(content)
        if not at or len(cut) < len(at):
            want[d] = "\n".join(s for i, s in enumerate(lines) if i not in cut) if t is not None else None
    got = {r["doc_id"]: r["text"] for r in line_runs.stage(spark, frame(spark, more), None).collect()}
    assert got == want
    assert got[801] == "y1\ny2" and got[802] == "z1\nz2\n " and got[804] == "short line"
    assert got[803].count("\n") == 2 and not {1, 805, 806, 807} & set(got)


def test_line_runs_of_few_different_lines(spark):
    """Hot lines in many contexts, against all windows by content."""
    rng = np.random.default_rng(11)
    rows = []
    for d in range(150):
        lines = [f"line {x}" for x in rng.zipf(1.5, int(rng.integers(0, 14))) % 9]
        rows.append((d, "\n".join(lines)))
    seen, want = set(), {}
    for d, t in rows:
        lines, cut = t.split("\n") if t else [], set()
        for i in range(len(lines) - 2):
            if tuple(lines[i : i + 3]) in seen:
                cut |= set(range(i, i + 3))
            seen.add(tuple(lines[i : i + 3]))
        want[d] = ("\n".join(s for i, s in enumerate(lines) if i not in cut), len(cut))
    got = line_runs.drop_repeated_lines(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["text"], r["lr_removed"]) for r in got} == want


def test_line_runs_fingerprints(spark):
    """A row for each selected line alone; every window selects one of its lines."""
    text = "\n".join(f"line {i * i % 101}" for i in range(60))
    rows = line_runs.fingerprints(frame(spark, [(1, text)])).orderBy("at").collect()
    assert len({r["at"] for r in rows}) == len(rows) < 50
    windows = {i: r["at"] for r in rows for i in range(r["start"], r["end"] - 2)}
    assert sorted(windows) == list(range(58))
    assert all(i <= at < i + 3 for i, at in windows.items())


def test_line_runs_with_clashing_names(spark):
    names = ["lr_key", "lr_lines", "lr_removed", "k_id", "k_text", "row", "lines", "removed", "raw", "cut", "starts"]
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc"), (3, None)]
    df = frame(spark, rows)
    for i, name in enumerate(names):
        df = df.withColumn(name, F.lit(i))
    kept = line_runs.stage(spark, df, None)
    assert kept.columns == df.columns
    got = {r["doc_id"]: r for r in kept.collect()}
    assert got[2]["text"] == "x" and got[1]["text"] == rows[0][1] and got[3]["text"] is None
    assert all([r[n] for n in names] == list(range(len(names))) for r in got.values())
    out = line_runs.drop_repeated_lines(df).where("doc_id = 2").collect()
    assert [(r["lr_lines"], r["lr_removed"], r["lr_key"]) for r in out] == [(4, 3, 0)]


# ------------------------------------------------------------ host rules


def test_host_quality(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "good") for i in range(20)] + [(100 + i, "too short", "bad") for i in range(30)]
    rows += [(200, good, "bad"), (201, "ab ab ab " * 30, "good"), (202, None, None), (203, "", None), (204, good, None)]
    rows += [(205, "\n".join(["same line"] * 3 + [good]), "good"), (None, good, "good"), (206, "#$ " + good, "good")]
    df = frame(spark, rows + rows[:1])
    got = {r["doc_id"]: r for r in host_quality.host_quality(df).collect()}
    assert len(got) == len(rows)
    assert got[0]["kept"] and got[None]["kept"] and not got[100]["kept"]
    assert not got[200]["base_failed"] and not got[200]["kept"] and got[200]["host_rate"] > 0.8
    assert got[201]["base_failed"] and got[201]["n_repeat_words"] == 90
    assert got[202]["n_words"] == 0 and got[202]["base_failed"]
    assert (got[205]["n_dup_lines"], got[205]["n_lines"]) == (2, 4)
    assert got[206]["n_symbols"] == 2
    kept = host_quality.stage(spark, df, None)
    assert kept.columns == df.columns
    expected = [r["doc_id"] for r in host_quality.host_quality(df).collect() if r["kept"]]
    assert by_key([(r["doc_id"],) for r in kept.collect()]) == by_key([(d,) for d in expected])
    assert host_quality.host_quality(frame(spark, [])).collect() == []


def test_hosts_are_judged_against_the_others(spark):
    """A host far above the others goes, one near the border stays."""
    good = " ".join(f"word{i}" for i in range(60))
    rows, number = [], 0
    failures = {f"normal{i}": 10 + i % 5 for i in range(24)} | {"junk": 60, "border": 23}
    for host, bad in failures.items():
        for i in range(100):
            rows.append((number, "too short" if i < bad else good, host))
            number += 1
    got = host_quality.host_quality(frame(spark, rows)).collect()
    kept = {h: sum(r["kept"] for r in got if r["host"] == h) for h in failures}
    assert kept == {h: 0 if h == "junk" else 100 - bad for h, bad in failures.items()}
    # hosts that are all alike aren't judged by tiny differences
    alike = [(i, "too short" if i % 100 < 10 + (i // 100 == 29) else good, f"h{i // 100}") for i in range(3000)]
    assert all(r["kept"] != r["base_failed"] for r in host_quality.host_quality(frame(spark, alike)).collect())


# ------------------------------------------------------------ encoding


def reference_ids(rows):
    t = Tokenizer.from_file(vocabulary_path())
    return [(d, t.encode(x or "", add_special_tokens=False).ids) for d, x in rows]


def test_encoded_texts(spark, docs):
    more = [*docs, docs[-2], docs[-2], (None, docs[-2][1]), (None, "<|endoftext|>"), (777, "中文" * 400)]
    got = bpe_tree.encoded_texts(frame(spark, more), leaf=256)
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got.collect()]
    assert by_key((d, str(i)) for d, i in got) == by_key((d, str(i)) for d, i in reference_ids(more))
    assert bpe_tree.encoded_texts(frame(spark, [])).collect() == []


def test_packing(spark, docs):
    rows = [*docs, (900, docs[-2][1])]
    got = hilbert_pack.hilbert_pack(frame(spark, rows)).collect()
    pieces = [(r[0], r[1], r[2], zlib.crc32(r[3]), *r[4:]) for r in got]
    ids = {d: x + [1] for d, x in reference_ids(rows)}
    short = brute.check_packing(pieces, ids)
    assert short <= spark.sparkContext.defaultParallelism * 4
    assert hilbert_pack.hilbert_pack(frame(spark, [])).collect() == []
    repeated = hilbert_pack.hilbert_pack(frame(spark, [(None, None), (None, "a b"), (1, "c"), (1, "c")])).collect()
    assert sum(r["length"] for r in repeated) == 1 + 3 + 2 + 2


@pytest.mark.parametrize("tasks", [training_order.MOST_TASKS, 3])
def test_training_order(spark, docs, monkeypatch, tasks):
    monkeypatch.setattr(training_order, "SHARD", 8)
    monkeypatch.setattr(training_order, "MOST_TASKS", tasks)
    rows = [*docs, docs[0], (None, None)]
    source = scratch_path(spark, "source")
    frame(spark, rows).repartition(3).write.parquet(source)
    folder = scratch_path(spark, "order")
    manifest = training_order.write_training_order(spark.read.parquet(source), folder).collect()
    sequences = {}
    for d, ids in reference_ids(rows):
        ids = ids + [training_order.END_ID]
        for p, at in enumerate(range(0, len(ids), 512)):
            part = ids[at : at + 512]
            sequences.setdefault((d, p, len(part)), []).append(part + [0] * (512 - len(part)))
    n = sum(map(len, sequences.values()))
    assert sorted(r["slot"] for r in manifest) == list(range(n))
    back = {r["slot"]: np.frombuffer(r["ids"], "<u2").tolist() for r in training_order.read_training_order(spark, folder, 2).collect()}
    assert len(back) == n
    for r in manifest:
        assert back[r["slot"]] in sequences[r["doc_id"], r["part"], r["n_ids"]]
        assert r["byte_offset"] == r["slot"] % 8 * 1024 and r["shard"] == r["slot"] // 8
    later = {r["slot"]: np.frombuffer(r["ids"], "<u2").tolist() for r in training_order.read_training_order(spark, folder, 2, 13).collect()}
    assert later == {s: x for s, x in back.items() if s >= 13}


def test_training_order_query(spark):
    """Every row of the query, its ids' checksum included, against the library."""
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, ids in reference_ids([(r["doc_id"], r["text"]) for r in source]):
        ids = ids + [training_order.END_ID]
        for p, at in enumerate(range(0, len(ids), training_order.STRIDE)):
            part = ids[at : at + training_order.STRIDE]
            padded = part + [training_order.PAD_ID] * (training_order.STRIDE - len(part))
            want[d, p] = (len(part), zlib.crc32(np.array(padded, "<u2").tobytes()))
    got = training_order.query(spark, "/root/testdata/sf0.001").collect()
    assert {(r["doc_id"], r["part"]): (r["n_ids"], r["ids_crc32"]) for r in got} == want
    assert sorted(r["slot"] for r in got) == list(range(len(want)))
    size = 2 * training_order.STRIDE
    assert all(r["byte_offset"] == r["slot"] % training_order.SHARD * size for r in got)


def with_other_cores(spark, monkeypatch, module, name, cores, later, after):
    """The number of cores that scans are planned with changes when
    ``module.name`` has run (or begins)."""
    inner, key = getattr(module, name), "spark.sql.leafNodeDefaultParallelism"
    for k, v in ((key, cores), ("spark.sql.files.openCostInBytes", "16b")):
        spark.conf.set(k, v)

    def changed(*args):
        out = inner(*args) if after else None
        spark.conf.set(key, later)
        return out if after else inner(*args)

    monkeypatch.setattr(module, name, changed)


@pytest.fixture
def cores_back(spark):
    yield
    for k in ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def test_training_order_with_cores_that_change(spark, monkeypatch, cores_back):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(90)]
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "order")
    frame(spark, rows).coalesce(1).write.option("parquet.block.row.count.limit", "10").parquet(source)
    with_other_cores(spark, monkeypatch, training_order, "split_counts", 2, 7, after=True)
    manifest = training_order.write_training_order(spark.read.parquet(source), folder).collect()
    assert sorted(r["slot"] for r in manifest) == list(range(90))
    assert sorted(r["doc_id"] for r in manifest) == list(range(90))
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_training_order_empty(spark):
    source, folder = scratch_path(spark, "source"), scratch_path(spark, "order")
    frame(spark, []).write.parquet(source)
    empty = spark.read.schema(SCHEMA).parquet(source)
    assert training_order.write_training_order(empty, folder).collect() == []
    assert training_order.read_training_order(spark, folder, 2).collect() == []


# ------------------------------------------------------------ licences


def test_license_lookup(spark):
    mit = license_digest.KNOWN["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n\n" + mit.upper()),
        (2, mit.replace(" ", "\n\t").replace("sublicense", "sublicense") + "\n"),
        (3, mit + " and more"),
        (4, None),
        (5, ""),
        (6, "released under the -- “MIT” licence"),
        (None, "Licenced under CC BY-NC 4.0!"),
        (7, " # (C) 1999 x\nreleased under the mit license"),
        (7, "licence licence licences"),
    ]
    got = rows_of(license_digest.license_lookup(frame(spark, rows), license_digest.known_licenses(spark)))
    assert by_key((d, x) for d, _, x in got) == by_key(
        [(1, "MIT"), (2, "MIT"), (3, None), (4, None), (5, None), (6, "notice:MIT"), (None, "notice:CC-BY-NC-4.0"), (7, "notice:MIT"), (7, None)]
    )
    own = spark.createDataFrame([("b", "License, license licenses"), ("a", "LICENCE licence licences"), ("c", "..")], "license_id string, text string")
    got = rows_of(license_digest.license_lookup(frame(spark, rows), own))
    assert [(d, x) for d, _, x in got if x] == [(7, "a")]
    assert license_digest.license_lookup(frame(spark, []), own).collect() == []


def test_license_files(spark):
    """Files as they are distributed: titles, notices, wrapped lines."""
    k = license_digest.KNOWN
    notice = "Copyright (c) 2021, Some One <one@example.org>\nAll rights reserved.\n\n"
    rows = [
        (1, "MIT License\n\n" + notice + textwrap.fill(k["MIT"], 78)),
        (2, "The MIT License (MIT)\n\nCopyright © 2001 x\n\n" + textwrap.fill(k["MIT"], 60)),
        (3, "ISC License\n\n" + notice + textwrap.fill(k["ISC"], 70)),
        (4, "BSD 3-Clause License\n\n" + notice + textwrap.indent(textwrap.fill(k["BSD-3-Clause"], 70), "# ")),
        (5, notice + k["BSD-2-Clause"]),
        (6, textwrap.fill(k["Unlicense"], 72)),
        (7, "zlib License\n\n(C) 1999 x\n\n" + k["Zlib"]),
        (8, "All rights reserved by the author\n" + k["MIT"]),
        (9, "MIT License\n\n" + k["ISC"]),
        (10, k["MIT"] + "\n" + "word " * 500_000),
    ]
    want = {1: "MIT", 2: "MIT", 3: "ISC", 4: "BSD-3-Clause", 5: "BSD-2-Clause", 6: "Unlicense", 7: "Zlib"}
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    for i, (name, license_id) in enumerate(files.items()):
        file = Path("/usr/share/common-licenses") / name  # the texts aren't in the repository
        if file.exists():
            text = file.read_text(encoding="utf-8")
            rows += [(100 + i, text.upper()), (200 + i, textwrap.indent(text, "  ")), (300 + i, text + " and more")]
            want |= {100 + i: license_id, 200 + i: license_id}
    got = license_digest.digest_lookup(frame(spark, rows), license_digest.known_digests(spark)).collect()
    assert {r["doc_id"]: r["license_id"] for r in got} == {d: want.get(d) for d, _ in rows}


# ------------------------------------------------------------ nearest neighbours


def test_search(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 16))
    x[200:700] = x[0]
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    odd = [(2000, None), (2100, []), (2200, [0.0] * 16), (2300, [float("nan")] * 16), (2400, [None] + [1.0] * 15)]
    odd += [(2500, [1.0, 2.0]), (2600, [float("inf")] * 16), (None, [1.0] * 16), rows[0], rows[5]]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows + odd], "vec_id long, embedding array<double>, list long, v string")
    got = {}
    for r in adaptive_ann.search(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute.neighbours(rows)
    assert set(got) == set(want)
    hits = 0
    for q, best in want.items():
        assert [g[0] for g in got[q]] == list(range(1, 11))
        hits += len({v for v, _ in best} & {g[1] for g in got[q]})
        exact = dict(brute.neighbours(rows, k=1500)[q]) if q == 0 else None
        if exact:
            assert all(abs(exact[v] - s) < 1e-12 for _, v, s in got[q])
    assert hits / sum(map(len, want.values())) >= 0.9
    assert [g[1:] for g in got[0]] == [(i, 0.0) for i in range(200, 210)]


def test_search_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert adaptive_ann.search(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 1.0]), (100, [3.0, 0.0])], schema)
    got = [tuple(r) for r in adaptive_ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 7, 2**0.5), (0, 2, 100, 2.0), (100, 1, 0, 2.0), (100, 2, 7, 10**0.5)]


# ------------------------------------------------------------ archives

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


@pytest.mark.parametrize("split", ["128m", "300b"])
def test_archives(spark, split):
    page = "<p>é</p>" * 20
    rows = [
        (1, "http://a", page), (2, "http://b", page), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://c", "x" * 700),
        (6, "http://d", INNER), (7, "http://e", "WARC/1.1 " * 30), (8, "http://f", f"before{INNER}{INNER}"),
        (9, "http://g", INNER.strip()), (10, "http://h", "WARC/1."), (None, "http://i", page), (11, "http://j", page + "2"),
        (None, "http://k", "only here"), (1, "http://a", page),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, n string, digest string")
    folder = scratch_path(spark, "warc")
    warc_chain.write_warc(df.coalesce(2), folder)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        raw, own = (h or "").encode(), first.get(h or "")
        kind = ("revisit", own) if own is not None and own != i else ("response", None)
        want.append((i, len(raw), brute.sha1_base32(raw), *kind))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = [tuple(r) for r in warc_chain.read_warc(spark, folder).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert by_key(got) == by_key(want)


def test_archives_with_cores_that_change(spark, monkeypatch, cores_back):
    rows = [(i, f"http://{i}", f"{i} {INNER}" * (i % 4 + 1)) for i in range(40)]
    folder = scratch_path(spark, "warc")
    warc_chain.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    with_other_cores(spark, monkeypatch, warc_chain, "_put_together", 9, 2, after=False)
    got = {r["page_id"]: r["payload_digest"] for r in warc_chain.read_warc(spark, folder).collect()}
    assert got == {i: brute.sha1_base32(h.encode()) for i, _, h in rows}


def test_empty_archives(spark):
    folder = scratch_path(spark, "warc")
    warc_chain.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc_chain.read_warc(spark, folder).collect() == []
