"""The registered queries and the pipeline's stages on the smallest tables."""

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF001
from tests.llm import brute
from tidelog.llm import queries as llm
from tidelog.llm.bpe import vocabulary_path
from tidelog.llm.common import materialise, prepare


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(llm.oracle_sql()))
def test_query_matches_its_sql(spark, duck, key):
    df = llm.queries()[key](spark, SF001)
    cols = sorted(df.columns)
    want = duck.execute(llm.oracle_sql()[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
    assert sorted(str(tuple(r)) for r in df.select(*cols).collect()) == want


def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def test_query_names():
    assert [k.split("_")[0] for k in llm.queries()] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]


def test_jaccard_query(spark, duck):
    got = [tuple(r) for r in llm.queries()["op9_jaccard_join"](spark, SF001).collect()]
    assert sorted(got) == sorted(brute.jaccard_components(documents(duck)))


def test_suffix_query(spark, duck):
    got = [tuple(r) for r in llm.queries()["op10_suffix_dedup"](spark, SF001).collect()]
    assert sorted(got) == sorted(brute.repeated_bytes(documents(duck)))


def test_ann_query(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    want = brute.neighbours(rows)
    got = {}
    for r in llm.queries()["op4_adaptive_scan"](spark, SF001).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {v for v, _ in best}) for q, best in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_packing_and_encoding_queries(spark, duck):
    import hashlib

    t = Tokenizer.from_file(vocabulary_path())
    ids = {d: t.encode(x or "", add_special_tokens=False).ids for d, x in documents(duck)}
    pieces = [tuple(r) for r in llm.queries()["op1_hilbert_pack"](spark, SF001).collect()]
    brute.check_packing(pieces, {d: x + [1] for d, x in ids.items()})
    want = {
        (d, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
         hashlib.sha256(t.decode(x, skip_special_tokens=False).encode()).hexdigest())
        for d, x in ids.items()
    }
    assert {tuple(r) for r in llm.queries()["op7_bpe_tree"](spark, SF001).collect()} == want


def test_archive_query(spark, duck):
    rows = duck.execute("SELECT page_id, coalesce(html, '') FROM pages").fetchall()
    got = {r["page_id"]: tuple(r)[1:] for r in llm.queries()["op2_warc_chain"](spark, SF001).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, h in sorted(rows):
        first.setdefault(h, i)
    for i, h in rows:
        kind = ("response", None) if first[h] == i else ("revisit", first[h])
        assert got[i] == (len(h.encode()), brute.sha1_base32(h.encode()), *kind)


def test_stages(spark, duck):
    """Each stage against a plain computation over its own input."""
    prepare(spark)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    inputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF001), name)
        inputs.append(docs)
    start, quality, lines, joined, cut, packed = inputs
    for df in (quality, lines, joined, cut):
        assert df.columns == start.columns
    texts = [{r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()} for df in inputs[:5]]
    kept = llm.queries()["op6_host_quality"](spark, SF001).where("kept").collect()
    assert texts[1] == {r["doc_id"]: texts[0][r["doc_id"]] for r in kept}
    assert all(texts[2][d].count("\n") <= texts[1][d].count("\n") for d in texts[2])
    comps = brute.jaccard_components(sorted(texts[2].items()))
    assert texts[3] == {d: texts[2][d] for d, _, c in comps if c == d}
    assert 0 < len(texts[3]) < len(texts[2])
    spans = {r[0]: r for r in brute.repeated_bytes(sorted(texts[3].items()))}
    for d, text in texts[3].items():
        if spans[d][2] == 0:
            assert texts[4][d] == text
        elif d in texts[4]:
            assert abs(len(texts[4][d].encode()) - (spans[d][1] - spans[d][2])) <= 6 * spans[d][3]
        else:
            assert spans[d][2] >= spans[d][1] - 6
    t = Tokenizer.from_file(vocabulary_path())
    total = sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for x in texts[4].values())
    assert sum(r["length"] for r in packed.select("length").collect()) == total


def test_run_chains_the_stages(spark, monkeypatch):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "suffix_array_dedup", "packing"
    ]
    even = ("even", lambda s, docs, sf_dir: docs.where("doc_id % 2 = 0"))
    third = ("third", lambda s, docs, sf_dir: docs.where("doc_id % 3 = 0").select("doc_id"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [even, third])
    ids = [r["doc_id"] for r in corpus_pipeline.run(spark, SF001).collect()]
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert sorted(ids) == list(range(0, n, 6))
