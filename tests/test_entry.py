"""Driver contract: entry(), queries() and the DuckDB oracles at sf0.001."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF001

ROWS_ONLY: set[str] = set()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _norm(v):
    # floats compared bit for bit: the oracles round where summation order
    # could differ
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def _multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["process_date", "ip", "request_count"]
    assert df.count() > 0


def _core(keys):
    """Without the queries of the llm subpackage, which has its own tests."""
    return sorted(k for k in keys if k != "pipeline" and not re.match(r"op\d+_", k))


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert set(_core(qs)) - set(oracles) == ROWS_ONLY


@pytest.mark.parametrize("key", _core(entry.queries()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF001)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _multiset(cols, rows) == _multiset(ocols, orows)


def test_entry_without_the_llm_subpackage(monkeypatch):
    import sys

    import tidelog

    monkeypatch.delattr(tidelog, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "tidelog.llm", None)
    assert entry.queries() and not set(entry.queries()) - set(_core(entry.queries()))
    assert set(_core(entry.oracle_sql())) == set(entry.oracle_sql())
