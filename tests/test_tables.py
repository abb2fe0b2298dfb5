"""Table write semantics: create, dynamic partition overwrite, replace."""

import uuid

from pyspark.sql import functions as F

from tidelog.session import scratch_path
from tidelog.sources.tables import (
    create_database,
    create_table,
    describe_table,
    list_databases,
    list_tables,
    overwrite_partitions,
    read_table,
    replace_table,
    table_exists,
    write_partitioned,
    write_partitioned_path,
)
from tests.conftest import sorted_rows


def _db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, scratch_path(spark, "tests-db"))
    create_database(spark, name)  # idempotent
    return name


_rows = sorted_rows


def _data(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, p string")


def test_overwrite_keeps_other_partitions(spark):
    db = _db(spark)
    t = f"{db}.t"
    assert not table_exists(spark, t)
    create_table(_data(spark, [(1, "a", "p1"), (2, "b", "p2"), (3, "n", None)]), t, ["p"])
    assert table_exists(spark, t)
    overwrite_partitions(_data(spark, [(9, "z", "p2")]), t, ["p"])
    assert _rows(read_table(spark, t).select("id", "v", "p")) == [
        (1, "a", "p1"),
        (3, "n", None),
        (9, "z", "p2"),
    ]
    # the session setting is restored after the write
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_overwrite_null_partition(spark):
    db = _db(spark)
    t = f"{db}.t"
    create_table(_data(spark, [(1, "a", "p1"), (3, "n", None)]), t, ["p"])
    overwrite_partitions(_data(spark, [(4, "m", None)]), t, ["p"])
    assert _rows(read_table(spark, t).select("id", "p")) == [(1, "p1"), (4, None)]


def test_rerun_is_idempotent(spark):
    db = _db(spark)
    t = f"{db}.t"
    df = _data(spark, [(1, "a", "p1"), (2, "b", "p2")])
    write_partitioned(df, t, ["p"])
    first = _rows(read_table(spark, t))
    write_partitioned(df, t, ["p"])
    assert _rows(read_table(spark, t)) == first


def test_replace_drops_old_partitions(spark):
    db = _db(spark)
    t = f"{db}.t"
    create_table(_data(spark, [(1, "a", "p1"), (2, "b", "p2")]), t, ["p"])
    replace_table(_data(spark, [(5, "e", "p3")]), t, ["p"])
    assert _rows(read_table(spark, t).select("id", "p")) == [(5, "p3")]


def test_path_form_dynamic_overwrite(spark):
    path = scratch_path(spark, "tests-path")
    write_partitioned_path(_data(spark, [(1, "a", "p1"), (2, "b", "p2")]), path, ["p"])
    write_partitioned_path(_data(spark, [(7, "x", "p2")]), path, ["p"])
    back = spark.read.schema("id int, v string, p string").parquet(path)
    assert _rows(back.select("id", "p")) == [(1, "p1"), (7, "p2")]


def test_catalog_listing(spark):
    db = _db(spark)
    create_table(_data(spark, [(1, "a", "p1")]), f"{db}.t", ["p"])
    names = [r.tableName for r in list_tables(spark, db).filter(~F.col("isTemporary")).collect()]
    assert names == ["t"]
    dbs = {r.database: r.is_current for r in list_databases(spark, current=db).collect()}
    assert dbs[db] is True and dbs["default"] is False
    desc = {r.col_name for r in describe_table(spark, f"{db}.t").collect()}
    assert {"id", "v", "p"} <= desc


def test_compression_is_a_table_property(spark):
    import glob

    import pyarrow.parquet as pq

    db = _db(spark)
    t = f"{db}.z"
    create_table(_data(spark, [(1, "a", "p1")]), t, ["p"], options={"compression": "zstd"})
    overwrite_partitions(_data(spark, [(2, "b", "p2")]), t, ["p"])
    loc = describe_table(spark, t).filter("col_name = 'Location'").first().data_type
    files = glob.glob(loc.replace("file:", "") + "/p=*/*.parquet")
    assert len(files) == 2
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert codecs == {"ZSTD"}


def test_concurrent_dynamic_overwrites_keep_other_partitions(spark):
    from concurrent.futures import ThreadPoolExecutor

    db = _db(spark)
    t = f"{db}.c"
    create_table(_data(spark, [(i, "old", f"p{i}") for i in range(6)]), t, ["p"])
    batches = [_data(spark, [(10 + i, "new", f"p{i}")]) for i in range(3)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda b: overwrite_partitions(b, t, ["p"]), batches))
    got = _rows(read_table(spark, t).select("id", "v", "p"))
    assert got == [(10, "new", "p0"), (11, "new", "p1"), (12, "new", "p2"),
                   (3, "old", "p3"), (4, "old", "p4"), (5, "old", "p5")]
