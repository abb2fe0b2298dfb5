"""No page of an archive may vanish: magic in headers, files cut off."""

import hashlib
import os

import pytest

from tidelog.llm import warc_chain
from tidelog.llm.common import prepare
from tidelog.session import scratch_path

PAGES = "page_id long, url string, html string"


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


def foreign(folder, files):
    """Archives as another writer would leave them: records of (page_id, url, payload)."""
    os.makedirs(folder)
    for number, records in enumerate(files):
        with open(f"{folder}/part-{number}.warc", "wb") as out:
            for page_id, url, payload in records:
                out.write(
                    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\n" % page_id
                    + b"WARC-Target-URI: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (url, len(payload), payload)
                )
    return folder


def digests(rows):
    return sorted((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in rows)


def expected(records):
    return sorted((i, *warc_chain.payload_facts(p)) for i, _, p in records)


def test_magic_in_a_url_loses_no_page(spark):
    rows = [(i, f"http://h/{i}", f"page {i}") for i in range(10)]
    rows[4] = (4, "http://h/spec/WARC/1.0/x", "page 4")
    rows[9] = (9, "WARC/1.WARC/1.", "page 9 WARC/1.0\r\nWARC-Type: response\r\n")
    folder = scratch_path(spark, "warc")
    warc_chain.write_warc(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    got = warc_chain.read_warc(spark, folder).collect()
    assert digests(got) == sorted((i, *warc_chain.payload_facts(p.encode())) for i, _, p in rows)


@pytest.mark.parametrize("split", [None, "300b"])
def test_foreign_headers_that_hold_the_magic(spark, tmp_path, split):
    plain = [(i, b"http://h/%d" % i, b"payload %d" % i * 20) for i in range(12)]
    odd = [(20 + i, b"http://h/WARC/1.0/WARC/1.1/%d" % i, b"other WARC/1.0\r\n\r\n %d" % i) for i in range(5)]
    files = [plain[:6] + odd[:2], odd[2:4] + plain[6:], [odd[4]]]
    if split:  # splits begin anywhere, but not within a header that holds the magic
        files = [plain[:6], plain[6:], [(40, b"http://h", b"WARC/1.0\r\n" * 200)]]
    folder = foreign(str(tmp_path / "warc"), files)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = digests(warc_chain.read_warc(spark, folder).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == expected([r for f in files for r in f])


def test_a_file_that_is_cut_off_is_an_error(spark, tmp_path):
    folder = foreign(str(tmp_path / "warc"), [[(i, b"u", b"x" * 50) for i in range(5)]])
    path = f"{folder}/part-0.warc"
    os.truncate(path, os.path.getsize(path) - 30)
    with pytest.raises(ValueError, match="records end at byte"):
        warc_chain.read_warc(spark, folder).collect()


def test_bytes_before_the_first_record_are_an_error(spark, tmp_path):
    folder = foreign(str(tmp_path / "warc"), [[(1, b"u", b"x")]])
    path = f"{folder}/part-0.warc"
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(b"junk" + data)
    with pytest.raises(ValueError, match="records end at byte"):
        warc_chain.read_warc(spark, folder).collect()


def test_a_header_that_never_ends_is_an_error(spark, tmp_path):
    folder = foreign(str(tmp_path / "warc"), [[(i, b"u", b"x" * 50) for i in range(3)]])
    with open(f"{folder}/part-0.warc", "ab") as out:
        out.write(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n")
    with pytest.raises(ValueError, match="records end at byte"):
        warc_chain.read_warc(spark, folder).collect()


def test_digest_known(spark):
    n, digest = warc_chain.payload_facts(b"abc")
    assert n == 3 and len(digest) == 32
    assert hashlib.sha1(b"abc").digest() == __import__("base64").b32decode(digest)
