"""Archives come back byte for byte; equal payloads are stored once."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lotwise.llm.warc import parsed_records, read_pages, read_records, write_archive

SCHEMA = "page_id long, url string, html string, digest string"
BIG, OTHER = "<p>é</p>" * 200, "x" * 1000
PAGES = [
    (1, "http://a/1", BIG, "d"),
    (5, "http://a/5", BIG, None),
    (3, "http://b/3\r\nX-Evil: 1", BIG, ""),
    (None, None, BIG, ""),
    (7, "http://c", "short", ""),
    (8, "http://d", "short", ""),
    (9, "http://e", None, ""),
    (10, "http://f", "", ""),
    (11, "http://g", OTHER, ""),
    (11, "http://g", OTHER, ""),
    (12, "http://h", "x" * 999, ""),
    (13, "http://i", "x" * 999, ""),
    (None, "http://j", "y" * 2000, ""),
]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    write_archive(spark.createDataFrame(PAGES, SCHEMA), path)
    return path


def test_pages(spark, archive):
    want = []
    for page, _, html, _ in PAGES:
        body = (html or "").encode()
        revisit = html == BIG and page != 5
        kind = "revisit" if revisit else "response"
        want.append((page, len(body), hashlib.sha1(body).hexdigest(), kind, 5 if revisit else None))
    assert sorted(map(tuple, read_pages(spark, archive).collect()), key=repr) == sorted(want, key=repr)


def test_payloads_are_stored_once(spark, archive):
    assert spark.read.parquet(f"{archive}/payloads").count() == len({p[2] or "" for p in PAGES})


def test_records_parse(spark, archive):
    """Each record splits into head, HTTP head and payload of the stated lengths."""
    found = []
    for row in read_records(spark, archive).collect():
        record, payload = bytes(row.record), bytes(row.payload)
        head, rest = record.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block, end = rest[: int(fields["Content-Length"])], rest[int(fields["Content-Length"]) :]
        assert end == b"\r\n\r\n"
        http, body = block.split(b"\r\n\r\n", 1)
        assert f"Content-Length: {len(payload)}".encode() in http
        assert body == (b"" if fields["WARC-Type"] == "revisit" else payload)
        assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        assert "X-Evil" not in fields
        found.append((row.page_id, payload))
    assert sorted(found, key=repr) == sorted(((p[0], (p[2] or "").encode()) for p in PAGES), key=repr)


def test_empty_table(spark, tmp_path):
    write_archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert read_pages(spark, str(tmp_path / "e")).count() == 0


def test_a_changed_payload_is_noticed(spark, tmp_path):
    path = str(tmp_path / "c")
    write_archive(spark.createDataFrame(PAGES[:1], SCHEMA), path)
    stored = spark.read.parquet(f"{path}/payloads").collect()[0]
    changed = [(bytes(stored.digest), b"other")]
    spark.createDataFrame(changed, "digest binary, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        read_pages(spark, path).collect()


def test_a_lost_payload_is_noticed(spark, tmp_path):
    path = str(tmp_path / "l")
    write_archive(spark.createDataFrame(PAGES[:1], SCHEMA), path)
    spark.createDataFrame([], "digest binary, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="no payload for record 1"):
        read_pages(spark, path).collect()


def test_pages_come_from_parsed_records(spark, archive):
    """A record whose bytes do not add up is noticed, as its pages are read from them."""
    records = read_records(spark, archive)
    assert parsed_records(records).count() == len(PAGES)
    cut = records.filter("page_id = 5").withColumn("record", F.expr("substring(record, 1, octet_length(record) - 3)"))
    with pytest.raises(Exception, match="not the one it states"):
        parsed_records(cut).collect()
