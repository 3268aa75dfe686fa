"""Archive round trip, revisits and digests."""

import hashlib

import pytest

from encore.llm.warc import export_warc, read_archive, write_archive

SCHEMA = "page_id long, url string, html string, record string, sha256 string"


def _records(spark, rows, path):
    write_archive(spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3), path)
    return read_archive(spark, path).collect()


def _brute(rows):
    """(id, bytes, digest, type, refers_to) by definition."""
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        last = max(same, default=None)
        revisit = len(data) >= 1000 and last is not None and i != last
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_and_revisits(spark, scratch):
    big = "é" * 600
    rows = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (5, None, big), (3, "u", "small"), (4, "u", "small"),
            (6, "u", None), (7, "u", ""), (7, "u", ""), (None, "u", big), (9, "u", "z" * 1000), (9, "u", "z" * 1000),
            (8, "u", "z" * 1000), (None, "v", "q" * 2000), (None, "v", "q" * 2000), (10, "u", "z" * 999), (11, "u", "z" * 999),
            (12, "u", "long " * 200_000), (13, "u", "WARC/1.1\r\n\r\nWARC-Type: revisit\r\n" * 40)]
    got = _records(spark, rows, f"{scratch}/a")
    assert sorted(((r.id, len(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == _brute(rows)
    assert spark.read.parquet(f"{scratch}/a/payloads").count() == len({(r[2] or "") for r in rows})
    for r in got:  # the record is the head, the payload of responses, and two line ends
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        http, _, body = rest.partition(b"\r\n\r\n")
        assert body == (bytes(r.payload) if r.record_type == "response" else b"") + b"\r\n\r\n"
        assert f"Content-Length: {len(rest) - 4}".encode() in head.splitlines()[-1]


def test_hot_payload(spark, scratch):
    rows = [(i, "u", "x" * 1500 if i % 3 == 0 else f"page {i} " * 150) for i in range(300)]
    got = _records(spark, rows, f"{scratch}/a")
    assert sorted(((r.id, len(r.payload), r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == _brute(rows)


def test_empty_table_and_export(spark, scratch):
    assert _records(spark, [], f"{scratch}/none") == []
    write_archive(spark.createDataFrame([(1, "u", "a" * 5000, "", ""), (2, "u", "a" * 5000, "", "")], SCHEMA), f"{scratch}/a")
    records = read_archive(spark, f"{scratch}/a")
    export_warc(records, f"{scratch}/files")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{scratch}/files").collect()
    stored = b"".join(bytes(r.content) for r in found)
    parts = [bytes(r.record) for r in records.collect()]
    assert len(stored) == sum(map(len, parts)) and all(p in stored for p in parts)


def test_damaged_payload_is_refused(spark, scratch):
    write_archive(spark.createDataFrame([(1, "u", "abc", "", "")], SCHEMA), f"{scratch}/a")
    spark.read.parquet(f"{scratch}/a/payloads").selectExpr("sha256", "CAST('abd' AS binary) AS payload").write.parquet(f"{scratch}/b/payloads")
    spark.read.parquet(f"{scratch}/a/headers").write.parquet(f"{scratch}/b/headers")
    with pytest.raises(Exception, match="digest"):
        read_archive(spark, f"{scratch}/b").collect()
