"""Archives round trip: digests, revisits, chunks, damaged files."""

import gzip
import hashlib
import io

import pytest

from tablemover.llm import warc


def test_round_trip_with_chunks(spark, tmp_path):
    big = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60_000
    rows = [(1, "http://a/ü\r\nX: y", "<html>é</html>"), (2, None, None), (3, "u", ""), (4, "u", big), (9, "u", big), (5, "u", "x" * 1000),
            (6, "u", "x" * 1000), (7, "u", "y" * 999), (8, "u", "y" * 999), (None, "u", "x" * 1000), (6, "u", "x" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.archive_pages(pages, folder=f"file://{tmp_path}/w")
    assert sum(r["records"] for r in manifest.collect()) == len(rows)
    chunks = warc.record_chunks(manifest, chunk_bytes=1 << 16).withColumn("page_id", warc.page_of(warc.F.col("record_id")).cast("long")).collect()
    full = {}
    for r in sorted(chunks, key=lambda r: r["chunk"]):
        if r["record_type"] == "response" and r["page_id"] != 6:
            full.setdefault(r["page_id"], b"")
            full[r["page_id"]] += bytes(r["data"])
            assert len(r["data"]) <= 1 << 16 and r["bytes_so_far"] == len(full[r["page_id"]])
            assert r["running_sha1"] == hashlib.sha1(full[r["page_id"]]).hexdigest()
    want = {i: (h or "").encode() for i, _, h in rows}
    assert set(full) == {1, 2, 3, 9, 7, 8}  # 5 and the null id revisit 6, 4 revisits 9
    assert all(full[i] == want[i] for i in full)
    last = [r for r in chunks if r["last"]]
    assert len(last) == len(rows)
    for r in last:
        if r["record_type"] == "revisit":
            to = int(r["refers_to"].split(":")[2])
            assert to == {4: 9, 5: 6, None: 6}[r["page_id"]]
            assert r["stated_sha1"] == hashlib.sha1(want[to]).hexdigest() and r["stated_bytes"] == len(want[to])
    assert sum(r["page_id"] == 6 and r["record_type"] == "response" for r in last) == 2


def test_archives_are_gzip_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/", "<b>hi</b>")], "page_id long, url string, html string").coalesce(1)
    file = warc.archive_pages(pages, folder=f"file://{tmp_path}/v").first()["file"]
    text = gzip.open(file.removeprefix("file://")).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"<b>hi</b>\r\n\r\n")
    assert warc.archive_pages(pages.limit(0), folder=f"file://{tmp_path}/e").count() == 0
    assert warc.record_chunks(warc.archive_pages(pages.limit(0), folder=f"file://{tmp_path}/f")).count() == 0


def test_damage_is_an_error():
    head = warc.record_head(1, "u", "00" * 20, 5, False, None, "1970-01-01T00:00:00Z")
    whole = gzip.compress(head + b"hello\r\n\r\n")
    assert [x[8] for x in warc.read_chunks(io.BytesIO(whole * 2), 1024)] == [hashlib.sha1(b"hello").hexdigest()] * 2
    for bad in (whole[:-12], gzip.compress(b"nothing here"), gzip.compress(head + b"hel")):
        with pytest.raises((EOFError, ValueError)):
            list(warc.read_chunks(io.BytesIO(bad), 1024))
