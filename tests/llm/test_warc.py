"""The archive against plain Python and SQL, and round trips of its records and files."""

import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from medloom.llm import queries, warc
from tests.compare import connect, mismatch
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string, digest string, row long, head string, payload string, record string"


def plain_pages(rows, min_bytes=0):
    groups = defaultdict(list)
    for page_id, html in rows:
        groups[(html or "").encode()].append(page_id)
    out = Counter()
    for payload, ids in groups.items():
        facts = (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for k, i in enumerate(ids):
            again = k > 0 and len(payload) >= min_bytes
            out[i, *facts, "revisit" if again else "response", ids[0] if again else None] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(2)
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n<p>\r\n\r\nWARC/1.1\r\n\r\n"
    rows = [
        (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"),
        (None, "http://a/3", "<p>one</p>"), (3, None, None), (4, "http://a/4", ""), (5, "x\r\nWARC-Type: no", "é😀\x00\x85"),
        (6, "", tricky), (7, "u", tricky), (8, "u", "\r\n\r\n"), (9, "u", "\r\n"), (None, None, "none"), (None, None, "none"),
        (10, "u", "long " * 200_000), (11, "u", "long " * 200_000), (-4, "u", "%s %d"),
    ]
    rows += [(k, f"http://b/{k}", "the same page") for k in range(100, 400)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], PAGES).repartition(6).cache()


def test_query_equals_sql(spark):
    found = queries.QUERIES["op12_warc"](spark, SF)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert mismatch(found, connect(SF), warc.SQL) is None
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
    assert Counter(map(tuple, found.collect())) == plain_pages(rows)


@pytest.mark.parametrize("min_bytes", [0, 5, 1000])
def test_edges(pages, min_bytes):
    rows = [tuple(r) for r in pages.select("page_id", "html").collect()]
    archive = warc.Archive.of_pages(pages, min_bytes=min_bytes)
    assert Counter(map(tuple, archive.pages().collect())) == plain_pages(rows, min_bytes)
    # Each payload is stored once.
    stored = [bytes(r.payload) for r in archive.payloads.collect()]
    assert Counter(stored) == Counter({(h or "").encode(): 1 for _, h in rows})


def test_records_and_files(spark, pages, tmp_path):
    archive = warc.Archive.of_pages(pages)
    records = Counter(bytes(r.record) for r in archive.restored().collect())
    for record in records:
        ((head, payload),) = warc.split_records(record)
        assert head + payload + b"\r\n\r\n" == record
        kind = b"response" if b"WARC-Type: response" in head else b"revisit"
        digest = base64.b32encode(hashlib.sha1(payload).digest())
        assert (b"WARC-Payload-Digest: sha1:" + digest in head) == (kind == b"response" or not payload and b"sha1:3I42H3S6" in head)
    archive.export(str(tmp_path / "files"), records_per_file=50)
    parts = warc.read_files(spark, str(tmp_path / "files"))
    again = warc.Archive.of_records(parts)
    assert Counter(bytes(r.record) for r in again.restored().collect()) == records
    # All empty payloads of revisits and pages are one.
    assert again.payloads.count() == archive.payloads.count()


def test_split_records():
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 7\r\n\r\na\r\n\r\nb\n\r\n\r\n"
    two = b"WARC/1.0\r\ncontent-type: application/http\r\ncontent-length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    want = [(one[:54], b"a\r\n\r\nb\n"), (two[:-8], b"body")]
    assert [p for _, p in warc.split_records(one + two)] == [p for _, p in want]
    assert list(warc.split_records(gzip.compress(one) + gzip.compress(two))) == list(warc.split_records(one + two))
    for broken in (one[:-2], b"x" + one, one.replace(b"Content-Length", b"Length")):
        with pytest.raises(ValueError):
            list(warc.split_records(broken))


def test_damage_is_found(pages):
    archive = warc.Archive.of_pages(pages)
    other = archive.payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    with pytest.raises(Exception, match="does not fit its digest"):
        warc.Archive(archive.records, other).pages().collect()
    # The right bytes under the address of another record.
    swapped = archive.records.withColumn("digest", F.min("digest").over(warc_window()))
    with pytest.raises(Exception, match="does not fit its digest or length|without its payload"):
        warc.Archive(swapped, archive.payloads).pages().collect()


def warc_window():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def test_empty(spark, pages):
    assert warc.archived_pages(pages.limit(0)).count() == 0
    assert warc.Archive.of_records(spark.createDataFrame([], "head binary, payload binary")).restored().count() == 0


def test_payloads_travel_and_lie_compressed(spark, monkeypatch):
    # Unpacked a few at a time, and written smaller than snappy does.
    monkeypatch.setattr(warc, "BATCH_BYTES", 1000)
    words = [f"<p>word{k % 97} and word{k * 7 % 89} of page {k}</p>" for k in range(3000)]
    pages = spark.createDataFrame([(k, None, " ".join(words[k : k + 60])) for k in range(1000)], "page_id long, url string, html string")
    archive = warc.Archive.of_pages(pages.repartition(2))
    plan = warc._deflated(pages.selectExpr("sha2(html, 256) digest", "cast(html as binary) payload"))
    assert plan.selectExpr("sum(length(payload))").first()[0] < 0.4 * sum(len(r.html) for r in pages.collect())
    got = {bytes(r.payload).decode() for r in archive.payloads.collect()}
    assert got == {r.html for r in pages.collect()} and archive.payloads.count() == 1000
    assert all(".zstd." in f for f in archive.payloads.inputFiles())
    assert archive.pages().where("record_type = 'response'").count() == 1000
