"""A content-addressed archive of WARC records.

Two tables hold the archive. ``payloads`` has each distinct payload once, under its SHA-256, which is
computed again from the stored bytes before a payload is taken in and when it is read. ``records``
has the exact bytes of each record before its payload (the WARC header and the header of its block)
and the payload's address. A join of both gives back every record byte for byte.
"""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm._common import held_in_row, written

CRLF = "\r\n"
END = CRLF + CRLF
MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 10_000
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Deflate level of payloads in the shuffle, and bytes of unpacked payloads handed on together.
PACKING = 1
BATCH_BYTES = 32 << 20
# Fixed value: the alphabet of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexed: Column) -> Column:
    """Base32 of the 40 hex digits of a SHA-1 (eight groups of 20 bits, no padding)."""
    groups = [F.conv(F.substring(hexed, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8)]
    places = [F.shiftright(g, shift).bitwiseAND(31) + 1 for g in groups for shift in (15, 10, 5, 0)]
    return F.concat(*[F.substring(F.lit(BASE32), p, F.lit(1)) for p in places])


class Archive:
    """``payloads``: ``digest, payload``. ``records``: ``row, head, digest, carries`` (whether the
    payload's bytes are part of the record; a revisit has them in another one)."""

    def __init__(self, records: DataFrame, payloads: DataFrame):
        self.records, self.payloads = records, payloads

    @classmethod
    def of_records(cls, records: DataFrame) -> Archive:
        """An archive of ready records, ``head`` and ``payload`` (binary; null: empty). Repeated
        records each stay; no records give an empty archive."""
        empty = F.lit("").cast("binary")
        parts = records.select(F.coalesce("head", empty).alias("head"), F.coalesce("payload", empty).alias("payload"))
        addressed = parts.withColumn("digest", F.sha2("payload", 256))
        kept = addressed.select(
            F.monotonically_increasing_id().alias("row"), "head", "digest", F.lit(True).alias("carries")
        )
        return cls(written(kept, "warc-records"), _stored(addressed))

    @classmethod
    def of_pages(
        cls, pages: DataFrame, min_bytes: int = MIN_BYTES, date: str = DATE, id_col: str = "page_id",
        url_col: str = "url", html_col: str = "html",
    ) -> Archive:
        """A record for each page. Of pages with one payload of at least ``min_bytes`` that with the
        largest id is a response and the others revisit it; all other pages are responses.

        A null payload is empty. Null ids are smaller than any other; of rows that repeat the largest
        id one is the response. A null url has no header line. Other columns are not read.
        """
        parts = pages.select(
            F.col(id_col).cast("bigint").alias("page_id"),
            F.col(url_col).cast("string").alias("url"),
            F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
        )
        hashed = held_in_row(parts, digest=F.sha2("payload", 256), sha1=F.sha1("payload"), bytes=F.length("payload"))
        named = hashed.select(
            F.monotonically_increasing_id().alias("row"), "page_id", "url", "digest", "bytes", base32(F.col("sha1")).alias("sha1")
        )
        named = written(named, "warc-named")
        grouped = named.groupBy("digest").agg(
            F.max(F.struct("page_id", "row")).alias("first"),
            F.count("*").alias("n"),
            F.min("sha1").alias("low"), F.max("sha1").alias("high"), F.min("bytes").alias("least"), F.max("bytes").alias("most"),
        )
        # Equal addresses of unequal payloads would lose one of these.
        same = (F.col("low") == F.col("high")) & (F.col("least") == F.col("most"))
        checked = F.when(same, F.col("first")).otherwise(F.raise_error(F.lit("two payloads have one digest")))
        shared = grouped.where((F.col("n") > 1) & (F.col("least") >= min_bytes)).select("digest", checked.alias("first"))
        # Written, so that both sides are shuffled and a payload that most pages share can be split.
        typed = named.join(written(shared, "warc-shared"), "digest", "left")
        carries = F.col("first").isNull() | (F.col("first.row") == F.col("row"))
        head = _head(carries, date)
        records = typed.select("row", head.cast("binary").alias("head"), "digest", carries.alias("carries"))
        payloads = parts.select(F.sha2("payload", 256).alias("digest"), "payload")
        return cls(written(records, "warc-records"), _stored(payloads))

    def restored(self) -> DataFrame:
        """``row, record, digest``: the bytes of every record, with the blank lines that end it."""
        end = F.lit(END).cast("binary")
        stored = self.payloads.select("digest", _verified("payload").alias("payload"))
        whole = self.records.where("carries").join(stored, "digest")
        bare = self.records.where("not carries").withColumn("payload", F.lit("").cast("binary"))
        both = whole.unionByName(bare, allowMissingColumns=True)
        return both.select("row", F.concat("head", "payload", end).alias("record"), "digest")

    def export(self, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
        """Plain WARC files of at most ``records_per_file`` records in a folder.

        The text sink writes the bytes of a value as they are; its line end is the end of a record.
        """
        end = F.lit(len(END))
        value = F.substring(F.col("record"), F.lit(1), F.length("record") - end).cast("string")
        writer = self.restored().select(value.alias("value")).write.mode("overwrite")
        writer.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(folder)

    def pages(self) -> DataFrame:
        """What the records say, read from their bytes: ``page_id, payload_bytes, payload_digest,
        record_type, refers_to``. A revisit has length and digest from the payload that it points to.

        A payload that does not fit its digest or length, or a revisit without its payload, fails.
        """
        read = written(_parsed(self.restored()), "warc-read")
        full = read.where("record_type = 'response'")
        facts = full.select("digest", F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("sha1"))
        # A digest that is revisited has one response.
        again = read.where("record_type = 'revisit'").join(written(facts.distinct(), "warc-facts"), "digest", "left")
        fits = (F.col("bytes") == F.col("payload_bytes")) & (F.col("sha1") == F.col("payload_digest"))
        sha1 = F.when(fits, F.col("sha1")).otherwise(F.raise_error(F.lit("a revisit without its payload")))
        columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        again = again.select(
            "page_id", F.col("bytes").alias("payload_bytes"), sha1.alias("payload_digest"), "record_type", "refers_to"
        )
        return full.select(*columns).unionByName(again)


def _stored(addressed: DataFrame) -> DataFrame:
    """Each payload once. Copies meet inside their task first, so a payload that most records share
    reaches the shuffle once a task; payloads travel deflated."""
    single = _deflated(addressed.select("digest", "payload")).groupBy("digest").agg(F.first("payload").alias("payload"))
    return written(_inflated(single).select("digest", _verified("payload").alias("payload")), "warc-payloads", "zstd")


_PAYLOADS = pa.schema([("digest", pa.string()), ("payload", pa.binary())])


def _deflated(payloads: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress(p.as_py(), PACKING) for p in batch["payload"]]
            yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(packed, pa.binary())], schema=_PAYLOADS)

    return payloads.mapInArrow(run, "digest string, payload binary")


def _inflated(payloads: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, held, size = 0, [], 0
            for packed in batch["payload"]:
                held.append(zlib.decompress(packed.as_py()))
                size += len(held[-1])
                # A batch may unpack to many times its size.
                if size >= BATCH_BYTES:
                    yield rows(batch, start, held)
                    start, held, size = start + len(held), [], 0
            if held:
                yield rows(batch, start, held)

    def rows(batch: pa.RecordBatch, start: int, held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch["digest"].slice(start, len(held)), pa.array(held, pa.binary())], schema=_PAYLOADS)

    return payloads.mapInArrow(run, "digest string, payload binary")


def _verified(payload: str) -> Column:
    fits = F.sha2(payload, 256) == F.col("digest")
    return F.when(fits, F.col(payload)).otherwise(F.raise_error(F.lit("payload does not fit its digest")))


def _head(carries: Column, date: str) -> Column:
    """Everything before the payload, from ``page_id, row, url, sha1, bytes, first``."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def urn(page_id: Column, row: Column) -> Column:
        return F.format_string("<urn:page:%s:%s>", F.coalesce(page_id.cast("string"), F.lit("none")), row.cast("string"))

    block = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        line("Content-Length", F.col("bytes").cast("string")),
        F.lit(CRLF),
    )
    # A line end inside a url would end the header line.
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    refers = F.concat(
        line("WARC-Refers-To", urn(F.col("first.page_id"), F.col("first.row"))), line("WARC-Profile", F.lit(REVISIT))
    )
    length = F.length(block) + F.when(carries, F.col("bytes")).otherwise(F.lit(0))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(carries, F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", urn(F.col("page_id"), F.col("row"))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(carries, F.lit("")).otherwise(refers),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        block,
    )


def _parsed(restored: DataFrame) -> DataFrame:
    """The columns of ``Archive.pages`` and ``digest`` from the bytes of records. Lengths say where a
    part ends; what a revisit points to is not looked at."""
    text = F.col("record").cast("string")
    header = F.substring_index(text, END, 1)
    cut = restored.withColumn("header", header).withColumn("heads", F.substring_index(text, END, 2))
    cut = cut.withColumn("block_head", F.expr("substr(heads, length(header) + 5)"))

    def field(of: str, name: str) -> Column:
        return F.regexp_extract(of, f"(?m)^{name}: ([^\r\n]*)\r?$", 1)

    def page(name: str) -> Column:
        return F.regexp_extract(field("header", name), r"^<urn:page:(-?\d+):", 1).try_cast("bigint")

    at = F.octet_length("heads") + len(END)
    size = field("header", "Content-Length").cast("int") - F.octet_length("block_head") - len(END)
    payload = F.substring(F.col("record"), at + 1, size)
    ends = F.substring(F.col("record"), at + size + 1, F.lit(len(END) + 1)) == F.lit(END).cast("binary")
    fields = cut.select(
        "digest",
        page("WARC-Record-ID").alias("page_id"),
        field("header", "WARC-Type").alias("record_type"),
        F.substring(field("header", "WARC-Payload-Digest"), 6, 32).alias("said"),
        field("block_head", "Content-Length").cast("bigint").alias("said_bytes"),
        page("WARC-Refers-To").alias("refers_to"),
        F.when(ends, payload).alias("payload"),
    )
    facts = held_in_row(fields, sha1=F.sha1("payload"), read_bytes=F.length("payload").cast("bigint")).drop("payload")
    response = F.col("record_type") == "response"
    fits = (base32(F.col("sha1")) == F.col("said")) & (F.col("read_bytes") == F.col("said_bytes"))
    broken = F.raise_error(F.lit("record does not fit its digest or length")).cast("bigint")
    return facts.select(
        "digest",
        "page_id",
        F.when(~response | fits, F.col("said_bytes")).otherwise(broken).alias("payload_bytes"),
        F.col("said").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


_LENGTH = re.compile(rb"(?im)^content-length:\s*(\d+)\s*$")


def split_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(head, payload) of each record of a WARC file, plain or of gzip members.

    In blocks of HTTP messages the head goes to the end of the message's own header, else to the end
    of the WARC header. Head and payload together with ``END`` are the record's bytes.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at, end = 0, END.encode()
    while at < len(data):
        header = data.index(end, at) + len(end)
        length = _LENGTH.search(data, at, header)
        if not data.startswith(b"WARC/", at) or not length:
            raise ValueError(f"no WARC record at byte {at}")
        stop = header + int(length[1])
        if data[stop : stop + len(end)] != end:
            raise ValueError(f"record at byte {at} does not end at its length")
        message = data.find(end, header, stop) if b"application/http" in data[at:header] else -1
        cut = header if message < 0 else message + len(end)
        yield data[at:cut], data[cut:stop]
        at = stop + len(end)


def read_files(spark: SparkSession, paths: str) -> DataFrame:
    """``head, payload`` of all records in WARC files; each file must fit into one row (2 GB)."""
    fields = pa.schema([("head", pa.binary()), ("payload", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                for head, payload in split_records(content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([head]), pa.array([payload])], schema=fields)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("content")
    return files.mapInArrow(run, "head binary, payload binary")


def archived_pages(pages: DataFrame, **cols: str) -> DataFrame:
    """Archives all pages, restores the records from both tables and reads them."""
    return Archive.of_pages(pages, **cols).pages()


_GROUP = "('0x' || substr(sha1(coalesce(html, '')), 5 * g + 1, 5))::BIGINT"
SQL = f"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, list_transform(range(8), lambda g: {_GROUP}) AS groups FROM pages),
typed AS (
    SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda k:
               substr('{BASE32}', ((groups[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1)), '') AS payload_digest,
           row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST) AS place,
           max(page_id) OVER (PARTITION BY html) AS largest
    FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN place = 1 OR payload_bytes < {MIN_BYTES} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 AND payload_bytes >= {MIN_BYTES} THEN largest END AS refers_to
FROM typed"""
