"""WARC archives: segmented records out, reassembled payloads in.

Writer: each page becomes a response record whose block is an HTTP message with chunked
transfer framing; a block over ``SEGMENT`` bytes goes on in continuation records (origin
id, segment number; the last one gives the total length). Of equal payloads of at least
``REVISIT_BYTES`` bytes the one with the largest page_id is the response; the others are
revisit records that name its page and carry no payload.

Reader: records are parsed by their declared lengths, continuation records are grouped by
their origin id and ordered by segment number, gaps and the total length are verified,
the chunked framing is decoded, and a revisit's payload is that of the response it names.

Plan: the equal payloads are found on (digest, page_id) alone and stored, so the texts
are shuffled only if that table is too large to broadcast by Spark's own threshold.
Archives are gzip files in the shared checkpoint folder, written by Spark's text sink
(which writes the bytes as they are, with the record's closing line ends as separator)
and read as binary files of at most ``FILE_RECORDS`` records. Payloads of one record are
digested where they are read; only those of several segments are shuffled, grouped by
record, so a task never holds more than its largest page.

Defined results: null html: empty payload. Null url: an empty target. Null page_id: written as
an empty id and read back as null; it never is the response of others. Repeated rows:
returned as often as given; those with the largest page_id are all responses. Very long
texts span many segments. A record that fails a check is returned with ``intact``
false. Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.llm.tasks import map_batches
from trendlake.llm.text import stored
from trendlake.session import scratch_path

SEGMENT = 16 * 1024
HTTP_CHUNK = 4 * 1024
REVISIT_BYTES = 1000
FILE_RECORDS = 5000
READ_BYTES = 8 << 20  # of segments handed on at a time

# The formats' own names.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD_END = "\r\n\r\n"


def chunked(payload: bytes, size: int = HTTP_CHUNK) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            if body[at:] != b"\r\n":
                raise ValueError("bytes after the last chunk")
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its size says")
        out.append(body[at:at + size])
        at += size + 2


def http_payload(message: bytes) -> bytes:
    head, _, body = message.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(kind: str, record_id: str, block: bytes, **headers: object) -> bytes:
    """A record without its closing line ends."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", **headers,
             "WARC-Date": "2020-01-01T00:00:00Z", "Content-Length": len(block)}
    text = "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None)
    return VERSION + text.encode("utf-8", "surrogatepass") + b"\r\n" + block


def page_records(page: str, row: str, url: str, payload: bytes, digest: str, refers_to: str | None,
                 segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    rid = f"urn:x-page:{page}:{row}"
    common = {"WARC-Target-URI": re.sub(r"[\r\n]", " ", url), "WARC-Payload-Digest": f"sha1:{digest}"}
    if refers_to is not None:
        yield record("revisit", rid, REVISIT_HEAD, **common, **{
            "WARC-Refers-To": f"<urn:x-page:{refers_to}>", "WARC-Profile": PROFILE})
        return
    block = HTTP_HEAD + chunked(payload)
    if len(block) <= segment:
        yield record("response", rid, block, **common)
        return
    yield record("response", rid, block[:segment], **common, **{"WARC-Segment-Number": 1})
    for k, at in enumerate(range(segment, len(block), segment), 2):
        last = at + segment >= len(block)
        yield record("continuation", f"{rid}:{k}", block[at:at + segment], **{
            "WARC-Segment-Origin-ID": f"<{rid}>", "WARC-Segment-Number": k,
            "WARC-Segment-Total-Length": len(block) if last else None})


def write_archives(pages: DataFrame, path: str, html: str = "html", segment: int = SEGMENT,
                   file_records: int = FILE_RECORDS) -> None:
    """Writes the pages (page_id, url, html) as WARC files (``part-*.gz``) below ``path``."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    d = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    d = d.withColumn("digest", F.sha1("payload"))
    long = d.filter(F.octet_length("payload") >= REVISIT_BYTES)
    same = long.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    same = stored(same.filter("n > 1 and first is not null").select(F.col("digest").alias("_digest"), "first"), "equal_payloads")
    short = F.octet_length("payload") < REVISIT_BYTES
    j = d.join(same, (F.col("digest") == F.col("_digest")) & ~short, "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = j.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page"), "url", "payload", "digest",
                    refers.cast("string").alias("refers"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for page, url, data, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                n += 1
                for r in page_records(page, f"{task}-{n}", url, data, digest, refers_to, segment):
                    out.append(r)
                    size += len(r)
                if size > READ_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = map_batches(rows, build, "value binary").select(F.col("value").cast("string").alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip") \
        .option("maxRecordsPerFile", file_records).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an open archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line != VERSION:
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            headers[name.lower()] = value
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != RECORD_END.encode():
            raise ValueError("a record doesn't end where its length says")
        yield headers, block


RECORDS = ("origin string, page string, record_type string, refers string, digest string, "
           "segment int, total bigint, bytes bigint, found string, data binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record (RECORDS): whole payloads by their size and SHA-1, segments with their data."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    schema = pa.schema([("origin", pa.string()), ("page", pa.string()), ("record_type", pa.string()),
                        ("refers", pa.string()), ("digest", pa.string()), ("segment", pa.int32()),
                        ("total", pa.int64()), ("bytes", pa.int64()), ("found", pa.string()), ("data", pa.binary())])

    def rows(content: bytes) -> Iterator[tuple]:
        with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
            for h, block in parse_records(stream):
                rid = h["warc-record-id"].strip("<>")
                kind, segment = h["warc-type"], int(h.get("warc-segment-number", 0))
                refers = h.get("warc-refers-to", "").strip("<>").rpartition(":")[2] or None
                digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                page = rid.split(":")[2] if kind != "continuation" else None
                if segment:
                    origin = h.get("warc-segment-origin-id", rid).strip("<>")
                    total = h.get("warc-segment-total-length")
                    yield origin, page, kind, refers, digest, segment, total and int(total), None, None, block
                elif kind == "revisit":
                    yield rid, page, kind, refers, digest, 0, None, None, None, None
                else:
                    yield (rid, page, kind, refers, digest, 0, None, *decoded(block), None)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for r in rows(content.as_py()):
                    out.append(r)
                    size += len(r[-1] or b"") + 200
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return map_batches(files, parse, RECORDS)


def decoded(message: bytes) -> tuple[int | None, str | None]:
    """(bytes, SHA-1) of an HTTP message's payload; nulls if its framing is broken."""
    try:
        payload = http_payload(message)
    except ValueError:
        return None, None
    return len(payload), hashlib.sha1(payload).hexdigest()


def reassemble(records: DataFrame) -> DataFrame:
    """A row per logical record: page, record_type, refers, digest, bytes, found (nulls if its
    segments don't add up). Only segments carry data through the shuffle."""
    parts = F.sort_array(F.collect_list(F.struct("segment", "data")))
    whole = records.groupBy("origin").agg(
        parts.alias("parts"), F.max("total").alias("total"), F.max("bytes").alias("bytes"), F.max("found").alias("found"),
        *[F.max(c).alias(c) for c in ("page", "refers", "digest")],
        F.max(F.when(F.col("record_type") != "continuation", F.col("record_type"))).alias("record_type"))
    cols = whole.select("page", "record_type", "refers", "digest", "bytes", "found", "total", "parts")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, found = batch.column("bytes").to_pylist(), batch.column("found").to_pylist()
            totals, parts = batch.column("total").to_pylist(), batch.column("parts")
            for i in range(batch.num_rows):
                if parts[i][0]["segment"].as_py() == 0:
                    continue
                segments = parts[i].as_py()
                block = b"".join(s["data"] for s in segments)
                numbers = [s["segment"] for s in segments]
                if numbers == list(range(1, len(segments) + 1)) and len(block) == totals[i]:
                    size[i], found[i] = decoded(block)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page", "record_type", "refers", "digest")],
                 pa.array(size, pa.int64()), pa.array(found, pa.string())],
                ["page", "record_type", "refers", "digest", "bytes", "found"])

    return map_batches(cols, join, "page string, record_type string, refers string, digest string, bytes bigint, found string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, intact per page of the archives."""
    found = stored(reassemble(read_records(spark, path)), "warc_pages")
    page = F.when(F.col("page") != "", F.col("page").cast("bigint")).alias("page_id")
    responses = found.filter("record_type = 'response'")
    first = responses.filter("page <> ''").groupBy("page", "digest").agg(
        F.max("bytes").alias("_bytes"), F.max("found").alias("_found"))
    revisits = found.filter("record_type = 'revisit'").select("page", "record_type", "refers", "digest").join(
        first.select(F.col("page").alias("_page"), F.col("digest").alias("_digest"), "_bytes", "_found"),
        (F.col("refers") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left")

    def shown(df: DataFrame, size: str, digest: str) -> DataFrame:
        return df.select(page, F.col(size).alias("payload_bytes"), F.col(digest).alias("payload_digest"), "record_type",
                         F.col("refers").cast("bigint").alias("refers_to"),
                         F.coalesce(F.col(digest) == F.col("digest"), F.lit(False)).alias("intact"))

    return shown(responses, "bytes", "found").union(shown(revisits, "_bytes", "_found"))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """The pages written as archives in the shared checkpoint folder and read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
