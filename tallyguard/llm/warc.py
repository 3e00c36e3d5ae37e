"""WARC archives: written by Spark, read back, and put together by transaction.

A capture is written as three records: a response (or a revisit, where an earlier page has the same
payload), its request and its metadata; the last two name the first in ``WARC-Concurrent-To``. They
may lie in any file and order: reading joins them through that identifier into one nested row per
capture, and a record whose partner is missing leaves the partner null.

Records go through Spark's text writer with the record terminator as separator, so archives can lie
wherever Spark writes; each file is one gzip stream of about `FILE_BYTES`, a bound on what a reading
task holds (one larger record makes a larger file). Reading follows ``Content-Length``, so payloads
may hold anything, terminators and record heads included.

Payloads are equal if their SHA-256 are. The page with the smallest key of such a group is the
response, the others revisit it; rows that repeat this key are responses too; null keys come last,
and a group of null keys only is all responses. Null payloads and URLs are empty; an empty table
gives an archive without records and an empty result; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm.common import join_keys, once, stored
from tallyguard.sinks.shared import shared_folder

VERSION, CRLF, END = "WARC/1.1", "\r\n", "\r\n\r\n"
FILE_BYTES = 32 << 20
RECORDS_PER_BATCH, BYTES_PER_BATCH = 2048, 4 << 20
RESPONSE, REVISIT, REQUEST, METADATA = "response", "revisit", "request", "metadata"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RECORD = (
    "kind string, record_id string, concurrent_to array<string>, refers_to string, uri string, "
    "payload_digest string, fields map<string,string>, payload_bytes bigint, true_digest string"
)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _with_digest(captures: DataFrame) -> DataFrame:
    """``digest``, the payload's SHA-1 in base32: each of its 32 groups of five bits as a character."""
    out = once(captures, sha=F.sha1(F.col("payload").cast("binary")))
    parts = [F.lpad(F.conv(F.substring("sha", at, 10), 16, 2), 40, "0") for at in (1, 11, 21, 31)]
    out = once(out, bits=F.concat(*parts))
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def letter(i: Column) -> Column:
        return F.substring(letters, F.conv(F.substring("bits", i * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1, F.lit(1))

    out = once(out, digest=F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), letter), ""))
    return out.drop("sha", "bits")


def planned(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Each page with its payload, its digest, the response it refers to (null for a response) and a
    capture id that no other row has."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("key"), address.alias("uri"), body.alias("payload"))
    rows = rows.withColumn("content", F.unhex(F.sha2(F.col("payload").cast("binary"), 256)))
    groups = rows.groupBy("content").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"))
    groups = stored(groups, "warc-groups")
    known = join_keys(rows, groups, "content", "n")
    other = F.col("least").isNotNull() & ~F.col("key").eqNullSafe(F.col("least"))
    # Written once, so the id is settled by the archive.
    return known.select(
        "key", "uri", "payload", F.when(other, F.col("least")).alias("refers_to"), F.expr("uuid()").alias("capture")
    )


def _utf8_length(text: Column) -> Column:
    return F.octet_length(text)


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record as text; headers with null values are left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{name}: "), v, F.lit(CRLF))) for name, v in headers]
    length = F.concat(F.lit("Content-Length: "), _utf8_length(block).cast("string"), F.lit(END))
    return F.concat(F.lit(VERSION + CRLF), *[F.coalesce(x, F.lit("")) for x in lines], length, block)


def _urn(kind: str, capture: str = "capture") -> Column:
    return F.concat(F.lit("<urn:capture:"), F.col(capture), F.lit(f":{kind}>"))


def records(captures: DataFrame) -> DataFrame:
    """The three records of each planned capture, one row of text each."""
    # A URI that stays on its line and is read back as it was.
    uri = F.url_encode("uri")
    revisits = F.col("refers_to").isNotNull()
    first = _urn(RESPONSE)
    date = ("WARC-Date", F.lit(WRITTEN))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    named = _with_digest(captures)
    main = _record(
        [
            ("WARC-Type", F.when(revisits, REVISIT).otherwise(RESPONSE)),
            ("WARC-Record-ID", first),
            date,
            ("WARC-Target-URI", uri),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisits, PROFILE)),
            ("WARC-Refers-To", F.when(revisits, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        F.concat(F.lit(HTTP_HEAD), F.when(revisits, "").otherwise(F.col("payload"))),
    )
    request = _record(
        [
            ("WARC-Type", F.lit(REQUEST)), ("WARC-Record-ID", _urn(REQUEST)), date,
            ("WARC-Target-URI", uri), ("WARC-Concurrent-To", first),
            ("Content-Type", F.lit("application/http;msgtype=request")),
        ],
        F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1" + END)),
    )
    page = F.when(F.col("key").isNotNull(), F.concat(F.lit("pageId: "), F.col("key").cast("string"), F.lit(CRLF)))
    size = F.concat(F.lit("payloadBytes: "), _utf8_length(F.col("payload")).cast("string"), F.lit(CRLF))
    metadata = _record(
        [
            ("WARC-Type", F.lit(METADATA)), ("WARC-Record-ID", _urn(METADATA)), date,
            ("WARC-Target-URI", uri), ("WARC-Concurrent-To", first),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        F.concat(F.coalesce(page, F.lit("")), size),
    )
    return named.select(F.explode(F.array(main, request, metadata)).alias("value"))


def write(captures: DataFrame, path: str, mean_bytes: float, file_bytes: int = FILE_BYTES) -> None:
    """Write archives of planned captures whose payloads have ``mean_bytes`` on average."""
    # Three records of a capture, with about 500 bytes of headers each.
    each = max(1, int(3 * file_bytes / (mean_bytes + 1500)))
    writer = records(captures).write.option("lineSep", END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", each).text(path)


def _inflated(content: bytes) -> bytes:
    """A file's bytes; gzip streams may follow one another."""
    if content[:2] != b"\x1f\x8b":
        return content
    out, rest = [], content
    while rest:
        stream = zlib.decompressobj(31)
        out += [stream.decompress(rest), stream.flush()]
        rest = stream.unused_data
    return b"".join(out)


def parsed(content: bytes) -> Iterator[tuple[list[tuple[str, str]], memoryview]]:
    """Headers and block of each record of an archive."""
    at, view, gap = 0, memoryview(content), END.encode()
    while at < len(content):
        stop = content.find(gap, at)
        lines = content[at:stop].decode("utf-8", "replace").split(CRLF) if stop >= 0 else []
        if not lines or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = [(n.strip().lower(), v.strip()) for n, _, v in (line.partition(":") for line in lines[1:])]
        size = int(dict(headers)["content-length"])
        begin = stop + len(gap)
        if begin + size > len(content):
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, view[begin : begin + size]
        at = begin + size
        while content[at : at + 2] == CRLF.encode():
            at += 2


def _row(headers: list[tuple[str, str]], block: memoryview, with_payload: bool) -> tuple:
    one = dict(headers)
    kind = one.get("warc-type")
    joined = [v for n, v in headers if n == "warc-concurrent-to"]
    payload, fields = None, None
    if kind in (RESPONSE, REVISIT):
        whole = bytes(block)
        head = whole.find(END.encode())
        payload = whole[head + len(END) :] if head >= 0 else whole
    elif kind == METADATA:
        lines = bytes(block).decode("utf-8", "replace").split(CRLF)
        fields = [(n.strip(), v.strip()) for n, _, v in (line.partition(":") for line in lines if line)]
    digest = one.get("warc-payload-digest")
    row = (
        kind, one.get("warc-record-id"), joined, one.get("warc-refers-to"),
        unquote_plus(one.get("warc-target-uri", "")), digest and digest.removeprefix("sha1:"), fields,
        None if payload is None else len(payload), None if payload is None else base32_digest(payload),
    )
    return (*row, payload) if with_payload else row


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; ``payload_bytes`` and ``true_digest`` are
    of the payload that is there."""
    schema = RECORD + (", payload binary" if with_payload else "")
    texts = pa.string()
    types = [texts, texts, pa.list_(texts), texts, texts, texts, pa.map_(texts, texts), pa.int64(), texts]
    types += [pa.binary()] if with_payload else []
    names = [f.split()[0] for f in RECORD.split(", ")] + (["payload"] if with_payload else [])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for found in batches:
            for content in found.column(0):
                for headers, block in parsed(_inflated(content.as_py())):
                    rows.append(_row(headers, block, with_payload))
                    size += len(block)
                    if len(rows) >= RECORDS_PER_BATCH or size >= BYTES_PER_BATCH:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(parse, schema)


def captures(found: DataFrame) -> DataFrame:
    """One row per capture, its records nested: ``capture``, ``response``, ``request``, ``metadata``.

    Requests and metadata are joined by the records they name in ``WARC-Concurrent-To``; one
    without such a record still gives a row. ``found`` is read three times: pass a stored table.
    """

    def side(name: str, *kinds: str) -> DataFrame:
        rows = found.filter(F.col("kind").isin(*kinds))
        record = F.struct(*[c for c in found.columns if c != "concurrent_to"]).alias(name)
        if name == "response":
            return rows.select(F.col("record_id").alias("capture"), record)
        return rows.select(F.explode_outer("concurrent_to").alias("capture"), record)

    joined = side("response", RESPONSE, REVISIT)
    for name in (REQUEST, METADATA):
        joined = joined.join(side(name, name), "capture", "full_outer")
    return joined


def archived(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write all pages as archives below ``path``."""
    size = F.avg(F.octet_length(F.coalesce(F.col(payload).cast("string"), F.lit(""))))
    mean = pages.agg(size.alias("mean")).first()["mean"] or 0.0
    write(planned(pages, key, url, payload), path, mean)


def page_rows(assembled: DataFrame, key: str = "page_id") -> DataFrame:
    """Per capture: the page's key, size and digest of the full payload, the record type, and the
    page a revisit refers to. A response's size and digest are those of the bytes read back."""
    kind = F.col("response.kind")
    there = kind == RESPONSE
    told = F.col("metadata.fields")
    page = F.try_element_at(told, F.lit("pageId")).cast("bigint")
    size = F.try_element_at(told, F.lit("payloadBytes")).cast("bigint")
    other = F.regexp_extract(F.col("response.refers_to"), "<urn:page:(-?[0-9]+)>", 1).cast("bigint")
    return assembled.filter(F.col("response").isNotNull()).select(
        page.alias(key),
        F.when(there, F.col("response.payload_bytes")).otherwise(size).alias("payload_bytes"),
        F.when(there, F.col("response.true_digest")).otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(~there, other).alias("refers_to"),
    )


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Pages written to archives in the shared folder, read back and assembled."""
    path = shared_folder(pages.sparkSession, "warc")
    archived(pages, path, key, url, payload)
    found = stored(read_records(pages.sparkSession, path, with_payload=False), "warc-records")
    return page_rows(captures(found), key)
