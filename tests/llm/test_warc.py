"""Archives: every page there and back, beside hashlib; foreign and broken archives."""

import base64
import gzip
import hashlib
from collections import defaultdict

import pytest
from llm_tables import SF_DIR

from tallyguard.llm import queries, warc


def by_hand(pages):
    least, out = {}, []
    for key, html in pages:
        body = (html or "").encode()
        if key is not None:
            least[body] = min(key, least.get(body, key))
    for key, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        own = body not in least or least[body] == key
        out.append((key, len(body), digest, "response" if own else "revisit", None if own else least[body]))
    return sorted(out, key=repr)


def rows_of(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()]
    assert rows_of(queries.QUERIES["op12_warc"](spark, SF_DIR)) == by_hand(pages)


NASTY = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
ODD = [
    (5, "http://x/ü a+b%20\n", NASTY), (3, None, NASTY), (5, "u", NASTY), (1, "u", None), (2, "u", ""), (None, "u", ""),
    (None, None, "only here"), (None, None, "only here"), (9, "u", "\r\n\r\n"), (10, "u", "é" * 300000), (11, "u", "\u0000x"),
    (-4, "u", "é" * 300000), *[(100 + i, "u", "same") for i in range(50)],
]


def odd_pages(spark):
    return spark.createDataFrame([(*r, 1, "y") for r in ODD], "page_id bigint, url string, html string, key int, payload string")


def test_odd_pages(spark):
    table = odd_pages(spark)
    assert rows_of(warc.round_trip(table)) == by_hand([(k, h) for k, _, h in ODD])
    assert rows_of(warc.round_trip(table.limit(0))) == []


def test_payloads_and_files(spark, tmp_path):
    """Payloads and URIs come back byte for byte, also from many small files."""
    warc.write(warc.planned(odd_pages(spark)), str(tmp_path / "w"), 10.0, file_bytes=4000)
    assert len(list((tmp_path / "w").glob("part-*"))) > 5
    found = warc.read_records(spark, str(tmp_path / "w"))
    back = defaultdict(list)
    for r in warc.captures(found).collect():
        assert r["request"]["kind"] == "request"
        if r["response"]["kind"] == "response":
            assert r["response"]["payload_digest"] == r["response"]["true_digest"]
            key = r["metadata"]["fields"].get("pageId")
            back[key and int(key)].append((r["response"]["uri"], r["response"]["payload"].decode()))
    kinds = by_hand([(k, h) for k, _, h in ODD])
    responses = {k for k, _, _, kind, _ in kinds if kind == "response"}
    assert set(back) == responses
    assert back[3] == [("", NASTY)] and back[-4] == [("u", "é" * 300000)] and len(back[None]) == 2
    spoken = {u for k, u, _ in ODD if k == 1}
    assert {u for u, _ in back[1]} == spoken


def test_foreign_archives(spark, tmp_path):
    """Several concurrent identifiers, records without partner, a gzip member per record."""

    def record(kind, name, block, *more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", *more, f"Content-Length: {len(block)}"]
        return "\r\n".join(["WARC/1.0", *head, "", ""]).encode() + block + b"\r\n\r\n"

    first = [record("warcinfo", "i", b"x"), record("request", "q1", b"GET", "WARC-Concurrent-To: <r1>")]
    second = [
        record("metadata", "m", b"a: b\r\n", "WARC-Concurrent-To: <r1>", "warc-concurrent-to: <r2>"),
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody"), record("response", "r2", b"raw"),
        record("request", "q9", b"GET", "WARC-Concurrent-To: <gone>"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(first))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, second)))
    rows = warc.captures(warc.read_records(spark, str(tmp_path))).collect()
    told = {
        r["capture"]: tuple(r[n] and r[n]["record_id"] for n in ("response", "request", "metadata")) for r in rows
    }
    assert told == {"<r1>": ("<r1>", "<q1>", "<m>"), "<r2>": ("<r2>", None, "<m>"), "<gone>": (None, "<q9>", None)}
    payloads = {r["capture"]: r["response"] and bytes(r["response"]["payload"]) for r in rows}
    assert payloads["<r1>"] == b"body" and payloads["<r2>"] == b"raw"


@pytest.mark.parametrize("content", [b"junk", b"WARC/1.0\r\nContent-Length: 9\r\n\r\nshort"])
def test_broken_archives(content):
    with pytest.raises(ValueError):
        list(warc.parsed(content))
