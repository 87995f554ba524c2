import gzip
import hashlib
import base64
import random

import pytest

from prosemill.llm import warc as W
from prosemill.llm import web_archive as A
from prosemill.llm.shared import new_folder
from tests.conftest import rows

SCHEMA = "page_id long, url string, html string"


def plain(pages, least=0):
    result, first = [], {}
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        payload = (html or "").encode()
        code = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        stored = first.setdefault(payload, page_id) if payload in first or len(payload) >= least else None
        again = len(payload) >= least and (payload, "seen") in first
        first[payload, "seen"] = True
        result.append((page_id, len(payload), code, "revisit" if again else "response", stored if again else None))
    return sorted(result, key=str)


def sample(seed=1):
    rng = random.Random(seed)
    pages = [(i, f"http://a/{i}", "".join(rng.choice("ab é東\r\n<😀") for _ in range(rng.choice([0, 3, 50, 900])))) for i in range(40)]
    copies = [(100 + i, None, pages[rng.randrange(40)][2]) for i in range(30)]
    odd = [(200, "http://x y\r\nWARC-Type: z", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n"), (201, None, None), (None, "u", "no id"), (None, "u", "no id")]
    return pages + copies + odd


@pytest.mark.parametrize(("segment", "chunk", "volume"), [(1 << 16, 1 << 13, 16 << 20), (7, 3, 200), (100, 1000, 1)])
def test_round_trip(spark, segment, chunk, volume):
    pages, path = sample(), new_folder(spark, "warc")
    df = spark.createDataFrame(pages, SCHEMA).repartition(3)
    A.write_archives(df, path, segment, chunk, volume, compression="gzip" if volume != 200 else "none")
    found = A.read_pages(spark, path).collect()
    assert not [r for r in found if r["fault"]] and len(found) == len(pages)
    by_id = {r["record_id"]: r for r in found}
    html = {p: (h or "").encode() for p, _, h in pages}
    for row in found:
        holder = by_id[row["refers_to_uri"]] if row["type"] == "revisit" else row
        assert bytes(holder["payload"]) == html[row["page_id"]] and holder["payload_digest"] == row["stated_digest"]
    if volume == 200:  # segments of one record lie in several files
        files = spark.read.format("binaryFile").load(path).select("content").collect()
        assert len(files) > 100 and any(bytes(f["content"]).startswith(b"WARC/1.1\r\nWARC-Type: continuation") for f in files)


def test_report_agrees_with_plain_code(spark):
    pages = sample(2)
    extra = spark.createDataFrame([(*p, 1, "x") for p in pages], SCHEMA + ", locator int, key string").repartition(4)
    assert sorted(rows(A.archive_report(extra)), key=str) == plain(pages)


def test_short_payloads_may_be_stored_each(spark):
    pages, path = sample(3), new_folder(spark, "warc")
    A.write_archives(spark.createDataFrame(pages, SCHEMA), path, least_bytes=50)
    found = [(r["page_id"], r["type"]) for r in A.read_pages(spark, path).collect()]
    assert sorted(found, key=str) == sorted([(p, t) for p, _, _, t, _ in plain(pages, 50)], key=str)


def test_equal_pages_of_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(A, "LEAST_HOT", 20)
    pages = [(i, None, "same") for i in range(60)] + [(100 + i, None, f"page {i // 2}") for i in range(100)]
    assert sorted(rows(A.archive_report(spark.createDataFrame(pages, SCHEMA).repartition(5))), key=str) == plain(pages)


def test_empty_table_and_very_long_pages(spark):
    assert rows(A.archive_report(spark.createDataFrame([], SCHEMA))) == []
    pages = [(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (3, "u", "x " * 100)]
    assert sorted(rows(A.archive_report(spark.createDataFrame(pages, SCHEMA))), key=str) == plain(pages)


def block(payload=b"hello world", **more):
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Date": A.DATE, "Page-ID": 1, **more}
    return fields, head + W.chunked(payload, 4)


def stored(spark, *archives):
    path = new_folder(spark, "warc")
    spark.createDataFrame([(bytearray(a),) for a in archives], "a binary").selectExpr("cast(a as string) a").write.option(
        "lineSep", "\r\n\r\n").option("maxRecordsPerFile", 1).text(path)
    return A.read_pages(spark, path)


def test_faults_of_segments_are_named(spark):
    fields, body = block()
    parts = list(W.segmented(fields, body, 20))
    assert len(parts) >= 4

    def fault(*archives):
        return [r["fault"] for r in stored(spark, *archives).collect()]

    assert fault(*parts) == [None] and fault(*reversed(parts)) == [None]
    assert fault(*parts[1:]) == ["no first segment"]
    assert fault(parts[0], *parts[2:]) == ["segments missing or repeated"]
    assert fault(*parts, parts[1]) == ["segments missing or repeated"]
    assert fault(*parts[:-1]) == ["no total length"]
    assert fault(*parts[:-1], parts[-1].replace(b"Total-Length: %d" % len(body), b"Total-Length: 7")) == ["not the total length"]
    other, body = block(**{"WARC-Payload-Digest": "sha1:AAAA"})
    assert fault(W.record_bytes(other, body)) == ["another digest than stated"]
    assert fault(W.record_bytes(fields, body[:-4] + b"\r\nxx")) != [None]


def test_chunked_framing():
    for size in (1, 3, 100):
        for payload in (b"", b"a", b"\r\n0\r\n\r\n", bytes(range(256))):
            assert W.unchunked(W.chunked(payload, size)) == payload
    assert W.unchunked(b"3;name=x\r\nabc\r\n0A\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    for broken in (b"", b"3\r\nab\r\n0\r\n\r\n", b"x\r\n\r\n", b"3\r\nabc\r\n", b"0\r\n", b"0\r\n\r\nmore", b"-1\r\na\r\n0\r\n\r\n"):
        with pytest.raises(W.Malformed):
            W.unchunked(broken)


def test_archives_of_others():
    one = b"WARC/1.0\r\nwarc-type:  response \r\nX: a\r\n  b\r\nCONTENT-LENGTH: 4" + b"\r\n" * 6
    two = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for archive in (one + two, gzip.compress(one) + gzip.compress(two)):
        found = list(W.records(archive))
        assert [r.fields["warc-type"] for r in found] == ["response", "warcinfo"]
        assert found[0].block == b"\r\n\r\n" and found[0].fields["x"] == "a b"
    for broken in (one[:-1], one[3:], one.replace(b"4", b"5"), one.replace(b"CONTENT-LENGTH: 4\r\n", b""), gzip.compress(one)[:-9]):
        with pytest.raises(W.Malformed):
            list(W.records(broken))
    assert W.payload_of(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody") == b"body"
    with pytest.raises(W.Malformed):
        W.payload_of(b"body alone")
