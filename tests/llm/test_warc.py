import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import blobs
from cohortflow.llm.warc import chunked, page_records, read_warc, write_warc

PAGES = "page_id long, url string, html string"


def brute(pages, least=1000):
    best = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if page is not None and len(body) >= least:
            best[body] = max(best.get(body, page), page)
    out = []
    for page, _, html in pages:
        body = (html or "").encode()
        target = best.get(body) if page is not None else None
        again = target is not None and page < target
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", target if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    rnd = random.Random(2)
    big = "<p>" + "é日x\r\n\r\n" * 400
    huge = "".join(rnd.choice("abcdefgh\n") for _ in range(300_000))
    return [
        (1, "http://a/1", big), (2, "http://a/2\n%0A b", big), (3, None, big + "!"), (4, "u", None), (5, "u", ""),
        (6, "u", "short"), (7, "u", "short"), (8, "u", huge), (9, "u", huge), (9, "u", huge), (None, "u", big),
        (10, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60), (11, "u", "x" * 1000), (12, "u", "x" * 1000),
        (13, "u", "x" * 999), (14, "u", "x" * 999),
    ]


@pytest.mark.parametrize("chunk", [97, 1 << 18])
def test_round_trip(spark, pages, chunk):
    df = spark.createDataFrame(pages, PAGES).withColumn("record", F.lit("extra")).withColumn("digest", F.lit(1))
    manifest = write_warc(df.repartition(3), chunk_bytes=chunk)
    got = page_records(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(pages)
    chunks = read_warc(manifest, chunk_bytes=chunk).where("record_type = 'response'").collect()
    whole, urls = {}, {}
    for r in sorted(chunks, key=lambda r: (r.uri, r.record, r.chunk)):
        assert len(r.payload) <= chunk
        whole[r.uri, r.record] = whole.get((r.uri, r.record), b"") + r.payload
        urls[r.uri, r.record] = (r.page_id, r.url)
        assert r.digest == hashlib.sha1(whole[r.uri, r.record]).hexdigest()
    back = sorted((*urls[k], v) for k, v in whole.items() if urls[k][0] not in (None, 9) and urls[k][1])
    want = {p: (p, u, (h or "").encode()) for p, u, h in pages}
    assert back and all(b == want[b[0]] for b in back)


def test_archives_are_plain_gzip_members(spark, pages):
    uri = write_warc(spark.createDataFrame(pages, PAGES).coalesce(1)).first().uri
    with blobs.stream(uri) as source:
        text = gzip.decompress(source.read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.count(b"\r\nWARC-Type: revisit\r\n") == 3


def test_chunks_carry_running_digests(spark):
    rows = chunked(spark.createDataFrame([(1, "u", "abcdefg")], PAGES), 3).orderBy("chunk").collect()
    assert [(bytes(r.payload), r.bytes, r.last) for r in rows] == [(b"abc", 3, False), (b"def", 6, False), (b"g", 7, True)]
    assert [r.digest for r in rows] == [hashlib.sha1(t).hexdigest() for t in (b"abc", b"abcdef", b"abcdefg")]


def test_nothing(spark):
    manifest = write_warc(spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and page_records(manifest).count() == 0
