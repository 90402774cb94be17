import gzip
import hashlib
from io import BytesIO

import pytest

from telemsg.llm.common import shared_path
from telemsg.llm.warc import WarcError, gzip_member, parse, read_archive, read_warc, record, round_trip, write_warc


def rows():
    big = "<p>" + "é" * 1000
    return [
        (1, "http://a/1", "<p>small"), (2, "http://a/2", "<p>small"), (3, "u3", big), (5, "u5", big), (4, "u4", big),
        (6, None, None), (7, "line\r\nbreak %0D", ""), (8, "u8", "x" * 999), (9, "u9", "x" * 999), (10, "u10", "y" * 300_000),
        (None, "no id", big), (11, "u", "a\r\n\r\nb" * 400), (3, "u3", big),
    ]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, 1) for r in rows()], "page_id long, url string, html string, refers_to int")
    got = round_trip(pages, with_payload=True, max_bytes=2000).collect()
    assert len(got) == len(rows())
    for r in got:
        html = next((h or "").encode() for i, _, h in rows() if i == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(html), hashlib.sha1(html).hexdigest())
        revisit = r.page_id in (3, 4, None)
        assert (r.record_type, r.refers_to) == (("revisit", 5) if revisit else ("response", None))
        assert r.payload is None if revisit else bytes(r.payload) == html
    assert {r.url for r in got} >= {"line\r\nbreak %0D", "", "no id"}
    assert round_trip(pages.limit(0)).count() == 0


def test_rewrite_gives_the_same_archives(spark):
    pages = spark.createDataFrame(rows(), "page_id long, url string, html string")
    folder = shared_path(spark, "again")
    assert write_warc(pages, folder) == write_warc(pages.repartition(3), folder) == len(rows())
    assert read_warc(spark, folder).count() == len(rows())


def test_reader_checks():
    good = record(1, "u", b"payload")
    both = gzip_member(good) + gzip_member(record(2, "v", b""))
    assert gzip.decompress(both).startswith(b"WARC/1.1\r\n")
    assert [r.payload() for r in read_archive(BytesIO(both))] == [b"payload", b""]
    for bad in (good.replace(b"payload", b"pAyload"), good[:-1], good.replace(b"Content-Length: 7", b"Content-Length: 6")):
        with pytest.raises(WarcError):
            list(read_archive(BytesIO(gzip_member(bad))))
    for cut in (both[:-3], both[:40], both + b"junk"):
        with pytest.raises(WarcError):
            list(read_archive(BytesIO(cut)))
    assert parse(good).http_length() == 7
