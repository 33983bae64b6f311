import random
import zlib

import pytest

from changeflow.llm import archives as A
from changeflow.llm.common import written


def test_both_versions_and_their_lines():
    for version in (1, 2):
        start = A.arc_start("x.arc", version)
        content = start + A.arc_record("http://a/b c", b"<p>\n\nURL 1</p>", 7, version) + A.arc_record("", b"", None, version)
        got = list(A.parse_arc("x.arc", content))
        assert [(r["key"], r["url"], r["payload"], r["payload_bytes"]) for r in got] == [(7, "http://a/b%20c", b"<p>\n\nURL 1</p>", 14), (None, "-", b"", 0)]
        assert got[0]["payload_digest"] != got[1]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
        assert got[0]["record_id"] == next(A.parse_arc("x.arc", content))["record_id"]
    assert A.iso_date("20010203040506") == "2001-02-03T04:05:06Z" and A.iso_date("20010203") == "2001-02-03T00:00:00Z" and A.iso_date("?") == "1970-01-01T00:00:00Z"


def test_spaces_in_a_url_and_a_block_without_http():
    content = A.arc_start("x", 1) + b"http://a/b c d 1.2.3.4 19990101000000 text/plain 5\nhello\n"
    r, = A.parse_arc("x", content)
    assert (r["url"], r["ip"], r["payload"]) == ("http://a/b c d", "1.2.3.4", b"hello")


@pytest.mark.parametrize("damage", [lambda c: c[:-5], lambda c: c.replace(b"text/html", b"text/html x y", 1)[:60], lambda c: b"x" + c, lambda c: c.replace(b"\n2 0", b"\n9 0", 1)])
def test_damaged_archives_are_refused(damage):
    with pytest.raises(ValueError):
        list(A.parse_arc("x", damage(A.arc_start("x", 2) + A.arc_record("u", b"payload", 1, 2))))


PAGES = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://d", ""), (5, "u v", "Ünique\r\n\r\n"), (5, "u v", "twice"), (5, "u v", "twice"), (None, "x", "same"), (6, "y", "z" * 300_000)]


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip_and_revisits(spark, version):
    pages = spark.createDataFrame([p + ("x", "x", "x") for p in PAGES], "page_id long, url string, html string, key string, payload string, archive string")
    records = A.read_arc(A.write_arc(pages, version=version, archive_bytes=1000))
    for least in (0, 3, 5):
        got = A.read_warc(written(A.write_warc(A.mark_revisits(records, least), archive_bytes=1000), "test")).collect()
        want = []
        for page, _, html in PAGES:
            body = (html or "").encode()
            top = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
            revisit = len(body) >= least and page != top
            want.append((page, len(body), A.payload_digest(body), "revisit" if revisit else "response", top if revisit else None))
        assert sorted(((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
        assert all((r.payload is None) == (r.record_type == "revisit") for r in got)


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert A.read_warc(written(A.write_warc(A.mark_revisits(A.read_arc(A.write_arc(none)))), "test")).count() == 0


def test_a_member_is_read_without_the_rest_of_the_archive(monkeypatch):
    """Reading an archive takes steps of a bounded size for each record, however many records follow it."""
    record = dict(record_type="response", content_type="text/html", record_id="<x>", date="d", url="u", ip="i", payload_digest="p")
    payloads = [bytes(random.Random(i).randbytes(200)) for i in range(2000)] + [random.Random(7).randbytes(5 * A.READ_BYTES), b""]
    content = b"".join(A.warc_record(record | dict(key=i, payload=p, payload_bytes=len(p))) for i, p in enumerate(payloads))
    fed, unpack = [], zlib.decompressobj

    class Counted:
        def __init__(self, bits):
            self.member = unpack(bits)

        def decompress(self, some):
            fed.append(len(some))
            return self.member.decompress(some)

        def __getattr__(self, name):
            return getattr(self.member, name)

    monkeypatch.setattr(A.zlib, "decompressobj", Counted)
    got = [block.partition(b"\r\n\r\n")[2] for _, block in A.parse_warc(content)]
    assert got == payloads
    assert sum(fed) <= len(payloads) * A.READ_BYTES + len(content)
