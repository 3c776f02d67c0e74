import gzip

import pytest

from auditflow.llm import warc as W
from auditflow.llm.salvage import base32_sha1, salvage


def record(payload, kind="response", digest=None, name="<urn:page:1>"):
    digest = digest or base32_sha1(payload)
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {name}\r\nWARC-Payload-Digest: sha1:{digest}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload + b"\r\n\r\n"


PARTS = [record(b"one"), record(b""), record(b"three\r\n\r\nWARC/1.1\r\nnot a record"), record(b"four" * 50)]


def read(data):
    found = list(salvage(data))
    assert not data or (found[0].start == 0 and found[-1].end == len(data))
    return [f.payload if not f.reason else (f.start, f.end) for f in found]


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_whole_archive(pack):
    data = b"".join(pack(p) for p in PARTS)
    assert read(data) == [b"one", b"", b"three\r\n\r\nWARC/1.1\r\nnot a record", b"four" * 50]


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("bad", range(4))
def test_only_the_damaged_record_is_lost(pack, bad):
    packed = [pack(p) for p in PARTS]
    middle = len(packed[bad]) - 12
    packed[bad] = packed[bad][:middle] + b"\xff" + packed[bad][middle + 1:]
    start = sum(map(len, packed[:bad]))
    expected = [p.partition(b"\r\n\r\n")[2][:-4] for p in PARTS]
    expected[bad] = (start, start + len(packed[bad]))
    assert read(b"".join(packed)) == expected


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_cut_and_foreign_bytes(pack):
    a, b = pack(PARTS[0]), pack(PARTS[3])
    assert read(a + b[:-9] + a) == [b"one", (len(a), len(a + b) - 9), b"one"]
    assert read(b"junk" + a + b"junk") == [(0, 4), b"one", (len(a) + 4, len(a) + 8)]
    assert read(b"") == []
    assert read(a[:20]) == [(0, 20)]
    assert read(gzip.compress(b"")) == [(0, len(gzip.compress(b"")))]


def test_wrong_digest_and_headers():
    assert read(record(b"x", digest="A" * 32) + PARTS[0])[1] == b"one"
    assert [f.reason for f in salvage(PARTS[0].replace(b"Content-Length: 3", b"Content-Length: x"))] == ["no content length"]
    assert [f.reason for f in salvage(PARTS[0].replace(b"Content-Length: 3", b"Content-Length: 2"))] == [
        "the record does not end where its length says"
    ]


def test_revisit_keeps_the_digest_of_the_payload():
    [found] = salvage(record(b"", "revisit", base32_sha1(b"one")))
    assert found.reason is None and found.payload == b""


PAGES = [
    (5, "http://a", "<p>é</p>"), (3, None, "<p>é</p>"), (3, "u\r\nv", "<p>é</p>"), (None, "x", "<p>é</p>"), (9, "x", None), (8, "x", ""),
    (None, "y", "alone"), (7, "z", "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n" * 3), (6, "z", "x" * 300_000),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "warc")
    W.write_warc(W.with_revisits(pages), path)
    found = W.read_warc(spark, path).collect()
    assert all(r.reason is None for r in found)
    got = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_length, r.payload_digest) for r in found)
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = sorted(
        (
            f"<urn:page:{'' if i is None else i}>",
            *(("revisit", f"<urn:page:{first[h or '']}>") if first.get(h or "", i) != i else ("response", "")),
            len((h or "").encode()), base32_sha1((h or "").encode()),
        )
        for i, _, h in PAGES
    )
    assert got == expected
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == {(h or "").encode() for _, _, h in PAGES}


def test_small_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    assert {r.page_id: r.refers_to for r in W.with_revisits(pages, 3).collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    W.write_warc(W.with_revisits(pages), str(tmp_path / "none"))
    assert W.read_warc(spark, str(tmp_path / "none")).count() == 0
