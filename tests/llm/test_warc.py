import hashlib

import pytest

from logloom.llm import warc
from logloom.llm.common import new_path


@pytest.fixture()
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, sha1 string")

    return make


def test_round_trip_and_revisits(pages):
    big, small = "<p>é</p>" * 200, "<p>x</p>"
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (2, "http://a\r\nX: y", small), (4, "u", small), (6, "u", None), (7, "u", ""), (9, "u", "<html>" + "z" * 2000)]
    got = {r["page_id"]: r for r in warc.archive_round_trip(pages(rows)).collect()}
    assert set(got) == {r[0] for r in rows}
    for page, _, html in rows:
        data = (html or "").encode()
        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert {p: (r["record_type"], r["refers_to"]) for p, r in got.items() if r["record_type"] == "revisit"} == {1: ("revisit", 5), 3: ("revisit", 5)}


def test_null_and_repeated_ids(pages):
    big = "q" * 1500
    got = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages([(None, "u", big), (2, "u", big), (2, "u", big), (1, "u", big)])).collect())
    assert got == [(-1, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "response", None)]


def test_empty_table(pages):
    assert warc.archive_round_trip(pages([])).count() == 0


def test_archives_roll_and_start_with_the_dictionary(spark, pages):
    folder = new_path(spark, "test-warc")
    rows = [(i, f"http://h/{i}", f"<html><body>{i} " + "text of a page " * 40 + "</body></html>") for i in range(120)]
    manifest = warc.write_archives(pages(rows).coalesce(1), folder, archive_bytes=2000).collect()
    assert len(manifest) > 1 and sum(r["records"] for r in manifest) == 120
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).first()["content"]
    assert bytes(content[:4]) == b"\x5d\x2a\x4d\x18"
    payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, folder).collect()}
    assert payloads == {f"urn:page:{i}": h for i, _, h in rows}


def _archive(*records: bytes) -> bytes:
    import zstandard

    return b"".join(zstandard.ZstdCompressor(write_checksum=True).compress(r) for r in records)


def test_bad_frames_and_records_fail():
    good = warc.page_record("urn:page:1", "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    whole = _archive(good)
    assert warc.parse_page(next(warc.read_frames(whole)))[3] == 3
    for content in (whole[:-3], b"junk" + whole, whole[:10] + b"\xff" + whole[11:]):
        with pytest.raises(warc.WarcError):
            list(warc.read_frames(content))
    for record in (good[:-2], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"Content-Length: ", b"Content-Length: x"), good.replace(b"abc", b"abd"), good.replace(b"WARC-Date", b"WARC-Dote")):
        with pytest.raises(warc.WarcError):
            warc.parse_page(record)
