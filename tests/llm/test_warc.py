"""Archives written and read back; broken ones."""

from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard

from signal_lake.llm import warc as W

PAGE = "<html><body>" + "some text of a page " * 20 + "</body></html>"


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [
        (1, "http://a.example/ä b?x=%20\r\nWARC-Type: x", PAGE), (2, "http://b.example/", PAGE), (2, "http://b.example/", PAGE), (3, None, None), (4, "", ""), (5, "u", ""),
        (None, "http://n.example/", PAGE), (6, "v", "x" * 99), (7, "v", "x" * 99), (8, "v", "x" * 100), (9, "v", "x" * 100), (10, "w", "é" * 60_000 + "\r\n\r\nWARC/1.1\r\n"), (11, "w", "\u0000🙂"),
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS row", "2 AS digest", "3 AS page", "4 AS payload", "5 AS first")


def test_odd_pages(spark, odd_pages):
    rows = W.round_trip(odd_pages).collect()
    want = []
    for r in odd_pages.collect():
        data = (r.html or "").encode()
        want.append((str(r.page_id), len(data), hashlib.sha256(data).hexdigest()))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in rows) == sorted(want)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert kinds == {
        (1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None), (5, "response", None), (None, "revisit", 1), (6, "response", None),
        (7, "response", None), (8, "response", None), (9, "revisit", 8), (10, "response", None), (11, "response", None),
    }
    assert W.round_trip(odd_pages.limit(0)).collect() == []


def test_copies_of_one_row_have_one_response(spark):
    pages = spark.createDataFrame([(5, "u", PAGE)] * 7, "page_id bigint, url string, html string").repartition(3)
    rows = W.round_trip(pages).collect()
    assert sorted((r.record_type, r.refers_to) for r in rows if r.record_type == "revisit") == [("revisit", 5)] * 6 and len(rows) == 7


def test_archives_roll_and_the_address_comes_back(spark, odd_pages, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "ROLL", 700)
    archives = W.write_archives(odd_pages, "page_id", "url", "html", f"file://{tmp_path}/archives")
    assert archives.count() > 3 and archives.selectExpr("sum(records)").first()[0] == 13
    listed = W.list_archives(f"file://{tmp_path}/archives", spark)
    assert listed.count() == archives.count()
    rows = W.read_archives(listed).collect()
    assert {r.target for r in rows if r.record_id == "<urn:page:1>"} == {"http://a.example/ä b?x=%20\r\nWARC-Type: x"}


def archive(records, dictionary=b"", head=True):
    compressor = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor()
    return (W.head_frame(dictionary) if dictionary and head else b"") + b"".join(map(compressor.compress, records))


GOOD = W.format_record("1", "http://a.example/", PAGE.encode(), None, "2024-01-01T00:00:00Z")


def test_dictionary_as_it_is_and_as_a_frame():
    samples = [f"record {i} of words and more words {i * 7919 % 1000} ".encode() * 9 for i in range(200)]
    trained = zstandard.train_dictionary(2048, samples).as_bytes()
    packed = archive([GOOD, GOOD], trained)
    assert list(W.read_frames(io.BytesIO(packed))) == [GOOD, GOOD]
    plain = struct.pack("<II", W.MAGIC, len(trained)) + trained + archive([GOOD], trained, head=False)
    assert list(W.read_frames(io.BytesIO(plain))) == [GOOD]
    assert list(W.read_frames(io.BytesIO(archive([GOOD] * 3)))) == [GOOD] * 3
    assert list(W.read_frames(io.BytesIO(b""))) == []
    with pytest.raises(W.BrokenArchive):
        list(W.read_frames(io.BytesIO(archive([GOOD], trained, head=False))))  # its dictionary is missing
    for cut in (4, 9, len(packed) // 2, len(packed) - 3):
        with pytest.raises((W.BrokenArchive, zstandard.ZstdError)):
            list(W.read_frames(io.BytesIO(packed[:cut])))


@pytest.mark.parametrize("broken", [
    GOOD.replace(b"WARC/1.1", b"WARK/1.1"), GOOD[:-2], GOOD + b"x", GOOD.replace(b"some text", b"same text", 1), GOOD.replace(b"WARC-Date", b"WARC-Day"),
    GOOD.replace(b"Content-Length: ", b"Content-Length: x", 1), GOOD.replace(b"sha256:", b"md5:", 1), GOOD.replace(b"WARC-Type: response", b"WARC-Type response"), b"",
])
def test_broken_records(broken):
    with pytest.raises(ValueError):
        W.parse_record(broken)


def test_defects_are_rows(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive([GOOD, GOOD[:-1], GOOD]))
    (tmp_path / "b.warc.zst").write_bytes(archive([GOOD, GOOD])[:-5])
    rows = W.read_archives(W.list_archives(f"file://{tmp_path}", spark)).collect()
    assert sum(r.error is None for r in rows) == 3 and sum(r.error is not None for r in rows) == 2
