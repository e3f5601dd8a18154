from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from loanlens.llm import warc


def brute(rows: list[tuple]) -> list[tuple]:
    first: dict = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if page is not None and len(raw) >= 100:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        origin = first.get(raw) if len(raw) >= 100 else None
        again = origin is not None and origin != page
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", origin if again else None))
    return sorted(out, key=str)


def pages() -> list[tuple]:
    rng = random.Random(2)
    big = "".join(rng.choice("<p>é😀 \r\n0") for _ in range(200_000))
    same = "<html>" + "equal " * 40
    texts = [None, "", "short", "short", same, same, same, big, big[:-1], big, "x" * 100, "x" * 99, "x" * 99,
             "WARC/1.1\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 30, "0\r\n\r\n" * 50]
    rows = [(i, f"http://h/{i}\r\nWARC-Type: x", t) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[7], (None, None, same), (-3, "u", "negative " * 20)]


def test_round_trip_matches_brute_force(spark):
    docs = spark.createDataFrame([(*r, 1) for r in pages()], "page_id long, url string, html string, payload int")
    got = [tuple(r) for r in warc.round_trip(docs).collect()]
    assert sorted(got, key=str) == brute(pages())


def test_payloads_come_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 3)
    docs = spark.createDataFrame(pages(), "page_id long, url string, html string")
    warc.write_archives(docs, f"{tmp_path}/archives")
    texts = {r[0]: r[2] for r in pages()}
    read = warc.read_pages(spark, f"{tmp_path}/archives").collect()
    assert len(read) == len(pages())
    for r in read:
        if r.record_type == "response":
            assert bytes(r.payload) == (texts[r.page_id] or "").encode()
        else:
            assert r.payload is None


def test_only_pages_over_several_archives_are_shuffled(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, "u", f"page {i} " * 900) for i in range(6)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(docs, f"{tmp_path}/one")
    rows = warc.read_records(spark, f"{tmp_path}/one", False).collect()
    assert len(rows) == 6 and all(r.number is None and r.part is None for r in rows)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 3)
    warc.write_archives(docs, f"{tmp_path}/some")
    assert warc.read_records(spark, f"{tmp_path}/some", False).where("part IS NOT NULL").count() > 6
    for name in ("one", "some"):
        read = {r.page_id: bytes(r.payload).decode() for r in warc.read_pages(spark, f"{tmp_path}/{name}").collect()}
        assert read == {i: f"page {i} " * 900 for i in range(6)}


def test_an_archive_that_stands_twice_is_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(1, "u", "page " * 900)], "page_id long, url string, html string").coalesce(1)
    warc.write_archives(docs, f"{tmp_path}/one")
    (archive,) = [p for p in (tmp_path / "one").glob("part-*")]
    (tmp_path / "one" / f"again-{archive.name}").write_bytes(archive.read_bytes())
    with pytest.raises(Exception, match="repeated in another archive"):
        warc.read_pages(spark, f"{tmp_path}/one").collect()


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunked_framing(payload, size):
    assert warc.dechunked(warc.chunked(payload, size)) == payload


def test_chunk_extensions_and_broken_frames():
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab", b"3\r\nabcXX0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_segments_are_checked():
    assert warc.reassembled([(2, 4, b"cd"), (1, None, b"ab")]) == b"abcd"
    for bad in ([(2, 2, b"cd")], [(1, None, b"ab"), (3, 4, b"cd")], [(1, None, b"ab"), (2, 5, b"cd")], [(1, None, b"a"), (1, 2, b"b")]):
        with pytest.raises(ValueError):
            warc.reassembled(bad)


def test_records_of_an_archive():
    one = warc.record([("WARC-Type", "response")], b"a\r\n\r\nWARC/1.1")
    two = warc.record([("WARC-Type", "revisit")], b"")
    archive = one + b"\r\n\r\n" + two + b"\r\n\r\n"
    assert [(f["warc-type"], b) for f, b in warc.records_of(archive)] == [("response", b"a\r\n\r\nWARC/1.1"), ("revisit", b"")]
    with pytest.raises(ValueError):
        list(warc.records_of(one[:-3]))
