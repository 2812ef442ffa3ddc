from __future__ import annotations

import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm.warc import archive_folder, byte_ranges, parsed, read_archives, record, records_in, write_archives

LONG = "<p>" + "long enough to be revisited " * 6


def archive(name, payloads):
    digest = lambda p: hashlib.sha256(p).hexdigest()
    return b"".join(record(name, "response", k, f"http://h/{k}", "2024-01-01T00:00:00Z", p, digest(p), len(p), None) for k, p in enumerate(payloads))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=300), st.just(b"\x1f\x8b\x08" * 20)), max_size=8), st.integers(1, 700))
def test_every_range_owns_the_records_that_start_in_it(payloads, split):
    data = archive("a", payloads)
    found = []
    for start in range(0, len(data), split):
        for at, head, payload in records_in(io.BytesIO(data), len(data), "a", start, min(len(data), start + split)):
            assert start <= at < start + split
            found.append((int(head["x-page-id"]), payload))
    assert found == list(enumerate(payloads))


def test_an_archive_inside_a_payload_is_not_read_as_this_one():
    inner = archive("inner", [b"x" * 50, b"y" * 50]) * 30
    data = archive("outer", [b"first", inner, b"last"])
    ranges = [(s, min(len(data), s + 97)) for s in range(0, len(data), 97)]
    assert [p for a, b in ranges for _, _, p in records_in(io.BytesIO(data), len(data), "outer", a, b)] == [b"first", inner, b"last"]


def test_cut_off_archives_and_other_content_raise():
    data = archive("a", [b"one", b"two"])
    with pytest.raises(ValueError, match="cut off"):
        list(records_in(io.BytesIO(data[:-5]), len(data) - 5, "a", 0, len(data)))
    with pytest.raises(ValueError, match="not a WARC"):
        parsed(b"HTTP/1.1 200 OK\r\n\r\n")
    assert list(records_in(io.BytesIO(gzip.compress(b"other")), 30, "a", 0, 30)) == []


def test_pages_read_back(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.warc.ARCHIVE_BYTES", 900)
    rows = [
        (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, None, LONG), (9, None, LONG), (None, "http://a/\r\nX: y", LONG), (None, None, None), (1, "", "short"), (2, "u", "short"),
        (4, "u", None), (6, "u", ""), (7, "ü", "é漢🙂\x00" * 40), (8, "u", "é漢🙂\x00" * 40), (10, "u", "z" * 300_000), (-4, "u", "minus " * 40),
    ]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    archives = write_archives(pages, archive_folder(spark))
    assert archives.count() > 1
    got = read_archives(archives, split_bytes=200).collect()
    first = {LONG: 3, "é漢🙂\x00" * 40: 7}

    def expected(page, html):
        body = (html or "").encode()
        target = first.get(html) if page is not None else None
        revisit = target is not None and target != page
        return page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", target if revisit else None

    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in got), key=str) == sorted((expected(i, h) for i, _, h in rows), key=str)
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in got)
    assert byte_ranges(archives, 100).where("end <= start").isEmpty()


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(write_archives(empty, archive_folder(spark))).collect() == []
