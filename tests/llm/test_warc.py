"""WARC archives: round trips, offsets, damage."""

import base64
import gzip
import hashlib
import io

import pytest

from sitefold.llm import warc_normalize as W

PAGES = "page_id long, url string, html string, size string, sha1 string"


def want(rows, least=0):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        original = first.get(html or "")
        repeat = len(raw) >= least and original is not None and original != page
        out.append((page, len(raw), digest, "revisit" if repeat else "response", original if repeat else None))
    return sorted(out, key=repr)


ROWS = [
    (3, "http://a.example/x", "<p>é</p>"), (1, "http://b.example/\r\nWARC-Type: x", "<p>é</p>"), (2, None, None), (9, "u", ""),
    (4, "u", "WARC/1.0\r\n\r\n" * 3), (5, "u", "z" * 3_000_000), (7, "u", "z" * 3_000_000), (6, "u", "ü\r\n\r\n"),
    (8, "u", "once"), (8, "u", "once"), (None, "u", "<p>é</p>"), (None, "u", "alone"),
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "s", "t") for r in ROWS], PAGES).repartition(3)
    for least in (0, 5):
        got = [tuple(r) for r in W.archive_and_read(spark, pages, least).collect()]
        assert sorted(got, key=repr) == want(ROWS, least)


def test_no_pages(spark):
    assert W.archive_and_read(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_each_record_is_a_member_at_its_offset(tmp_path):
    raw = b"".join(p for page, url, html in ROWS for p in W.record(page, url, (html or "").encode(), None))
    sink = io.BytesIO()
    rows = list(W.normalise_file(io.BytesIO(gzip.compress(raw)), W._Counting(sink), "x"))
    data = sink.getvalue()
    assert gzip.decompress(data) == raw and len(rows) == len(ROWS)
    for row, (_, _, html) in zip(rows, ROWS, strict=True):
        fields, block = W.read_member(data[row["offset"] : row["offset"] + row["length"]])
        assert block.partition(b"\r\n\r\n")[2] == (html or "").encode() and "\n" not in fields.get("warc-target-uri", "")
    # members of their own are read as well
    again = list(W.normalise_file(io.BytesIO(data), W._Counting(io.BytesIO()), "x"))
    assert [r["length"] for r in again] == [r["length"] for r in rows]


def test_damage_keeps_what_came_before():
    raw = b"".join(p for k in range(50) for p in W.record(k, "u", bytes(str(k) * 500, "ascii"), None))
    for data in (gzip.compress(raw)[:-60], gzip.compress(raw[:-40]), gzip.compress(raw + b"junk\r\n\r\n"), b"no gzip"):
        rows = list(W.normalise_file(io.BytesIO(data), W._Counting(io.BytesIO()), "x"))
        assert rows[-1]["error"] and all(r["error"] is None for r in rows[:-1])
    assert list(W.normalise_file(io.BytesIO(b""), W._Counting(io.BytesIO()), "x"))[0]["error"]


def test_an_address_of_some_megabytes_loses_no_page(spark):
    rows = [(1, "u", "a"), (2, "data:text/html," + "x" * 3_000_000, "b"), (3, "u", "c")]
    pages = spark.createDataFrame([(*r, "s", "t") for r in rows], PAGES).coalesce(1)
    assert sorted((tuple(r) for r in W.archive_and_read(spark, pages).collect()), key=repr) == want(rows)


def test_damage_and_missing_records_are_told(spark):
    archives = spark.createDataFrame([("a", 2), ("b", 1)], W.ARCHIVES)
    row = lambda path, error=None: (path, 0, 1, "r", "response", None, None, 1, error)
    W.check_whole(archives, spark.createDataFrame([row("a"), row("a"), row("b")], W.INDEX))
    for rows in ([row("a"), row("b")], [row("a"), row("a"), row("b"), row("b", "cut short")]):
        with pytest.raises(RuntimeError):
            W.check_whole(archives, spark.createDataFrame(rows, W.INDEX))
