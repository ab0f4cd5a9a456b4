"""WARC archives: records, revisits and joined reads."""

import gzip
import hashlib

from strata.llm import warc as W
from strata.llm.storage import open_input

BIG, SMALL = "x" * 1000, "y" * 999
PAGES = [(1, "http://a/1", BIG), (2, None, BIG), (3, "http://a/3\r\nX: y", SMALL), (4, "http://a/4", SMALL), (5, "http://é/5", None),
         (6, "http://a/6", ""), (7, "http://a/7", "é" * 500), (8, "http://a/8", "é" * 500), (9, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 9),
         (None, "n", BIG), (2, "again", BIG), (10, "long", "z" * 2_000_000), (11, "only nulls", "w" * 1200)]


def want(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        group = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        keeper = max(group) if len(data) >= 1000 and sum((h or "").encode() == data for _, _, h in rows) > 1 and group else None
        revisit = keeper is not None and keeper != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    keeper if revisit else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_pages_read_back(spark):
    index = W.write_archives(frame(spark, PAGES).repartition(3), W.archive_folder(spark), file_bytes=2000)
    rows = index.collect()
    assert len(rows) == len(PAGES) and len({r.path for r in rows}) > 1
    got = W.read_records(index, read_bytes=700).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(PAGES)
    assert {r.page_id: r.url for r in got}[2] in (None, "again")


def test_archives_are_plain_gzip_members(spark):
    index = W.write_archives(frame(spark, PAGES[:4]).coalesce(1), W.archive_folder(spark)).collect()
    with open_input(index[0].path) as file:
        data = file.read()
    assert sum(r.length for r in index) == len(data)
    text = gzip.decompress(data).decode()
    assert text.count("WARC/1.1\r\n") == 4 and text.count("WARC-Type: revisit") == 1
    assert "\r\nX: y" not in text and "http://a/3%0D%0AX: y" in text


def test_selected_records_only(spark):
    index = W.write_archives(frame(spark, PAGES), W.archive_folder(spark))
    got = W.read_records(index.where("page_id in (7, 8, 10)"), payload=True).collect()
    assert {r.page_id: r.payload for r in got} == {7: None, 8: ("é" * 500).encode(), 10: b"z" * 2_000_000}


def test_joined_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 500, 10), ("b", 0, 200), ("b", 200, 5)]
    got = list(W.joined_ranges(iter(rows), read_bytes=100, gap_bytes=5))
    assert got == [("a", 0, 30, [(0, 10), (10, 10), (25, 5)]), ("a", 500, 510, [(500, 10)]), ("b", 0, 200, [(0, 200)]),
                   ("b", 200, 205, [(200, 5)])]


def test_empty_table(spark):
    index = W.write_archives(frame(spark, []), W.archive_folder(spark))
    assert W.read_records(index).collect() == []
