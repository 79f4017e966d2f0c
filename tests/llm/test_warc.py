import hashlib

import pytest
from helpers_llm import prose

from palimpsest.llm import warc
from palimpsest.storage import Scratch

FALSE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
ROWS = [
    (1, "http://a b/", "x" * 1200),
    (2, None, "x" * 1200),
    (None, "u", "x" * 1200),
    (3, "http://c", ""),
    (4, "u\r\nX: y", None),
    (5, "u", FALSE),
    (6, "u", "é" * 700 + "WARC/1.1\r\n"),
    (7, "u", "é" * 700 + "WARC/1.1\r\n"),
    (8, "u", "\r\n\r\n" * 300 + "WARC/1.1\r\n" * 3 + "z"),
    (9, "u", prose(300, 1) + FALSE + prose(300, 2) + FALSE),
    (10, "u", "y" * 999),
    (11, "u", "y" * 999),
]
SCHEMA = "page_id long, url string, html string"


def expected(rows):
    payloads = {key: (html or "").encode() for key, _, html in rows}
    result = {}
    for key, payload in payloads.items():
        same = [k for k, p in payloads.items() if p == payload and k is not None]
        first = max(same) if same and len(payload) >= 1000 else key
        kind = ("response", None) if first == key else ("revisit", first)
        result[key] = (len(payload), hashlib.sha1(payload).hexdigest(), *kind, True)
    return result


@pytest.mark.parametrize(("files", "split"), [(1, "64m"), (3, "64m"), (1, "3k"), (1, "701b")])
def test_round_trip(spark, files, split):
    """Splits that fall into records, headers and magic lines."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' as digest", "1 as bytes", "2 as block").coalesce(files)
        rows = warc.round_trip(pages, Scratch(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in rows}
    assert len(rows) == len(ROWS) and found == expected(ROWS)


def test_long_chains(spark):
    rows = [(k, f"http://host/{k}", f"page {k % 700} " * (k % 5 * 40)) for k in range(1500)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = warc.round_trip(spark.createDataFrame(rows, SCHEMA).coalesce(2), Scratch(spark)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in found} == expected(rows)


def test_repeated_rows_are_all_responses(spark):
    rows = [(1, "u", "x" * 1500)] * 3 + [(0, "u", "x" * 1500)]
    found = warc.round_trip(spark.createDataFrame(rows, SCHEMA), Scratch(spark)).collect()
    assert sorted((r.page_id, r.record_type) for r in found) == [(0, "revisit")] + [(1, "response")] * 3


def test_file_that_does_not_begin_with_a_record(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"junk" + FALSE.encode())
    (tmp_path / "b.warc").write_bytes(FALSE.encode()[:40])
    assert warc.read(spark, str(tmp_path), Scratch(spark)).count() == 0


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA), Scratch(spark)).count() == 0


def test_second_scan_with_other_splits(spark, tmp_path):
    """The text is scanned again only when the result is asked for."""
    path = str(tmp_path / "archives")
    pages = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    warc.write(warc.records(pages, Scratch(spark)), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
    try:
        result = warc.read(spark, path, Scratch(spark))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "701b")
        rows = result.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in rows}
    assert len(rows) == len(ROWS) and found == expected(ROWS)


def test_a_part_that_is_gone_is_an_error(spark, tmp_path):
    path = tmp_path / "archives"
    warc.write(warc.records(spark.createDataFrame([(5, "u", FALSE)], SCHEMA), Scratch(spark)), str(path))
    result = warc.read(spark, str(path), Scratch(spark))
    for file in path.glob("part-*"):
        file.write_bytes(file.read_bytes().replace(b"hello", b"jello"))
    for file in path.glob(".part-*.crc"):
        file.unlink()
    with pytest.raises(Exception, match="not found again"):
        result.collect()
