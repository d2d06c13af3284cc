import base64
import hashlib

import pytest

from demandloom.llm.durable import fresh
from demandloom.llm.warc import read_archives, write_archives

MAGIC = "WARC/1.1\r\n"
SCHEMA = "page_id long, url string, html string"
FAKE = MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
ROWS = [
    (1, "http://a", "<p>a</p>"), (2, "b\r\nX-Evil: 1", "<p>a</p>"), (3, None, None), (4, "x", ""),
    (5, "y", FAKE + "tail"), (6, "é", "é" * 3000 + MAGIC * 3 + "WARC/" + MAGIC), (7, "z", MAGIC),
    (None, "q", "<p>a</p>"), (8, "b", "\r\n\r\n" + FAKE), (9, "b", MAGIC), (10, "c", "x" * 50_000),
]


def expected(rows, least=0):
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(last.get(html or "", page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        twin = last.get(html or "")
        revisit = page is not None and twin != page and len(raw) >= least
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page, len(raw), digest, "revisit" if revisit else "response", twin if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, rows, least=0, files=2):
    path = fresh(spark, "warc-test")
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as bytes", "'d' as digest", "0 as salt")
    write_archives(pages.coalesce(files), path, least)
    found = read_archives(spark, path).collect()
    assert all(r.intact for r in found)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in found), key=str)


@pytest.mark.parametrize("split", [700, 20_000, 128_000_000])
def test_round_trip_in_splits_of_any_size(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert round_trip(spark, ROWS) == expected(ROWS)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_small_payloads_are_not_revisited(spark):
    assert round_trip(spark, ROWS, least=9) == expected(ROWS, least=9)


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "a", "same"), (1, "a", "same"), (2, "b", "other")]
    assert round_trip(spark, rows, files=1) == expected(rows)
    path = fresh(spark, "warc-test")
    write_archives(spark.createDataFrame([], SCHEMA), path)
    assert read_archives(spark, path).count() == 0


def test_a_broken_tail_and_a_foreign_file_give_no_rows_behind_the_break(spark, tmp_path):
    record = MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "cut.warc").write_bytes((record + MAGIC + "Content-Length: 99\r\n\r\nabc").encode())
    (tmp_path / "other.warc").write_bytes(("junk" + record).encode())
    found = read_archives(spark, str(tmp_path)).collect()
    assert [(r.offset, r.payload_bytes) for r in found] == [(0, 3)]


def test_a_split_inside_a_payload_of_false_magic(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = [(1, "a", "start"), (2, "b", FAKE * 60), (3, "c", "end")]
        assert round_trip(spark, rows, files=1) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_foreign_file_alone_gives_no_rows(spark, tmp_path):
    record = MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "other.warc").write_bytes(("junk" + record).encode())
    assert read_archives(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("split", [700, 128_000_000])
def test_payloads_come_back_and_revisits_are_resolved(spark, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        path = fresh(spark, "warc-test")
        write_archives(spark.createDataFrame(ROWS, SCHEMA).coalesce(2), path)
        wanted = sorted(((p, (h or "").encode()) for p, _, h in ROWS), key=str)
        found = read_archives(spark, path, payloads=True, resolve=True).collect()
        assert sorted(((r.page_id, bytes(r.payload)) for r in found), key=str) == wanted
        plain = read_archives(spark, path, payloads=True).collect()
        assert all((bytes(r.payload) == b"") == (r.record_type == "revisit" or r.payload_bytes == 0) for r in plain)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives_of_others(spark, tmp_path):
    """Version 1.0, ids and record types of a crawler, a revisit of a record of another file."""
    block = "HTTP/1.1 200 OK\r\n\r\nbody WARC/1.0\r\n inside"
    one = (
        "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 4\r\n\r\ninfo\r\n\r\n"
        f"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nWARC-Target-URI: http://x\r\n"
        f"Content-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    )
    two = (
        "WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:3>\r\nWARC-Refers-To: <urn:uuid:2>\r\n"
        "Content-Length: 0\r\n\r\n\r\n\r\nWARC/1.2\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    )
    (tmp_path / "a.warc").write_bytes(one.encode())
    (tmp_path / "b.warc").write_bytes(two.encode())
    found = {r.record_id: r for r in read_archives(spark, str(tmp_path), payloads=True, resolve=True).collect()}
    assert set(found) == {"<urn:uuid:1>", "<urn:uuid:2>", "<urn:uuid:3>"}
    assert bytes(found["<urn:uuid:2>"].payload).decode() == block == bytes(found["<urn:uuid:3>"].payload).decode()
    assert found["<urn:uuid:2>"].url == "http://x" and found["<urn:uuid:2>"].page_id is None
    assert found["<urn:uuid:3>"].refers_to_id == "<urn:uuid:2>" and found["<urn:uuid:1>"].intact is None


def test_many_revisits_are_joined_by_a_shuffle(spark, monkeypatch):
    from demandloom.llm import warc

    monkeypatch.setattr(warc, "BROADCAST_ROWS", -1)
    assert round_trip(spark, ROWS) == expected(ROWS)
