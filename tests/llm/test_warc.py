import io

import pytest
from compare import connect, differences

from wardledger.llm.warc import ORACLE_SQL, page_record, read_records, read_warc, round_trip, write_warc


@pytest.fixture(scope="module")
def pages(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


def test_sql(pages, folder):
    columns, extra, missing, rows = differences(round_trip(pages), connect(folder), ORACLE_SQL)
    assert not columns and not extra and not missing and rows == pages.count()


def test_payloads_come_back(pages):
    found = {r["page_id"]: bytes(r["payload"]).decode() for r in read_warc(write_warc(pages)).collect()}
    assert found == {r["page_id"]: r["html"] or "" for r in pages.collect()}


def test_odd_pages(spark):
    rows = [(1, "http://a\r\nX: y", None, 1), (2, None, "", 2), (3, "http://b", "x\r\n\r\ny", 3), (5, "http://c", "é" * 400_000, 4),
            (4, "", "é" * 400_000, 5), (4, "", "é" * 400_000, 5), (None, "u", "once", 6), (None, "u", "", 6), (9, "u", "tie", 1), (9, "u", "tie", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, payload int")
    found = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["digest_ok"]) for r in round_trip(pages).collect()), key=str)
    expected = [(1, "revisit", 2, 0, True), (2, "response", None, 0, True), (3, "response", None, 6, True), (4, "revisit", 5, 800_000, True),
                (4, "revisit", 5, 800_000, True), (5, "response", None, 800_000, True), (9, "response", None, 3, True), (9, "response", None, 3, True),
                (None, "response", None, 4, True), (None, "revisit", 2, 0, True)]
    assert found == sorted(expected, key=str)
    assert round_trip(pages.limit(0)).count() == 0


class Dribble(io.BytesIO):
    """A stream that gives a few bytes at a time."""

    def read(self, size=-1):
        return super().read(min(7, size) if size > 0 else 7)


def test_reading_in_small_pieces():
    archive = page_record(1, "http://a", b"one", None) + page_record(2, None, b"one", 1) + page_record(3, None, b"\r\n\r\n" * 9, None)
    for stream in (io.BytesIO(archive), Dribble(archive)):
        got = [(r.headers["WARC-Type"], r.payload) for r in read_records(stream)]
        assert got == [("response", b"one"), ("revisit", b""), ("response", b"\r\n\r\n" * 9)]


def test_damage_is_reported():
    archive = page_record(1, "http://a", b"one" * 100, None)
    for broken in (archive[:-20], archive[:40]):
        with pytest.raises(ValueError):
            list(read_records(io.BytesIO(broken)))
